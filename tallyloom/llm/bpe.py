"""Byte-level BPE: exact encoding with length-bucketed numpy matrices, and decoding."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lookup import Table
from .registry import query, table

NONE = np.int32(2**31 - 1)          # no such pair
LONG = 256                          # bytes; longer pieces merge with a heap, not in a matrix
ROWS = 16_384                       # pieces in one matrix
CACHE = 400_000                     # pieces a worker remembers before it starts afresh
MOST_RANKS = 1_000_000              # a rank table larger than this is not broadcast


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by id; every byte has a token of its own."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    ranks = {base64.b64decode(a): int(b) for a, b in pairs}
    if len(ranks) > MOST_RANKS:
        raise ValueError(f"{len(ranks)} ranks; at most {MOST_RANKS} are broadcast")
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks are not 0..n-1")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("a byte has no token")
    return sorted(ranks, key=ranks.get)


class Merges:
    """Pair lookup for one rank table: (left id, right id) -> id of the joined bytes.

    Pairs sit in a hash table of numpy arrays and are looked up a matrix at a time.
    """

    def __init__(self, tokens: Sequence[bytes]):
        self.tokens = list(tokens)
        self.ids = {t: i for i, t in enumerate(self.tokens)}
        self.byte_ids = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        left, right, out = [], [], []
        for i, t in enumerate(self.tokens):
            for cut in range(1, len(t)):
                a, b = self.ids.get(t[:cut]), self.ids.get(t[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), out.append(i)
        keys = np.array(left, np.int64) << 32 | np.array(right, np.int64)
        self.pairs = Table(keys, np.array(out, np.int32), NONE)
        sizes = np.array([len(t) for t in self.tokens], np.int64)
        self.size, self.start = sizes, np.concatenate([[0], np.cumsum(sizes)[:-1]])
        self.bytes = np.frombuffer(b"".join(self.tokens), np.uint8)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.pairs.get(left.astype(np.int64) << 32 | right.astype(np.int64))

    def encode_pieces(self, pieces: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces end to end, and the number of each. A piece that is a token is that token."""
        size = np.ones(len(pieces), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []      # rows, their ids end to end
        whole, ids, buckets = [], [], {}
        for i, p in enumerate(pieces):
            known = self.ids.get(p)
            if known is not None:
                whole.append(i)
                ids.append(known)
            elif len(p) <= 16:
                buckets.setdefault(len(p), []).append(i)
            elif len(p) <= LONG:
                buckets.setdefault(-(-len(p) // 16) * 16, []).append(i)
            else:
                got = self.merge_long(p)
                size[i] = got.size
                done.append((np.array([i]), got))
        done.append((np.array(whole, np.int64), np.array(ids, np.int32)))
        size[buckets.pop(0, [])] = 0
        for width, rows in buckets.items():
            for k in range(0, len(rows), ROWS):
                part = np.array(rows[k:k + ROWS])
                for row, n, got in self.merge_matrix([pieces[i] for i in part], width):
                    size[part[row]] = n
                    done.append((part[row], got))
        start = np.cumsum(size) - size
        out = np.empty(int(size.sum()), np.int32)
        for row, got in done:
            out[_ranges(start[row], size[row])] = got
        return out, size

    def merge_matrix(self, pieces: Sequence[bytes], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Rows of at most ``width`` bytes, padded with -1; each round every live row merges
        its leftmost pair of least rank and the matrix loses one column. Gives the rows that
        have nothing left to merge, their sizes, and their ids end to end."""
        size = np.array([len(p) for p in pieces])
        ids = np.full((len(pieces), width), -1, np.int32)
        ids[np.arange(width) < size[:, None]] = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        row = np.arange(len(pieces))
        pair = np.full((len(pieces), width - 1), NONE, np.int32)
        both = ids[:, 1:] >= 0
        pair[both] = self.rank(ids[:, :-1][both], ids[:, 1:][both])
        while row.size:
            if not pair.shape[1]:
                yield row, size, ids[:, 0]
                return
            at = pair.argmin(axis=1)
            least = pair[np.arange(row.size), at]
            live = least != NONE
            if not live.all():
                end = ~live
                rest = ids[end]
                yield row[end], size[end], rest[np.arange(rest.shape[1]) < size[end][:, None]]
                ids, pair, row, size, at, least = ids[live], pair[live], row[live], size[live], at[live], least[live]
                if not row.size:
                    return
            n, k = np.arange(row.size), ids.shape[1] - 1
            ids[n, at] = least
            stay = np.ones(ids.shape, bool)
            stay[n, at + 1] = False
            ids = ids[stay].reshape(row.size, k)
            stay = np.ones(pair.shape, bool)
            stay[n, at] = False
            pair, size = pair[stay].reshape(row.size, k - 1), size - 1
            for left in (at - 1, at):
                ok = np.flatnonzero((left >= 0) & (left + 1 < size))
                pair[ok, left[ok]] = self.rank(ids[ok, left[ok]], ids[ok, left[ok] + 1])

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges for one long piece in n log n steps: a heap of (rank, position)
        over a linked list."""
        n = len(piece)
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)]
        first = self.rank(ids[:-1], ids[1:])
        heap = [(int(r), i) for i, r in enumerate(first) if r != NONE]
        heapq.heapify(heap)
        pair = [int(r) for r in first] + [int(NONE)]
        end = list(range(1, n + 1))          # where the part that starts here ends
        before = list(range(-1, n - 1))
        token = ids.tolist()
        none = int(NONE)

        def renew(i: int) -> None:
            j = end[i]
            joined = self.ids.get(piece[i:end[j]], none) if j < n else none
            pair[i] = joined
            if joined != none:
                heapq.heappush(heap, (joined, i))

        while heap:
            rank, i = heapq.heappop(heap)
            if token[i] < 0 or pair[i] != rank:
                continue
            j = end[i]
            token[i], end[i] = rank, end[j]
            token[j] = -1
            pair[j] = none
            if end[i] < n:
                before[end[i]] = i
            renew(i)
            if before[i] >= 0:
                renew(before[i])
        return np.array([t for t in token if t >= 0], np.int32)

    def decode_flat(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids one after another, and where each id's bytes end."""
        size = self.size[ids]
        return self.bytes[_ranges(self.start[ids], size)], np.cumsum(size)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if ends.size else 0)


class Encoder:
    """Splits texts and encodes the distinct pieces of a batch, remembering them."""

    def __init__(self, tokens: Sequence[bytes], pattern: str):
        import regex
        # The pattern's white space is Unicode's property, not the module's wider class.
        white = r"\p{White_Space}"
        own = pattern.replace(r"\S", rf"[^{white}]").replace(r"[^\s", rf"[^{white}").replace(r"\s", white)
        self.split = regex.compile(own).findall
        self.merges = Merges(tokens)
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.start, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, pieces: set[str]) -> None:
        new = [p for p in pieces if p not in self.index]
        if not new:
            return
        if len(self.index) + len(new) > CACHE and self.index:
            self.forget()
            new = list(pieces)
        ids, size = self.merges.encode_pieces([p.encode("utf-8", "replace") for p in new])
        start = self.flat.size + np.cumsum(size) - size
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
        self.flat = np.concatenate([self.flat, ids])
        self.start, self.size = np.concatenate([self.start, start]), np.concatenate([self.size, size])

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the number of ids of each."""
        split = [self.split(t) for t in texts]
        seen: set[str] = set()
        for s in split:
            seen.update(s)
        self.learn(seen)
        at = np.fromiter((self.index[p] for s in split for p in s), np.int64, sum(map(len, split)))
        size = self.size[at]
        ids = self.flat[_ranges(self.start[at], size)]
        ends = np.concatenate([[0], np.cumsum(size)])
        cut = np.concatenate([[0], np.cumsum([len(s) for s in split])]).astype(np.int64)
        return ids, np.diff(ends[cut])


def _groups(texts: Sequence[str], most: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Runs of rows of a few million characters together, so one batch of long texts does
    not need all its pieces at once."""
    first = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= most:
            yield first, i + 1
            first, total = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def _schema(df: DataFrame, keep: Sequence[str], extra: str) -> str:
    return ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep) + ", " + extra


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", decoded: bool = False,
           keep: Sequence[str] | None = None) -> DataFrame:
    """Adds ``ids`` (array<int>): each match of ``pattern`` is encoded by the ranks in the file.

    ``decoded=True`` also adds ``decoded`` (binary), the bytes that the ids stand for. Results
    equal those of the usual encoders of such rank files without special tokens: a match
    that is itself a token stays whole; any other starts as bytes and merges its leftmost pair
    of least rank until none is left. Distinct matches of a batch are sorted into buckets by
    length and merged together as padded matrices; a worker remembers what it has encoded.

    Null or empty text gives no ids. Nothing is shuffled; rows, their order and repeats stay.
    ``keep`` names the columns to carry (default: all but ``ids`` and ``decoded``, which are
    replaced). ``path`` is read on the driver and broadcast (at most 1,000,000 ranks).
    """
    spark = docs.sparkSession
    keep = [c for c in (keep or docs.columns) if c not in ("ids", "decoded")]
    tokens = spark.sparkContext.broadcast(read_ranks(path))
    src = docs.select(*keep, F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(tokens.value, pattern)
        for batch in batches:
            texts = [b.decode("utf-8", "replace") for b in batch.column(len(keep)).to_pylist()]
            for a, b in _groups(texts):
                ids, sizes = enc.encode(texts[a:b])
                cols = [batch.column(i).slice(a, b - a) for i in range(len(keep))]
                cols.append(pa.ListArray.from_arrays(_offsets(sizes), pa.array(ids, pa.int32())))
                if decoded:
                    raw, ends = enc.merges.decode_flat(ids)
                    cut = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])]
                    cols.append(pa.Array.from_buffers(pa.binary(), b - a, [
                        None, pa.py_buffer(cut.astype(np.int32)), pa.py_buffer(raw)]))
                yield pa.RecordBatch.from_arrays(cols, names=[*keep, "ids"] + ["decoded"] * decoded)

    extra = "ids array<int>" + ", decoded binary" * decoded
    return src.mapInArrow(run, _schema(docs, keep, extra))


def decode(df: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the bytes that the ids stand for. Null or no ids: empty bytes. Unknown ids raise."""
    tokens = df.sparkSession.sparkContext.broadcast(read_ranks(path))
    keep = [c for c in df.columns if c != out]
    src = df.select(*keep, F.coalesce(F.col(ids_col).cast("array<int>"), F.array().cast("array<int>")).alias("_ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = Merges(tokens.value)
        for batch in batches:
            col = batch.column(len(keep))
            ids = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            if ids.size and (ids.min() < 0 or ids.max() >= len(merges.tokens)):
                raise ValueError("an id has no token")
            sizes = col.value_lengths().to_numpy(zero_copy_only=False)
            raw, ends = merges.decode_flat(ids)
            cut = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes)])]
            done = pa.Array.from_buffers(pa.binary(), batch.num_rows, [
                None, pa.py_buffer(cut.astype(np.int32)), pa.py_buffer(raw)])
            cols = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*cols, done], names=[*keep, out])

    return src.mapInArrow(run, _schema(df, keep, f"`{out}` binary"))


def with_digests(encoded: DataFrame) -> DataFrame:
    """``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` instead of ids and bytes."""
    keep = [c for c in encoded.columns if c not in ("ids", "decoded")]
    return encoded.select(
        *keep, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op10_byte_bpe")
def op10_byte_bpe(spark, sf):
    """Every whole text, encoded and decoded again."""
    import public_tokenizers

    docs = table(spark, sf, "documents").select("doc_id", "text")
    done = encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                  decoded=True, keep=["doc_id"])
    return with_digests(done)
