"""Cross-tokenizer alignment: the tokens of two vocabularies over the same bytes."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .bpe import Encoder, _groups, _offsets, _ranges
from .registry import query, table
from .util import saved

LANE = 256               # bytes that one lane of the lockstep covers
GROUP = 400_000          # characters of texts that are aligned together
REMEMBERED = 120_000     # words of each kind that a worker remembers before it starts afresh
HOT_PAIRS = 1_000_000    # most id pairs that are broadcast
# Fixed value: where byte-level pre-tokenizers split.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
ARRAYS = ("a_ids", "b_ids", "a_cuts", "b_cuts", "link_a", "link_b")


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for
    themselves, the others are counted up from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Byte strings by id, and an encoder of texts that stand after a space."""

    def __init__(self, tokens: Sequence[bytes], encoder: Encoder):
        self.encoder = encoder
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has; none for an empty text."""
        if len(self.encoder.index) > REMEMBERED:
            self.encoder.forget()
        ids, sizes = self.encoder.encode([" " + t if t else "" for t in texts])
        return ids.astype(np.int64), sizes

    def text(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[_ranges(self.start[ids], self.size[ids])]


def byte_vocabulary(source: str) -> Vocabulary:
    """A byte-level BPE file of the ``tokenizers`` library; special tokens are plain text. Its merges
    are looked for in the order of their tokens' ids, which such files have."""
    spec, letters = json.loads(source), byte_letters()
    model, split = spec["model"], spec["pre_tokenizer"]
    if model["type"] != "BPE" or spec["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"]:
        raise ValueError("not a plain byte-level BPE file")
    vocab = sorted(model["vocab"], key=model["vocab"].get)
    if [model["vocab"][t] for t in vocab] != list(range(len(vocab))):
        raise ValueError("ids are not 0..n-1")
    merged = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if merged != sorted(merged):
        raise ValueError("merges are not in the order of their ids")
    tokens = [bytes(letters[c] for c in t) for t in vocab]
    return Vocabulary(tokens, Encoder(tokens, BYTE_LEVEL))


class _Words(Encoder):
    """Words with the spaces before them, each encoded once: no piece of the model has a space
    after another character, so a text's pieces are those of its words."""

    def __init__(self, model):
        import regex

        self.model, self.merges = model, self
        self.split = regex.compile(" *[^ ]+| +$").findall
        self.forget()

    def encode_pieces(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        # The model puts one space before a text itself, but not before an empty one.
        ids = self.model.encode([w.decode()[1:] for w in words], num_threads=1)
        alone = [self.model.piece_to_id("▁")]
        ids = [alone if w == b" " else i for w, i in zip(words, ids, strict=True)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter((i for row in ids for i in row), np.int32, int(sizes.sum())), sizes


def piece_vocabulary(model: bytes) -> Vocabulary:
    """A ``sentencepiece`` BPE model; it puts the space before the text itself."""
    from sentencepiece import SentencePieceProcessor

    p = SentencePieceProcessor(model_proto=model)
    pieces = [p.id_to_piece(i) for i in range(p.vocab_size())]
    if any("▁" in s.lstrip("▁") for s in pieces):
        raise ValueError("a piece has a space after another character")
    tokens = [bytes([int(s[3:5], 16)]) if p.is_byte(i) else s.replace("▁", " ").encode()
              for i, s in enumerate(pieces)]
    return Vocabulary(tokens, _Words(p))


def _same(vocabulary: Vocabulary, ids: np.ndarray, sizes: np.ndarray, raw: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Rows whose tokens' bytes are the row's text."""
    of = np.repeat(np.arange(sizes.size), sizes)
    ok = np.bincount(of, vocabulary.size[ids], sizes.size).astype(np.int64) == length
    mine = vocabulary.text(ids[ok[of]])
    want = raw[np.repeat(ok, length)]
    bad = np.flatnonzero(mine != want)
    ends = np.cumsum(np.where(ok, length, 0))
    ok[np.searchsorted(ends, bad, side="right")] = False
    return ok


def lockstep(a_end: np.ndarray, b_end: np.ndarray, starts: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A token, B token, both end here) for all overlapping tokens of all documents, in order.

    ``a_end`` and ``b_end`` are ends in the bytes of all documents one after another; ``starts``
    where the documents begin, and the end of the last. One state vector holds a pair of
    pointers per lane: a document, or every ``lane`` bytes of a longer one, whose lanes
    begin at the two tokens over that byte, which the document's merge is bound to pass. Each step
    every lane emits its pair, and a cut if both tokens end together, and moves the pointer of
    the token that ends first (or both). Finished lanes leave the vector.
    """
    n_a, n_b = a_end.size, b_end.size
    at = np.unique(np.concatenate([np.arange(x, y, lane) for x, y in zip(starts[:-1], starts[1:], strict=True)] + [starts[-1:]]))
    # Both pointers only grow, so their sum is a place of its own for every pair of the batch.
    first = np.unique(np.stack([np.searchsorted(a_end, at, "right"), np.searchsorted(b_end, at, "right")]), axis=1)
    ia, ib, stop = first[0, :-1].copy(), first[1, :-1].copy(), first.sum(axis=0)[1:]
    link = np.full(n_a + n_b, -1, np.int64)
    cut = np.zeros(n_a + n_b, bool)
    while ia.size:
        x, y, place = a_end[ia], b_end[ib], ia + ib
        link[place], cut[place] = ia, x == y
        ia = ia + (x <= y)
        ib = ib + (y <= x)
        live = ia + ib != stop
        if not live.all():
            ia, ib, stop = ia[live], ib[live], stop[live]
    place = np.flatnonzero(link >= 0)
    return link[place], place - link[place], cut[place]


def align_texts(a: Vocabulary, b: Vocabulary, texts: Sequence[str]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """For each of ARRAYS: values of all texts end to end, and how many each text has."""
    n = len(texts)
    raw_texts = [(" " + t).encode("utf-8", "replace") if t else b"" for t in texts]
    length = np.fromiter(map(len, raw_texts), np.int64, n)
    raw = np.frombuffer(b"".join(raw_texts), np.uint8)
    (a_ids, a_n), (b_ids, b_n) = a.encode(texts), b.encode(texts)
    ok = _same(a, a_ids, a_n, raw, length) & _same(b, b_ids, b_n, raw, length)
    a_ids, b_ids = a_ids[np.repeat(ok, a_n)], b_ids[np.repeat(ok, b_n)]
    a_n, b_n, length = np.where(ok, a_n, 0), np.where(ok, b_n, 0), np.where(ok, length, 0)
    starts = np.concatenate([[0], np.cumsum(length)])
    la, lb, cut = lockstep(np.cumsum(a.size[a_ids]), np.cumsum(b.size[b_ids]), starts)
    row = np.repeat(np.arange(n), a_n)[la]
    links, cuts = np.bincount(row, minlength=n), np.bincount(row[cut], minlength=n)
    la, lb = la - (np.cumsum(a_n) - a_n)[row], lb - (np.cumsum(b_n) - b_n)[row]
    return dict(zip(ARRAYS, [(a_ids, a_n), (b_ids, b_n), (la[cut] + 1, cuts), (lb[cut] + 1, cuts), (la, links), (lb, links)],
                    strict=True))


def _schema(df: DataFrame, keep: Sequence[str], extra: str) -> StructType:
    return StructType([df.schema[c] for c in keep] + StructType.fromDDL(extra).fields)


def _lists(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(_offsets(sizes), pa.array(values, kind))


def align(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """Adds arrays of ints: the token ids ``a_ids`` and ``b_ids``; ``a_cuts`` and ``b_cuts``, the
    number of A and of B tokens before each place where tokens of both end; ``link_a`` and
    ``link_b``, the positions of all pairs of tokens that share bytes.

    Space and text are encoded by the byte-level BPE file ``a_path`` and by the piece
    model ``b_path``. Tokens are aligned by their bytes: where either's joined bytes are not those of
    space and text (the piece model normalises some texts), all arrays are empty, as they are for
    null and empty texts. Words of a batch are encoded once and remembered. Batches are cut into groups of
    a few hundred thousand characters, each merged in lockstep; a very long text is merged in many lanes.
    Rows, their order and repeats stay; nothing is shuffled. ``keep`` names the columns to carry
    (default: all; those named as an added one are replaced). Both files (a few MB) are read on
    the driver and broadcast.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ARRAYS]
    src = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return src.mapInArrow(_aligner(docs, a_path, b_path, keep), _schema(docs, keep, ", ".join(f"{c} array<int>" for c in ARRAYS)))


def _aligner(docs: DataFrame, a_path: str, b_path: str, keep: Sequence[str]) -> Task:
    """From batches of the columns ``keep`` and a text."""
    with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:
        files = docs.sparkSession.sparkContext.broadcast((f.read(), g.read()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_vocabulary(files.value[0]), piece_vocabulary(files.value[1])
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            for x, y in _groups(texts, GROUP):
                got = align_texts(a, b, texts[x:y])
                cols = [batch.column(i).slice(x, y - x) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays(
                    [*cols, *[_lists(*got[c], pa.int32()) for c in ARRAYS]], names=[*keep, *ARRAYS])

    return run


def _flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return (col.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
            col.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))


DIGESTS = ("n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
           "pairs array<bigint>, times array<int>")


def with_digests(aligned: DataFrame, b_ids: int) -> DataFrame:
    """Instead of the arrays: ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``groups_sha256``, and the
    row's distinct linked id pairs as ``pairs`` (A id times ``b_ids`` plus B id) with how often
    each is linked, ``times``."""
    keep = [c for c in aligned.columns if c not in ARRAYS]
    return aligned.select(*keep, *ARRAYS).mapInArrow(_digester(keep, b_ids), _schema(aligned, keep, DIGESTS))


def _digester(keep: Sequence[str], b_ids: int) -> Task:
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[str, np.ndarray] = {}

        def written(ids: np.ndarray, end: np.ndarray, last: str) -> np.ndarray:
            top = int(ids.max(initial=0)) + 1
            if last not in names or names[last].size < 2 * top:
                names[last] = np.array([f"{i}{mark}" for mark in (",", last) for i in range(top)], object)
            return names[last][ids + end * (names[last].size // 2)]

        for batch in batches:
            n = batch.num_rows
            (ai, an), (bi, bn), (ac, cn), (bc, _), (la, ln), (lb, _) = (_flat(batch.column(c)) for c in ARRAYS)
            a0, b0 = np.cumsum(an) - an, np.cumsum(bn) - bn
            of_cut, of_link = np.repeat(np.arange(n), cn), np.repeat(np.arange(n), ln)
            a_end, b_end = ac + a0[of_cut], bc + b0[of_cut]
            a_last, b_last = np.zeros(ai.size, bool), np.zeros(bi.size, bool)
            a_last[a_end - 1] = b_last[b_end - 1] = True
            # A token's place among the tokens of both kinds, group by group.
            group_a = np.cumsum(a_last) - a_last
            group_b = np.cumsum(b_last) - b_last
            out = np.empty(ai.size + bi.size, object)
            before_b = np.concatenate([[0], b_end])
            out[np.arange(ai.size) + before_b[group_a]] = written(ai, a_last, "|")
            out[np.arange(bi.size) + a_end[group_b]] = written(bi, b_last, ";")
            cuts = np.concatenate([[0], np.cumsum(an + bn)])
            digests = [hashlib.sha256("".join(out[x:y])[:-1].encode()).hexdigest() if y > x else ""
                       for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
            key = ai[la + a0[of_link]] * b_ids + bi[lb + b0[of_link]]
            order = np.lexsort((key, of_link))
            key, row = key[order], of_link[order]
            new = np.ones(key.size, bool)
            new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
            first = np.flatnonzero(new)
            sizes = np.bincount(row[first], minlength=n)
            times = np.diff(np.append(first, key.size))
            cols = [batch.column(i) for i in range(len(keep))]
            cols += [pa.array(v, pa.int64()) for v in (an, bn, cn, ln)]
            cols += [pa.array(digests, pa.string()), _lists(key[first], sizes, pa.int64()), _lists(times, sizes, pa.int32())]
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, *[c.split()[0] for c in DIGESTS.split(", ")]])

    return run


def pair_counts(rows: DataFrame, b_ids: int) -> DataFrame:
    """(pair, docs, best): how many rows hold each pair; whether no pair of its A id is in more."""
    counts = saved(rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("docs")),
                   "align-counts").withColumn("_a", F.expr(f"pair div {b_ids}"))
    # One row per A id: the vocabulary bounds it.
    top = counts.groupBy("_a").agg(F.max("docs").alias("_top"))
    return counts.join(F.broadcast(top), "_a").select("pair", "docs", (F.col("docs") == F.col("_top")).alias("best"))


def with_pair_counts(rows: DataFrame, b_ids: int) -> DataFrame:
    """Adds ``n_best`` and ``count_sum`` to rows of ``with_digests`` that carry a unique ``_n``.

    Pairs in at least a millionth of all (row, pair) occurrences are at most a million and are broadcast;
    the occurrences of all others meet their counts in a shuffle, where none is frequent.
    """
    counts = saved(pair_counts(rows, b_ids), "align-best")
    total = counts.agg(F.coalesce(F.sum("docs"), F.lit(0))).scalar()
    hot, cold = (counts.filter(F.col("docs") * HOT_PAIRS >= total), counts.filter(F.col("docs") * HOT_PAIRS < total))
    each = rows.select("_n", F.explode(F.arrays_zip("pairs", "times")).alias("_p")).select(
        "_n", F.col("_p.pairs").alias("pair"), F.col("_p.times").cast("long").alias("times"))
    met = each.join(F.broadcast(hot), "pair").unionByName(
        each.join(F.broadcast(hot.select("pair")), "pair", "left_anti").join(cold, "pair"))
    sums = met.groupBy("_n").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("docs")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    return rows.join(sums.withColumnRenamed("_n", "_m"), F.col("_n") == F.col("_m"), "left").select(
        *[c for c in rows.columns], F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"))


def alignment_report(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """One row per document: token, group and link counts, the digest of its groups, and how its
    links fare in the whole table: ``count_sum``, over links, of the number of rows that hold
    the link's id pair; ``n_best``, links whose pair is in as many rows as any of its A id.

    Each row counts as a document, repeated rows too. Texts without tokens (see ``align``) have
    zeros and an empty digest; an empty table gives no rows. Columns of the input named as an
    added one are replaced. Aligned rows are written once: counts, and distinct pairs with
    their frequency in the row.
    """
    from sentencepiece import SentencePieceProcessor

    b_ids = SentencePieceProcessor(model_file=b_path).vocab_size()
    added = {"n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times", "n_best", "count_sum"}
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    src = docs.select(F.struct(*[F.col(c) for c in keep]).alias("_row"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    first, then = _aligner(src, a_path, b_path, ["_row"]), _digester(["_row"], b_ids)
    # ``align`` and ``with_digests`` in one worker: the arrays between them do not leave it.
    done = src.mapInArrow(lambda batches: then(first(batches)), _schema(src, ["_row"], DIGESTS))
    rows = saved(done.withColumn("_n", F.monotonically_increasing_id()), "aligned", 1_000)
    return with_pair_counts(rows, b_ids).select(
        *[F.col(f"_row.`{c}`").alias(c) for c in keep],
        "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query("op12_alignment")
def op12_alignment(spark, sf):
    """Every whole text under both vocabularies; links weighed over the whole table."""
    import public_tokenizers

    return alignment_report(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                            public_tokenizers.path("piece_bpe_32k.model"), keep=["doc_id"])
