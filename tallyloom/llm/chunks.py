"""Substring dedup: content-defined chunks, found again in other documents by digest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import query, table
from .util import join_hot, saved

WINDOW = 16                      # bytes that decide on a cut
LEAST, MOST = 16, 192            # bytes of a chunk
ONE_IN = 16                      # positions at which the hash cuts
BATCH = 2_000_000                # bytes hashed together
# A fixed random number for each byte.
GEAR = np.random.default_rng(20).integers(0, 2**32, 256, dtype=np.uint32)


def gear_hash(data: np.ndarray) -> np.ndarray:
    """h[i] is the sum of GEAR[data[i - k]] << k over the last WINDOW bytes, by doubling."""
    h = GEAR[data]
    step = 1
    while step < WINDOW:
        longer = h.copy()
        longer[step:] += h[:-step] << np.uint32(step)
        h, step = longer, step * 2
    return h


def cuts(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[list[int]]:
    """Ends of the chunks of each text in ``data`` (UTF-8, texts end to end), from its start.

    A chunk ends after a byte at which the hash is small, or after MOST bytes, never
    before LEAST bytes, and never inside a character. The window lies within the
    text, so equal passages are cut alike once a cut falls in both: an insertion moves
    boundaries only near it.
    """
    small = np.flatnonzero(gear_hash(data) < np.uint32(2**32 // ONE_IN)) + 1
    first = (data & 0xC0) != 0x80
    bounds = np.searchsorted(small, [starts, starts + sizes])
    out = []
    for start, size, lo, hi in zip(starts.tolist(), sizes.tolist(), *bounds.tolist(), strict=True):
        end, last, ends = start + size, start, []
        for c in [*small[lo:hi].tolist(), end]:
            while c - last > MOST:
                at = last + MOST
                while at < end and not first[at]:
                    at += 1
                ends.append(at - start)
                last = at
            if c - last >= LEAST and c < end:
                while c < end and not first[c]:
                    c += 1
                if c < end:
                    ends.append(c - start)
                    last = c
        if end > last:
            ends.append(size)
        out.append(ends)
    return out


def chunk_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, row, start, size, h1, h2): every chunk of every text, in bytes of UTF-8, with its
    128-bit digest. ``row`` tells texts under one id apart."""
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    src = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), text).alias("row"), text.alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        for b in batches:
            lo = 0
            while lo < b.num_rows:
                texts, size, hi = [], 0, lo
                while hi < b.num_rows and (size < BATCH or not texts):
                    texts.append(b.column(2)[hi].as_py())
                    size += len(texts[-1])
                    hi += 1
                sizes = np.array([len(t) for t in texts])
                ends = cuts(np.frombuffer(b"".join(texts), np.uint8), np.cumsum(sizes) - sizes, sizes) if size else [[]] * len(texts)
                start = [s for e in ends for s in [0, *e[:-1]] if e]
                stop = [s for e in ends for s in e]
                of = np.repeat(np.arange(len(texts)), [len(e) for e in ends])
                raw = b"".join(xxhash.xxh3_128_digest(texts[i][s:t]) for i, s, t in zip(of.tolist(), start, stop, strict=True))
                h = np.frombuffer(raw, np.int64).reshape(-1, 2)
                at = pa.array(of + lo)
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(at), b.column(1).take(at), pa.array(start, pa.int32()),
                    pa.array(np.array(stop, np.int64) - np.array(start, np.int64), pa.int32()),
                    pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy())], names=["id", "row", "start", "size", "h1", "h2"])
                lo = hi

    kind = docs.schema[id_col].dataType.simpleString()
    return src.mapInArrow(run, f"id {kind}, row long, start int, size int, h1 long, h2 long")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_span: int = 64) -> DataFrame:
    """One row per id and text that repeats others: the id, ``row``, ``n_repeated`` chunks and
    ``spans``, the runs of them as structs (start, end) in bytes of UTF-8, of ``least_span`` bytes or more.

    A chunk repeats if a smaller id holds a chunk of equal bytes; the smallest id keeps all
    its own. Texts are cut by a gear rolling hash of 16 bytes into chunks of 16 to 192
    bytes (32 on average). Only whole chunks are found: a passage loses a part at both
    ends, and of a short one there may be no run of ``least_span``. Chunks are counted with map-side combining; a chunk that very many documents
    hold is looked up by broadcast; texts do not move.

    Null or empty texts have no chunks. A null id comes after all others and is one
    document. Repeated rows give one row here.
    """
    found = saved(chunk_table(docs, id_col, text_col), "chunks", 1000)
    first = found.groupBy("h1", "h2").agg(
        F.min("id").alias("first"), F.max("id").alias("last"), F.count("id").alias("ids"), F.count(F.lit(1)).alias("w"))
    # Few of all chunks; written, so that all of them are counted once.
    shared = saved(first.filter((F.col("first") < F.col("last")) | ((F.col("ids") > 0) & (F.col("ids") < F.col("w")))).select(
        "h1", "h2", "first", "w"), "shared-chunks")
    again = join_hot(found, shared, ["h1", "h2"], "w").filter(~F.col("id").eqNullSafe(F.col("first")))
    per = again.groupBy("id", "row").agg(F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("end")))).alias("c"))
    opens = F.filter("c", lambda x, i: (i == 0) | (F.get(F.col("c"), i - 1).end != x.start)).alias("a")
    closes = F.filter("c", lambda x, i: F.coalesce(F.get(F.col("c"), i + 1).start != x.end, F.lit(True))).alias("b")
    runs = per.select("id", "row", F.size("c").cast("long").alias("n_repeated"), opens, closes).select(
        "id", "row", "n_repeated", F.zip_with("a", "b", lambda a, b: F.struct(a.start.alias("start"), b.end.alias("end"))).alias("spans"))
    runs = runs.withColumn("spans", F.filter("spans", lambda s: s.end - s.start >= least_span))
    return runs.filter(F.size("spans") > 0).withColumnRenamed("id", id_col)


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_span: int = 64) -> DataFrame:
    """The rows of ``docs`` with the repeated spans cut out of the text, and ``n_cut`` bytes.
    Null text stays null; other columns pass through (one named ``n_cut`` is replaced)."""
    keep = [c for c in docs.columns if c != "n_cut"]
    raw = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    spans = repeated_spans(docs.select(id_col, text_col), id_col, text_col, least_span).select(F.col("row").alias("_row"), F.col("spans").alias("_spans"))
    d = docs.select(*keep, F.xxhash64(F.col(id_col), raw).alias("_own")).join(spans, F.col("_own") == F.col("_row"), "left")
    d = d.withColumn("_raw", raw).withColumn("_last", F.when(F.size("_spans") > 0, F.element_at("_spans", -1).end))
    pieces = F.transform("_spans", lambda s, i: F.substring(
        F.col("_raw"), F.coalesce(F.get(F.col("_spans"), i - 1).end, F.lit(0)) + 1,
        s.start - F.coalesce(F.get(F.col("_spans"), i - 1).end, F.lit(0))).cast("string"))
    rest = F.substring(F.col("_raw"), F.col("_last") + 1, F.octet_length("_raw")).cast("string")
    text = F.when(F.col("_last").isNull(), F.col(text_col)).otherwise(F.concat(F.array_join(pieces, ""), rest))
    cut = F.aggregate("_spans", F.lit(0).cast("long"), lambda a, s: a + s.end - s.start)
    return d.select(*[text.alias(c) if c == text_col else F.col(c) for c in keep], F.coalesce(cut, F.lit(0).cast("long")).alias("n_cut"))


@query("op2_substring_dedup")
def op2_substring_dedup(spark, sf):
    """Every document's spans that smaller ids hold too, over all whole texts."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    spans = repeated_spans(docs)
    line = F.transform("spans", lambda s: F.concat_ws(":", s.start.cast("string"), s.end.cast("string")))
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s.end - s.start)
    return spans.select("doc_id", "n_repeated", size.alias("repeated_bytes"), F.array_join(line, ",").alias("spans"))
