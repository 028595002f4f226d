"""Sharding by longest processing time first: whole groups to the least loaded shard."""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .registry import query, table
from .util import digest, join_hot, saved

EXACT_BELOW = 4096          # sizes under this are classes of their own
LARGE_SHARE = 65_536        # so are sizes of at least one such part of all bytes
GROUP_ROWS = 1_000_000      # rows that one task ranks, on average


def size_class(size: Column, total: int) -> Column:
    """Groups that the schedule may treat as equal. Sizes below 4,096 and those that are at
    least 1/65,536 of everything count exactly; the others keep their 12 leading bits. So
    there are at most 65,536 + 4,096 + 2,048 * 51 classes, whatever the data."""
    drop = F.greatest(F.length(F.bin(size)) - 12, F.lit(0))
    lead = F.call_function("shiftleft", F.call_function("shiftright", size, drop), drop)
    # Rounded classes are negative, so that no exact size meets one.
    return F.when((size < EXACT_BELOW) | (size >= -(-total // LARGE_SHARE)), size).otherwise(-lead)


def deal_run(loads: list[float], count: int, size: float) -> list[int]:
    """How many of ``count`` items of one ``size`` each shard gets, if each goes to the least
    loaded one (the first of equals). ``loads`` is brought up to date.

    Taken one by one, the items fill the ``count`` lowest places among load + i * size. The
    level below which at most ``count`` places lie is found by bisection and filled at once; the few
    items left go through a heap.
    """
    low = np.array(loads, dtype=np.float64)

    def below(level: float) -> np.ndarray:
        return np.maximum(np.ceil((level - low) / size), 0).astype(np.int64)

    a, b = float(low.min()), float(low.min() + (count + 1) * size)
    for _ in range(200):
        mid = (a + b) / 2
        if mid in (a, b):
            break
        if int(below(mid).sum()) <= count:
            a = mid
        else:
            b = mid
    given = below(a)
    heap = [(load + int(n) * size, i) for i, (load, n) in enumerate(zip(loads, given, strict=True))]
    heapq.heapify(heap)
    out = [int(n) for n in given]
    for _ in range(count - int(given.sum())):
        load, i = heap[0]
        heapq.heapreplace(heap, (load + size, i))
        out[i] += 1
    for load, i in heap:
        loads[i] = load
    return out


def schedule(classes: Sequence[tuple[int, int, int]], shards: int) -> list[tuple[int, list[int]]]:
    """(class, first rank that is no longer in shard 0, 1, ...) for classes given as (class,
    groups, bytes of them all), largest mean size first."""
    loads: list[float] = [0] * shards
    out = []
    for key, count, total in sorted(classes, key=lambda c: (-c[2] / c[1], -c[0])):
        size = total // count if total % count == 0 else total / count
        out.append((key, np.cumsum(deal_run(loads, count, size)).tolist()))
    return out


def assign_shards(docs: DataFrame, shards: int = 16, text_col: str = "text", keep: Sequence[str] | None = None,
                  group: Sequence[str] | None = None) -> DataFrame:
    """Adds ``size``, ``text_crc32``, ``shard`` and ``slot``.

    A row's size is the UTF-8 bytes of its text plus 1. Rows of a group (equal texts, or equal
    values of the columns ``group``) stay together. Groups go, largest first, to the
    shard with the fewest bytes so far. ``slot`` numbers a shard's rows from 0 without gaps, by no
    promised order.

    The schedule is made on the driver from (size class, groups, bytes), at most some 170,000
    rows; groups of one class are ranked where they lie and take the shards their ranks were
    given, as a heap would deal them. Sizes of 4,096 bytes and over that are under
    1/65,536 of the total are scheduled by the mean of a class 0.05 % wide. Ranks and slots come
    from counts per bucket of about a million rows, added up in order, so neither a size that
    most groups have nor a shard is ever one task. A group that holds much of the table stays
    whole, in one shard, but its rows are numbered and joined in parts.

    Null and empty texts are one group of rows of size 1. Very long texts and repeated rows are
    ordinary. ``keep`` names the columns to carry (default: all, the text too); a column of the
    input named as an added one is replaced. An empty table gives no rows.
    """
    added = ("size", "text_crc32", "shard", "slot")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    if group:
        as_one = F.to_json(F.struct(*[F.col(c) for c in group]), {"ignoreNullFields": "false"})
    else:
        as_one = raw
    rows = saved(docs.select(
        F.struct(*[F.col(c) for c in keep]).alias("_row"), (F.octet_length(raw) + 1).cast("long").alias("_size"),
        F.crc32(raw).alias("_crc"), digest(as_one).alias("_group"), F.monotonically_increasing_id().alias("_n"),
    ), "shard-rows")
    groups = saved(rows.groupBy("_group").agg(F.sum("_size").alias("_bytes"), F.count(F.lit(1)).alias("_rows")),
                   "shard-groups")
    t = groups.agg(F.coalesce(F.sum("_bytes"), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("groups"),
                   F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows")).first()
    classed = groups.select("_group", "_rows", "_bytes", size_class(F.col("_bytes"), t["bytes"]).alias("_class"))
    found = classed.groupBy("_class").agg(F.count(F.lit(1)).alias("n"), F.sum("_bytes").alias("b")).toPandas()
    plan = schedule([(int(c), int(n), int(b)) for c, n, b in found.itertuples(index=False)], shards)
    ends = docs.sparkSession.createDataFrame(
        pd.DataFrame(plan, columns=["_class", "_ends"]), "_class long, _ends array<long>")
    ranked = _numbered(classed, "_class", F.xxhash64("_group"), "_group", t["groups"], "_rank")
    placed = ranked.join(F.broadcast(ends), "_class").select(
        "_group", "_rows", F.size(F.filter("_ends", lambda e: e <= F.col("_rank"))).alias("_shard"))
    met = saved(join_hot(rows, placed, ["_group"], "_rows").select("_row", "_size", "_crc", "_n", "_shard"), "shard-met")
    out = _numbered(met, "_shard", F.xxhash64("_n"), "_n", t["rows"], "_slot")
    return out.select(
        *[F.col(f"_row.`{c}`").alias(c) for c in keep], F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
        F.col("_shard").alias("shard"), F.col("_slot").alias("slot"))


def _numbered(df: DataFrame, key: str, spread: Column, order: str, rows: int, name: str) -> DataFrame:
    """Numbers the rows of each ``key`` from 0: buckets of about a million rows are numbered
    alone, and start where the ones before them end. ``df`` is evaluated twice."""
    buckets = rows // GROUP_ROWS + 1
    dealt = df.withColumn("_bucket", F.pmod(spread, F.lit(buckets)).cast("int"))
    counts = dealt.groupBy(key, "_bucket").agg(F.count(F.lit(1)).alias("_c"))
    before = counts.select(
        F.col(key).alias("_k"), F.col("_bucket").alias("_b"),
        (F.sum("_c").over(Window.partitionBy(key).orderBy("_bucket")) - F.col("_c")).alias("_before"))
    at = F.row_number().over(Window.partitionBy(key, "_bucket").orderBy(order)) - 1
    return dealt.withColumn("_at", at).join(
        before, (F.col(key) == F.col("_k")) & (F.col("_bucket") == F.col("_b"))).select(
        *df.columns, (F.col("_before") + F.col("_at")).alias(name))


@query("op13_sharding")
def op13_sharding(spark, sf):
    """All documents into 16 shards of nearly equal bytes; equal texts stay together."""
    return assign_shards(table(spark, sf, "documents"), keep=["doc_id"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
