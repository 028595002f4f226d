"""Ordered work without a single-task sort.

A global window, ``percentile`` or ``row_number`` over a whole table runs in one
task. These helpers cut the ordering column into ranges first: split points come
from a bounded sample (a scalar subquery), every range is handled by its own
task, and only the per-range totals (at most ``parts`` rows per group) are summed
in order. All of it is one lazy plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MIN_PARTS, MAX_PARTS = 64, 10_000
SAMPLE = 16          # rows looked at per range when the ranges are chosen


def session_parts(df: DataFrame, parts: int | None = None) -> int:
    """As many ranges as the session has shuffle partitions, so the ranges grow with the
    cluster the data needs."""
    if parts:
        return parts
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(MIN_PARTS, min(wanted, MAX_PARTS))


def split_points(df: DataFrame, col: str, parts: int, unique: Sequence[str] = ()) -> Column:
    """About ``SAMPLE`` values per range, sorted, every ``SAMPLE``-th of which is a split point: an
    array-valued scalar subquery.

    The sample is the rows whose hash (of ``unique``, the columns that tell rows apart) is below
    its share of all rows, so every task picks its own; nothing is merged but the values picked, whose number
    depends on ``parts`` alone. The same rows are picked whenever it is evaluated.
    """
    n = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    share = F.lit(float(parts * SAMPLE)) / F.greatest(n, F.lit(1))
    place = F.pmod(F.xxhash64(*(unique or [col])), F.lit(2**40)) / F.lit(float(2**40))
    picked = df.filter(place < share).agg(F.sort_array(F.collect_list(col)).alias("s"))
    step = F.greatest(F.lit(1), (F.size("s") / parts).cast("int"))
    return picked.select(
        F.when(F.size("s") > 1, F.transform(
            F.sequence(F.lit(1), F.size("s"), step), lambda i: F.element_at("s", i)
        )).otherwise(F.col("s")).alias("e")
    ).scalar()


def with_range(df: DataFrame, order: str, source: DataFrame, parts: int, name: str = "_b",
               unique: Sequence[str] = ()) -> DataFrame:
    """Adds how many split points lie below the value; monotone in the value.

    Found in two steps (every k-th point, then the k points after it), so a row costs
    about twice the square root of ``parts`` comparisons.
    """
    k = max(1, int(parts ** 0.5))
    v = F.col(order)
    pts = df.withColumn("_pts", F.coalesce(split_points(source, order, parts, unique), F.array().cast(
        f"array<{source.schema[order].dataType.simpleString()}>")))
    coarse = F.filter(F.sequence(F.lit(1), F.greatest(F.size("_pts"), F.lit(1)), F.lit(k)),
                      lambda i: F.get(F.col("_pts"), i - 1) < v)
    pts = pts.withColumn("_k", F.size(coarse))
    base = F.greatest((F.col("_k") - 1) * k, F.lit(0))
    fine = F.size(F.filter(F.slice("_pts", base + 1, k), lambda e: e < v))
    return pts.withColumn(name, F.when(F.col("_k") > 0, base + fine).otherwise(F.lit(0))).drop("_pts", "_k")


def running_totals(
    df: DataFrame, order: str, sums: Sequence[str], by: Sequence[str] = (),
    descending: bool = False, parts: int | None = None,
) -> DataFrame:
    """Adds ``<s>_run`` (inclusive running sum) and ``<s>_all`` (group total).

    ``df`` must hold one row per (by, order): aggregate first, so ties and hot
    values are already one row.
    """
    by = list(by)
    b = with_range(df, order, df, session_parts(df, parts), unique=[*by, order])
    tot = b.groupBy(*by, "_b").agg(*[F.sum(s).alias(s) for s in sums])
    first = F.col("_b").desc() if descending else F.col("_b").asc()
    before = Window.partitionBy(*by).orderBy(first).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    off = tot.select(
        *by, "_b",
        *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"{s}_off") for s in sums],
        *[F.sum(s).over(whole).alias(f"{s}_all") for s in sums],
    )
    ordering = F.col(order).desc() if descending else F.col(order).asc()
    inside = Window.partitionBy(*by, "_b").orderBy(ordering).rowsBetween(Window.unboundedPreceding, 0)
    joined = null_safe_join(b, off, by + ["_b"])
    return joined.select(
        *df.columns,
        *[(F.col(f"{s}_off") + F.sum(s).over(inside)).alias(f"{s}_run") for s in sums],
        *[f"{s}_all" for s in sums],
    )


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match; right key columns are dropped."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in right.columns])
    cond = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def exact_quantiles(
    df: DataFrame, value: str, probs: Mapping[str, float], by: Sequence[str] = (), parts: int | None = None,
) -> DataFrame:
    """Interpolated quantiles, exact, per group; one output column per name.

    Equal values collapse into one weighted row before anything is ordered, so
    neither a hot group nor a hot value lands in one task.
    """
    by = list(by)
    vals = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    )
    run = running_totals(vals, "_v", ["_c"], by, parts=parts)
    lo_rank, hi_rank = F.col("_c_run") - F.col("_c"), F.col("_c_run")
    picks, outs = [], []
    for i, (name, q) in enumerate(probs.items()):
        pos = (F.col("_c_all") - 1) * F.lit(float(q))
        for side, at in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            picks.append(F.max(F.when((at >= lo_rank) & (at < hi_rank), F.col("_v"))).alias(f"_{side}{i}"))
        lo, hi = F.col(f"_lo{i}").cast("double"), F.col(f"_hi{i}").cast("double")
        opos = (F.col("_n") - 1) * F.lit(float(q))
        outs.append((lo + (hi - lo) * (opos - F.floor(opos))).alias(name))
    picks.append(F.max("_c_all").alias("_n"))
    return run.groupBy(*by).agg(*picks).select(*by, *outs)


def dense_index(df: DataFrame, key: str, name: str = "doc_index", parts: int | None = None) -> DataFrame:
    """0-based dense ids in key order (unique key), each range numbered by its own task."""
    b = with_range(df, key, df, session_parts(df, parts))
    tot = b.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    rn = F.row_number().over(Window.partitionBy("_b").orderBy(key))
    return b.join(off, "_b").select((F.col("_off") + rn - 1).cast("long").alias(name), *df.columns)


def rank_by_hash(df: DataFrame, hash_col: str, by: Sequence[str], tie: str, prefix: int = 4) -> DataFrame:
    """Adds ``_rank`` (1-based, by hex hash) and ``_n`` (group size) per group.

    The leading hex digits of a hash are uniform, so they split even a group that
    holds most of the table into equal ranges.
    """
    by = list(by)
    b = df.withColumn("_b", F.substring(hash_col, 1, prefix))
    tot = b.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(
        *by, "_b", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"),
        F.sum("_c").over(Window.partitionBy(*by)).alias("_n"),
    )
    rn = F.row_number().over(Window.partitionBy(*by, "_b").orderBy(hash_col, tie))
    return null_safe_join(b, off, by + ["_b"]).select(
        *df.columns, (F.col("_off") + rn).alias("_rank"), "_n"
    )
