"""Joining facts to per-key statistics when one key may hold a third of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000


def lookup_by_weight(
    fact: DataFrame, dim: DataFrame, keys: Sequence[str], weight: str,
    hot_rows: int = HOT_ROWS, spread: int = 512,
) -> DataFrame:
    """Left join ``dim`` (one row per key) on to ``fact``, whole and skew-proof.

    ``weight`` is the number of fact rows with that key. Keys of at least
    ``hot_rows`` rows go by broadcast: there can be at most |fact| / hot_rows of
    them, whatever the data. All other keys go by a shuffled join whose largest
    group is therefore below ``hot_rows``; hot rows carry a spread value there, so
    they are scattered instead of meeting in one task.
    """
    keys = list(keys)
    values = [c for c in dim.columns if c not in keys]
    hot = dim.filter(F.col(weight) >= hot_rows).select(
        *[F.col(k).alias(f"_h_{k}") for k in keys],
        *[F.col(v).alias(f"_hot_{v}") for v in values], F.lit(True).alias("_hot"),
    )
    cold = dim.filter(F.col(weight) < hot_rows).select(
        *[F.col(k).alias(f"_c_{k}") for k in keys],
        *[F.col(v).alias(f"_cold_{v}") for v in values], F.lit(0).alias("_c_spread"),
    )
    marked = fact.join(
        F.broadcast(hot), [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in keys], "left"
    ).withColumn(
        "_spread",
        F.when(F.col("_hot"), 1 + F.pmod(F.xxhash64(*[F.col(c) for c in fact.columns]), F.lit(spread))
               .cast("int")).otherwise(0),
    )
    joined = marked.join(
        cold,
        [F.col(k).eqNullSafe(F.col(f"_c_{k}")) for k in keys] + [F.col("_spread") == F.col("_c_spread")],
        "left",
    )
    return joined.select(
        *fact.columns, *[F.coalesce(f"_hot_{v}", f"_cold_{v}").alias(v) for v in values]
    )


def attach_group_size(df: DataFrame, keys: Sequence[str], name: str = "group_size",
                      hot_rows: int = HOT_ROWS) -> DataFrame:
    """Adds the size of each row's group; groups are counted map-side first."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return lookup_by_weight(df, sizes, keys, name, hot_rows)


def use_all_cores(df: DataFrame) -> DataFrame:
    """Deal rows out when the file layout gives fewer tasks than there are cores (a few
    unsplittable files); a layout with enough splits is left alone, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
