"""Column profiling (P1-P6): one pass over the table, never one job per column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.ranges import exact_quantiles

_DATES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def long_values(df: DataFrame) -> DataFrame:
    """(column, value) with every cell as text."""
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    return text.unpivot([], df.columns, "column", "value")


def column_stats(df: DataFrame, long_chars: int = 100) -> DataFrame:
    """P1. Cells are counted per (column, digest, length) first: a repeated answer crosses
    the network once per task, a long narrative as 32 characters, and a column of one
    hot value is no hot group."""
    cells = long_values(df).select("column", F.md5("value").alias("h"), F.length("value").alias("len"))
    vals = cells.groupBy("column", "h", "len").agg(F.count(F.lit(1)).alias("c"))
    # Splitting each column's values over many partial groups keeps wide columns parallel.
    part = vals.groupBy("column", F.pmod(F.xxhash64("h"), F.lit(64)).alias("_p")).agg(
        F.sum("c").alias("n"),
        F.sum(F.when(F.col("h").isNotNull(), F.col("c")).otherwise(0)).alias("nn"),
        F.count("h").alias("nunique"),
        F.sum(F.col("len") * F.col("c")).alias("chars"),
        F.sum(F.when(F.col("len") > long_chars, F.col("c")).otherwise(0)).alias("n_long"),
    )
    s = part.groupBy("column").agg(*[F.sum(x).alias(x) for x in ("n", "nn", "nunique", "chars", "n_long")])
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    kinds = {f.name: ("numeric" if isinstance(f.dataType, T.NumericType) else
                      "date" if isinstance(f.dataType, _DATES) else "text") for f in df.schema.fields}
    kind = F.element_at(F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv]), F.col("column"))
    return s.select(
        "column", "n", "nn",
        (1 - F.try_divide("nn", "n")).alias("na_pct"),
        (kind == "numeric").alias("is_numeric"),
        (kind == "date").alias("is_datetime"),
        "nunique",
        zero(F.try_divide("nunique", "nn")).alias("card_ratio"),
        zero(F.try_divide("chars", "nn")).alias("avg_len"),
        zero(F.try_divide("n_long", "nn")).alias("pct_long"),
    )


def classify_columns(stats: DataFrame, min_rows: int = 50, na_max: float = 0.98, open_len: float = 80,
                     open_long: float = 0.30, cat_card: float = 0.05, cat_len: float = 60) -> DataFrame:
    """P2."""
    cls = (
        F.when((F.col("n") < min_rows) | (F.col("na_pct") >= na_max), "ignored (too sparse)")
        .when(F.col("is_numeric") | F.col("is_datetime"), "dates/ids/numeric")
        .when((F.col("avg_len") >= open_len) | (F.col("pct_long") >= open_long), "open_ended")
        .when((F.col("card_ratio") <= cat_card) & (F.col("avg_len") <= cat_len), "categorical")
        .otherwise("other_text")
    )
    return stats.withColumn("class", cls)


def column_roles(stats: DataFrame, forced_open: Sequence[str] = ()) -> DataFrame:
    """Few distinct answers win over length; named columns are always open-ended."""
    role = (
        F.when(F.col("column").isin(*forced_open) if forced_open else F.lit(False), "open_ended")
        .when(F.col("is_numeric") | F.col("is_datetime"), "numeric/date")
        .when((F.col("nunique") <= 25) & (F.col("card_ratio") <= 0.05), "categorical")
        .when((F.col("avg_len") >= 80) | (F.col("card_ratio") >= 0.25), "open_ended")
        .otherwise("other_text")
    )
    return stats.withColumn("role", role)


def missing_pct(df: DataFrame) -> DataFrame:
    """One aggregate row, then unpivoted; no cell is exploded."""
    one = df.agg(*[(F.count(F.when(F.col(f"`{c}`").isNull(), 1)) * 100 / F.count(F.lit(1))).alias(c)
                   for c in df.columns])
    return one.unpivot([], df.columns, "column", "missing_pct")


def missing_matrix(df: DataFrame, key: str) -> DataFrame:
    """P5: NULL flag per cell."""
    return df.select(key, *[F.col(f"`{c}`").isNull().alias(c) for c in df.columns if c != key])


def describe(df: DataFrame, value: str, probs=((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))) -> DataFrame:
    """Count, mean, sample deviation, min, exact interpolated quantiles, max."""
    v = F.col(value).cast("double")
    base = df.agg(
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"),
    )
    names = [name for _, name in probs]
    q = exact_quantiles(df, value, {name: p for p, name in probs}).select(F.struct(*names).alias("q")).scalar()
    return base.withColumn("_q", q).select(*base.columns, *[F.col(f"_q.{n}").alias(n) for n in names])


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})
