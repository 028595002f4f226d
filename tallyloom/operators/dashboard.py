"""Filters, option lists, detail view and dashboard tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filter_cases(df: DataFrame, columns: Sequence[str], **equals) -> DataFrame:
    """Q1: only the predicates that are given; they reach the Parquet scan."""
    for c, v in equals.items():
        if v is not None:
            df = df.filter(F.col(c) == v)
    return df.select(*columns)


def filter_in(df: DataFrame, agency: str, value: str, bureau: str, bureaus: Sequence[str] = ()) -> DataFrame:
    """Q2: an empty bureau list means all."""
    df = df.filter(F.col(agency) == value)
    return df.filter(F.col(bureau).isin(*bureaus)) if bureaus else df


def distinct_options(df: DataFrame, col: str, **parents) -> DataFrame:
    """Q3: sorted non-NULL values, narrowed by the chosen parents."""
    for c, v in parents.items():
        if v is not None:
            df = df.filter(F.col(c) == v)
    return df.filter(F.col(col).isNotNull()).select(col).distinct().orderBy(col)


def case_detail(df: DataFrame, key: str, value, fields: Mapping[str, str]) -> DataFrame:
    """Q4: (label, value) rows of one case, blank fields left out."""
    one = df.filter(F.col(key) == value).select(
        *[F.col(c).cast("string").alias(label) for c, label in fields.items()])
    long = one.unpivot([], list(fields.values()), "label", "value")
    return long.filter(F.trim("value") != "")


def bureau_status_counts(df: DataFrame, bureau: str, status: str) -> DataFrame:
    """A17."""
    return df.filter(F.col(bureau).isNotNull() & F.col(status).isNotNull()).groupBy(bureau, status).agg(
        F.count(F.lit(1)).alias("count"))


def agency_dashboard(df: DataFrame, metrics: Mapping[str, str]) -> DataFrame:
    """All one-column counts in a single pass, (metric, value, count)."""
    wide = df.select(*[F.col(c).cast("string").alias(m) for m, c in metrics.items()])
    return wide.unpivot([], list(metrics), "metric", "value").filter(F.col("value").isNotNull()).groupBy(
        "metric", "value").agg(F.count(F.lit(1)).alias("count"))
