"""Top-k, duplicates, reshapes, word-set algebra."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cleaning import strip
from ..functions.vectors import argmax
from ..plans.skew import HOT_ROWS, attach_group_size


def top_k_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int,
                    rank: str = "rank") -> DataFrame:
    """Spark limits every group on the map side before the shuffle
    (WindowGroupLimit), so a hot group sends at most k rows per task."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def best_per_key(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """W2."""
    return top_k_per_group(df, by, order, 1, "_rank").drop("_rank")


def multi_key_best(df: DataFrame, order: Sequence[Column], n: int = 1) -> DataFrame:
    """Bounded top-n, merged on the driver from n rows per task."""
    return df.orderBy(*order).limit(n)


def constrained_best(df: DataFrame, constraint: Column, order: Sequence[Column]) -> DataFrame:
    """Best row meeting the constraint, else the best row, in one pass."""
    return df.orderBy(F.desc(F.coalesce(constraint, F.lit(False))), *order).limit(1)


def duplicated(df: DataFrame, text: str, name: str = "is_duplicate", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every member of a group of equal normalised texts.

    Counted per 128-bit digest on the map side; the counts go back by a skew-proof
    lookup, so a text copied into a third of all rows is no hot task.
    """
    norm = strip(F.lower(F.col(text)))
    sized = attach_group_size(df.withColumn("_digest", F.md5(norm)), ["_digest"], "_size", hot_rows)
    return sized.withColumn(name, F.col("_size") > 1).drop("_digest", "_size")


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], var: str = "variable",
         value: str = "value") -> DataFrame:
    """W6."""
    return df.unpivot(list(ids), list(values), var, value)


def one_hot(df: DataFrame, col: str, values: Sequence, prefix: str, sep: str = "=") -> DataFrame:
    """0/1 column per listed value."""
    return df.select("*", *[F.when(F.col(col) == v, 1).otherwise(0).alias(f"{prefix}{sep}{v}") for v in values])


def explode_probs(df: DataFrame, key: str, probs: str) -> DataFrame:
    """(key, topic, prob)."""
    return df.select(key, F.posexplode(probs).alias("topic", "prob"))


def spread_probs(df: DataFrame, probs: str, k: int, prefix: str = "lda_t", topic: str | None = None) -> DataFrame:
    """One column per topic; rows without a topic become zeros if ``topic`` is given."""
    def cell(i: int) -> Column:
        c = F.get(F.col(probs), F.lit(i))
        return F.when(F.col(topic) >= 0, c).otherwise(F.lit(0.0)) if topic else c
    return df.select(*[c for c in df.columns if c != probs], *[cell(i).alias(f"{prefix}{i}") for i in range(k)])


def dominant(df: DataFrame, probs: str, names: Mapping[str, str] | None = None) -> DataFrame:
    """First largest position and its probability."""
    names = names or {"topic": "topic", "prob": "prob"}
    return df.withColumns({names["topic"]: argmax(F.col(probs)), names["prob"]: F.array_max(probs)})


def word_set(base: DataFrame, add: Sequence[DataFrame] = (), minus: DataFrame | None = None,
             word: str = "word") -> DataFrame:
    """Union of word frames without the protected words."""
    out = base.select(word)
    for a in add:
        out = out.union(a.select(word))
    out = out.distinct()
    return out.join(minus.select(word).distinct(), word, "left_anti") if minus is not None else out
