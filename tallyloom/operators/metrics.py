"""Splits, weights and classifier measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import strip
from ..plans.ranges import rank_by_hash, running_totals
from ..plans.skew import HOT_ROWS, lookup_by_weight
from .aggregates import histogram


def stratified_split(df: DataFrame, label: str, key: str, test: float = 0.25, seed: str = "") -> DataFrame:
    """M1: adds ``is_test``; exactly round(test x n) rows per label, repeatable for a seed.

    Rows are ranked by hash inside hash ranges, so a label with most of the rows is
    spread over many tasks.
    """
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(seed)))
    r = rank_by_hash(df.withColumn("_h", h), "_h", [label], key)
    return r.withColumn("is_test", F.col("_rank") <= F.round(F.col("_n") * F.lit(test))).drop("_h", "_rank", "_n")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """M2: n / (classes x class size) per class."""
    n = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    tot = n.agg(F.struct(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))).scalar()
    return n.select(label, "n", (tot["n"].cast("double") / (tot["k"] * F.col("n"))).alias("weight"))


def with_class_weights(df: DataFrame, label: str, name: str = "class_weight", hot_rows: int = HOT_ROWS) -> DataFrame:
    """M2 on the rows."""
    w = class_weights(df, label).withColumnRenamed("weight", name).withColumnRenamed("n", "_n")
    return lookup_by_weight(df, w, [label], "_n", hot_rows).drop("_n")


def accuracy(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """M7."""
    return df.agg(F.avg((F.col(y) == F.col(yhat)).cast("int")).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, y: str, yhat: str, labels: Sequence[int]) -> DataFrame:
    """M7: (actual, predicted, n) with empty cells as 0, in one pass."""
    cells = [(a, p) for a in labels for p in labels]
    row = df.agg(*[F.count_if((F.col(y) == a) & (F.col(yhat) == p)).alias(str(i)) for i, (a, p) in enumerate(cells)])
    long = row.unpivot([], [str(i) for i in range(len(cells))], "i", "n")
    at = F.col("i").cast("int") + 1
    return long.select(
        F.element_at(F.array(*[F.lit(a) for a, _ in cells]), at).alias("actual"),
        F.element_at(F.array(*[F.lit(p) for _, p in cells]), at).alias("predicted"), "n")


def classification_report(confusion: DataFrame) -> DataFrame:
    """M8: precision, recall, F1, support per class, then macro and weighted means; 0/0 is 0."""
    z = lambda a, b: F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))
    act = confusion.groupBy(F.col("actual").alias("c")).agg(
        F.sum("n").alias("support"), F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)).alias("tp"))
    pre = confusion.groupBy(F.col("predicted").alias("c")).agg(F.sum("n").alias("guessed"))
    p, r = z(F.col("tp"), F.col("guessed")), z(F.col("tp"), F.col("support"))
    per = act.join(pre, "c").select(F.col("c").cast("string").alias("label"), p.alias("precision"), r.alias("recall"),
                                    z(2 * p * r, p + r).alias("f1"), "support")
    names = ("precision", "recall", "f1")
    macro = per.agg(F.lit("macro avg").alias("label"), *[F.avg(x).alias(x) for x in names], F.sum("support").alias("support"))
    wide = per.agg(F.lit("weighted avg").alias("label"),
                   *[z(F.sum(F.col(x) * F.col("support")), F.sum("support")).alias(x) for x in names],
                   F.sum("support").alias("support"))
    return per.unionByName(macro).unionByName(wide)


def _score_counts(df: DataFrame, y: Column, score: str) -> DataFrame:
    """Positives and negatives at or above each score; ties are one row."""
    s = df.filter(y.isNotNull() & F.col(score).isNotNull()).groupBy(F.col(score).alias("score")).agg(
        F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))
    return running_totals(s, "score", ["pos", "neg"], descending=True)


def roc_curve(df: DataFrame, y: Column, score: str) -> DataFrame:
    """M9: one point per distinct score; no positives or no negatives, no curve."""
    c = _score_counts(df, y, score).filter((F.col("pos_all") > 0) & (F.col("neg_all") > 0))
    return c.select("score", (F.col("neg_run") / F.col("neg_all")).alias("fpr"), (F.col("pos_run") / F.col("pos_all")).alias("tpr"))


def roc_auc(df: DataFrame, y: Column, score: str) -> DataFrame:
    """M9: trapezoids from each point and its own step, so no lag over the whole curve."""
    c = _score_counts(df, y, score)
    area = F.sum(F.col("neg") * (F.col("pos_run") * 2 - F.col("pos")) / 2.0)
    return c.agg(F.try_divide(area, F.max("pos_all") * F.max("neg_all")).alias("auc"))


def pr_curve(df: DataFrame, y: Column, score: str) -> DataFrame:
    """M10."""
    c = _score_counts(df, y, score).filter("pos_all > 0")
    return c.select("score", (F.col("pos_run") / (F.col("pos_run") + F.col("neg_run"))).alias("precision"),
                    (F.col("pos_run") / F.col("pos_all")).alias("recall"))


def average_precision(df: DataFrame, y: Column, score: str) -> DataFrame:
    """Step sum of precision over the recall gained at each score."""
    c = _score_counts(df, y, score)
    step = F.col("pos") / F.col("pos_all") * F.col("pos_run") / (F.col("pos_run") + F.col("neg_run"))
    return c.agg(F.sum(F.when(F.col("pos_all") > 0, step)).alias("average_precision"))


def probability_histogram(df: DataFrame, p: str, y: str, bins: int = 30) -> DataFrame:
    """M12."""
    return histogram(df, p, bins, [y])


def flag_mismatch(label: Column, predicted: Column) -> Column:
    """Answered "neither" but predicted to have an impact; NULL label is no flag."""
    return F.coalesce((F.lower(strip(label)) == "neither") & (predicted != "Neither"), F.lit(False))


def flagged_by_bureau(df: DataFrame, bureau: str, label: str, predicted: str) -> DataFrame:
    """Flags per bureau among labelled rows; bureaus without a flag stay, NULL ones go."""
    src = df.filter(F.col(label).isNotNull() & F.col(bureau).isNotNull())
    return src.groupBy(bureau).agg(F.count_if(flag_mismatch(F.col(label), F.col(predicted))).alias("flagged"))
