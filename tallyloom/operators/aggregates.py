"""Counts, shares, crosstabs, year tables, histograms.

Wide tables use conditional aggregates over a given value list: one shuffle, fully
combined on the map side, so a hot group costs one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..plans.ranges import exact_quantiles
from ..plans.skew import lookup_by_weight


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def value_counts(df: DataFrame, col: str, dropna: bool = True, normalize: bool = False) -> DataFrame:
    """A1: (value, count[, pct]), largest first, ties by value."""
    src = df.filter(F.col(col).isNotNull()) if dropna else df
    counts = src.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    if normalize:
        whole = counts.agg(F.sum("count")).scalar()
        counts = counts.withColumn("pct", F.col("count") * 100.0 / whole)
    return counts.orderBy(F.desc("count"), "value")


def counts_in_order(df: DataFrame, col: str, order: Sequence[str], other: str | None = None) -> DataFrame:
    """A2: one row per listed label (0 when absent), optional remainder row; the
    percentage is of the rows shown."""
    c = F.col(col)
    one = [F.count_if(c == v).alias(str(i)) for i, v in enumerate(order)]
    labels = list(order)
    if other is not None:
        one.append(F.count_if(~F.coalesce(c.isin(*order), F.lit(False))).alias(str(len(order))))
        labels.append(other)
    names = F.array(*[F.lit(x) for x in labels])
    cols = [str(i) for i in range(len(labels))]
    row = df.agg(*one).withColumn("total", sum((F.col(f"`{i}`") for i in cols), F.lit(0)))
    long = row.unpivot(["total"], cols, "pos", "count")
    return long.select(
        F.col("pos").cast("int").alias("position"),
        F.element_at(names, F.col("pos").cast("int") + 1).alias("label"), "count",
        F.round(F.try_divide(F.col("count") * 100.0, F.col("total")), 1).alias("pct"),
    ).orderBy("position")


def counts_preferred(df: DataFrame, col: str, order: Sequence[str]) -> DataFrame:
    """A2, second form: listed labels that occur come first, the rest follow by size."""
    pos = F.array_position(F.array(*[F.lit(v) for v in order]), F.col("value"))
    vc = value_counts(df, col)
    return vc.withColumn("position", F.when(pos > 0, pos).otherwise(len(order) + 1).cast("int")).orderBy(
        "position", F.desc("count"), "value")


def top_n_counts(df: DataFrame, col: str, n: int, dropna: bool = False) -> DataFrame:
    """A3: n largest values with their share of the grand total."""
    return value_counts(df, col, dropna, normalize=True).limit(n)


def crosstab(df: DataFrame, a: str, b: str, values: Sequence, normalize: str = "none",
             digits: int | None = None, names: Sequence[str] | None = None) -> DataFrame:
    """A5: one row per non-NULL ``a``, one column per listed ``b``."""
    names = list(names or [str(v) for v in values])
    src = df.filter(F.col(a).isNotNull() & F.col(b).isin(*values))
    ct = src.groupBy(a).agg(*[F.count_if(F.col(b) == v).alias(n) for v, n in zip(values, names)])
    if normalize == "none":
        return ct
    if normalize == "index":
        whole = sum((F.col(f"`{n}`") for n in names), F.lit(0))
        cells = {n: F.try_divide(F.col(f"`{n}`").cast("double"), whole) for n in names}
    elif normalize == "columns":
        tot = ct.agg(F.struct(*[F.sum(f"`{n}`").alias(f"t{i}") for i, n in enumerate(names)])).scalar()
        cells = {n: F.try_divide(F.col(f"`{n}`").cast("double"), tot[f"t{i}"]) for i, n in enumerate(names)}
    else:
        raise ValueError(f"unknown normalize {normalize!r}")
    return ct.select(a, *[(F.round(x, digits) if digits is not None else x).alias(n) for n, x in cells.items()])


def group_proportions(df: DataFrame, g: str, c: str, values: Sequence[str]) -> DataFrame:
    """A4: within-group shares over all non-NULL answers, 0 filled."""
    return df.filter(F.col(g).isNotNull()).groupBy(g).agg(
        *[F.coalesce(F.try_divide(F.count_if(F.col(c) == v).cast("double"), F.count(c)), F.lit(0.0)).alias(v)
          for v in values])


IMPACT_TYPES = ("Rights-impacting", "Safety-impacting", "Both")


def impact_counts(df: DataFrame, agency: str, impact: str) -> DataFrame:
    """Per agency: all rows and rows of each impactful type; NULL agency is Unknown."""
    i = F.col(impact)
    return df.groupBy(F.coalesce(agency, F.lit("Unknown")).alias("agency")).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(i == t).alias(n) for t, n in zip(IMPACT_TYPES, ("rights", "safety", "both"))],
        F.count_if(i.isin(*IMPACT_TYPES)).alias("impact_count"),
    )


def impact_share_by_agency(df: DataFrame, agency: str, impact: str) -> DataFrame:
    """Shares of all rows; agencies with at least one impactful row, largest share first."""
    return (
        impact_counts(df, agency, impact).filter("impact_count > 0")
        .select("agency", "total", "impact_count",
                *[(F.col(c).cast("double") / F.col("total")).alias(f"{c}_share") for c in ("rights", "safety", "both")],
                (F.col("impact_count").cast("double") / F.col("total")).alias("impact_share"))
        .orderBy(F.desc("impact_share"), "agency")
    )


def impact_summary(df: DataFrame, agency: str, impact: str, low_cut: int = 3) -> DataFrame:
    """Counts and percentage of all rows, with a flag for very small counts."""
    return impact_counts(df, agency, impact).filter("impact_count > 0").select(
        "agency", "impact_count", "total",
        (F.col("impact_count").cast("double") / F.col("total")).alias("impact_pct"),
        "rights", "safety", "both", (F.col("impact_count") <= low_cut).alias("low_count"),
    )


def both_ends(df: DataFrame, by: str, tie: str, n: int = 10) -> DataFrame:
    """N best and n worst rows; two bounded top-n scans, no global rank."""
    top = df.orderBy(F.desc(by), tie).limit(n).withColumn("side", F.lit("top"))
    bottom = df.orderBy(by, F.desc(tie)).limit(n).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom)


def flag_rate(df: DataFrame, flag: Column) -> DataFrame:
    """Rows, flagged rows, percentage."""
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if(flag).alias("flagged")).withColumn(
        "pct", F.try_divide(F.col("flagged") * 100.0, "total"))


def rate_by_group(df: DataFrame, g: str, flag: Column) -> DataFrame:
    """Percentage and size per group, largest rate then largest group first."""
    return (
        df.filter(F.col(g).isNotNull()).groupBy(g)
        .agg((F.count_if(flag) * 100.0 / F.count(F.lit(1))).alias("rate"), F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("rate"), F.desc("n"), g)
    )


def small_group_filter(rates: DataFrame, min_rate: float, max_n: int) -> DataFrame:
    """A10: high rate in a small group."""
    return rates.filter((F.col("rate") >= min_rate) & (F.col("n") <= max_n))


def _years(df: DataFrame, date: str) -> DataFrame:
    return df.filter(F.col(date).isNotNull()).withColumn("year", F.year(date).cast("long"))


def counts_by_year(df: DataFrame, date: str) -> DataFrame:
    """A11."""
    return _years(df, date).groupBy("year").agg(F.count(F.lit(1)).alias("count")).orderBy("year")


def share_by_year(df: DataFrame, date: str, flag: Column) -> DataFrame:
    """A12."""
    return _years(df, date).groupBy("year").agg(
        (F.count_if(flag) * 100.0 / F.count(F.lit(1))).alias("share")).orderBy("year")


def mix_by_year(df: DataFrame, date: str, cls: str, classes: Sequence[str]) -> DataFrame:
    """Class mix in percent of the year's classified rows."""
    y = _years(df, date).filter(F.col(cls).isNotNull())
    return y.groupBy("year").agg(
        *[(F.count_if(F.col(cls) == c) * 100.0 / F.count(F.lit(1))).alias(c) for c in classes]).orderBy("year")


def year_by_category(df: DataFrame, date: str, cat: str, cats: Sequence[str]) -> DataFrame:
    """Count matrix with row totals."""
    y = _years(df, date).filter(F.col(cat).isin(*cats))
    return y.groupBy("year").agg(
        *[F.count_if(F.col(cat) == c).alias(c) for c in cats], F.count(F.lit(1)).alias("total")).orderBy("year")


def heat_pct(df: DataFrame, date: str, cat: str, cats: Sequence[str], flag: Column) -> DataFrame:
    """Percentage flagged and n, year by category; empty cells are NULL and 0."""
    y = _years(df, date)
    cells = []
    for c in cats:
        here = F.col(cat) == c
        n = F.count_if(here)
        cells += [F.round(F.try_divide(F.count_if(here & flag) * 100.0, n), 1).alias(f"{c}_pct"), n.alias(f"{c}_n")]
    return y.groupBy("year").agg(*cells).orderBy("year")


def peak_period(df: DataFrame, date: str, cat: str) -> DataFrame:
    """Year of the largest count per category, earliest on ties."""
    n = _years(df, date).groupBy(F.col(cat).alias("category"), "year").agg(F.count(F.lit(1)).alias("n"))
    best = F.max(F.struct("n", (-F.col("year")).alias("neg_year")))
    return n.groupBy("category").agg(best.alias("b")).select(
        "category", (-F.col("b.neg_year")).alias("peak_year"), F.col("b.n").alias("peak_count"))


def topic_health(df: DataFrame, topic: str, tiny: int = 6) -> DataFrame:
    """Outlier rate, number of topics, share of topics below ``tiny`` rows (1 if none)."""
    sizes = df.groupBy(F.col(topic).alias("t")).agg(F.count(F.lit(1)).alias("n"))
    real = F.col("t") >= 0
    return sizes.agg(
        F.try_divide(F.sum(F.when(F.col("t") < 0, F.col("n")).otherwise(0)).cast("double"), F.sum("n")).alias("outlier_rate"),
        F.count_if(real).alias("n_topics"),
        F.coalesce(F.try_divide(F.count_if(real & (F.col("n") < tiny)).cast("double"), F.count_if(real)), F.lit(1.0))
        .alias("tiny_topic_share"),
    )


def group_median(df: DataFrame, g: str, v: str) -> DataFrame:
    """Exact interpolated median per group."""
    return exact_quantiles(df, v, {"median": 0.5}, [g])


def prob_bins(df: DataFrame, p: str) -> DataFrame:
    """Four fixed confidence bins with counts and percentage of all rows."""
    c = F.col(p)
    label = (F.when((c >= 0) & (c < 0.20), "<0.20").when((c >= 0.20) & (c < 0.35), "0.20-0.35")
             .when((c >= 0.35) & (c < 0.50), "0.35-0.50").when((c >= 0.50) & (c < 1.01), ">=0.50"))
    binned = df.select(label.alias("bin"))
    return counts_in_order(binned, "bin", ["<0.20", "0.20-0.35", "0.35-0.50", ">=0.50"])


def quantile_bins(df: DataFrame, v: str, bins: int = 4) -> DataFrame:
    """Bins by interpolated quantile edges; equal values always share a bin."""
    probs = {f"e{i}": i / bins for i in range(1, bins)}
    edges = exact_quantiles(df, v, probs).select(F.struct(*probs).alias("e")).scalar()
    b = F.lit(1)
    for name in probs:
        b = b + F.when(F.col(v) > edges[name], 1).otherwise(0)
    return df.filter(F.col(v).isNotNull()).groupBy(b.alias("quartile")).agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, v: str, bins: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins, last one closed; default max(10, floor(sqrt n))."""
    by = list(by)
    x = F.col(v).cast("double")
    nb = F.lit(bins).cast("long") if bins else F.greatest(F.lit(10), F.floor(F.sqrt(F.count(v)))).cast("long")
    stats = F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"), nb.alias("bins"))
    src = df.filter(F.col(v).isNotNull())
    if by:
        # A class with most of the rows meets its bounds where its rows lie.
        src = lookup_by_weight(src, src.groupBy(*by).agg(stats.alias("_s"), F.count(F.lit(1)).alias("_n")), by, "_n").drop("_n")
        s = F.col("_s")
    else:
        s = src.agg(stats).scalar()
    width = (s["hi"] - s["lo"]) / s["bins"]
    b = F.when(width > 0, F.least(s["bins"] - 1, F.floor((x - s["lo"]) / width))).otherwise(F.floor(s["bins"] / 2))
    return src.groupBy(*by, b.cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def lifecycle(df: DataFrame, key: str, created: str = "created", retired: str = "retired") -> DataFrame:
    """Days from created to retired where both are known."""
    return df.filter(F.col(created).isNotNull() & F.col(retired).isNotNull()).select(
        key, D.lifecycle_days(F.col(created), F.col(retired)).alias("days"))
