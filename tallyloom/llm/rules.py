"""Quality rules: decision lists learned from labelled statistics, applied as Spark expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .registry import query, table
from .util import SPACES, UPPER, is_blank, saved

SYMBOLS = "#*$%&|<>"  # fixed value
WINDOW = 8
FEATURES = ("n_words", "mean_word", "symbol_rate", "upper_rate", "mark_rate", "digit_rate", "dup_line_rate",
            "repeat_rate", "distinct_rate", "line_words")


def _without(text: str, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def _with_later(step: int):
    return lambda h, i: F.xxhash64(h, F.get(F.col("_h"), i + step))


def text_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds counts and the rates in FEATURES; built-in functions only, no shuffle.

    n_words: runs of anything but ASCII white space; word_chars: their code points; n_symbols:
    characters of ``#*$%&|<>``; n_dup_lines: lines with a word that equal an earlier line;
    n_repeat_words: words inside 8-word windows that occur twice or more in the text, the
    first occurrence included. Windows are hashed by doubling (pairs, pairs of pairs, ...), so
    a word costs four hashes; only texts in which a window repeats sort their windows.

    Null or empty text: all zero, rates zero. Existing columns with these names are replaced.
    """
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *FEATURES]
    keep = [c for c in docs.columns if c not in added]
    t = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.struct(*keep).alias("_row"), t.alias("_t"))
    d = d.select("_row", "_t", F.array_remove(F.split(F.translate("_t", SPACES, " " * len(SPACES)), " "), "").alias("_w"))
    lines = F.filter(F.split("_t", "\n"), lambda x: ~is_blank(x))
    d = d.select(
        "_row", "_t", F.size("_w").cast("long").alias("n_words"), _without("_t", SPACES).cast("long").alias("word_chars"),
        (F.length("_t") - _without("_t", SYMBOLS)).cast("long").alias("n_symbols"),
        (F.length("_t") - _without("_t", UPPER)).alias("_upper"), (F.length("_t") - _without("_t", "!?.,;:")).alias("_marks"),
        (F.length("_t") - _without("_t", "0123456789")).alias("_digits"), lines.alias("_lines"),
        F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"),
    )
    d = d.select("*", F.size("_lines").alias("_n_lines"), F.size(F.array_distinct("_lines")).alias("_n_own_lines"),
                 F.size(F.array_distinct("_h")).alias("_n_distinct")).drop("_t", "_lines")
    for step in (1, 2, 4):
        d = d.withColumn("_h", F.transform("_h", _with_later(step)))
    windows = F.slice("_h", 1, F.greatest(F.col("n_words") - (WINDOW - 1), F.lit(0)).cast("int"))
    d = d.withColumn("_h", windows)
    repeats = F.size("_h") > F.size(F.array_distinct("_h"))
    d = d.withColumn("_h", F.when(repeats, F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda e, k, o: e.h == F.get(F.col("_h"), k + o).h
    starts = F.filter("_h", lambda e, k: F.coalesce(same(e, k, 1), F.lit(False))
                      | F.coalesce((k > 0) & same(e, k, -1), F.lit(False)))
    d = d.withColumn("_h", F.sort_array(F.transform(starts, lambda e: e.i)))
    covered = F.aggregate(
        F.transform("_h", lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("_h"), k + 1) - i, F.lit(WINDOW)))),
        F.lit(0), lambda a, x: a + x)
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    d = d.select(
        "_row", "n_words", "word_chars", "n_symbols",
        (F.col("_n_lines") - F.col("_n_own_lines")).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        (F.col("word_chars") / words).alias("mean_word"), (F.col("n_symbols") / words).alias("symbol_rate"),
        (F.col("_upper") / chars).alias("upper_rate"), (F.col("_marks") / words).alias("mark_rate"),
        (F.col("_digits") / chars).alias("digit_rate"),
        ((F.col("_n_lines") - F.col("_n_own_lines")) / F.greatest("_n_lines", F.lit(1))).alias("dup_line_rate"),
        (F.coalesce(covered, F.lit(0)) / words).alias("repeat_rate"),
        (F.col("_n_distinct") / words).alias("distinct_rate"),
        (F.col("n_words") / F.greatest("_n_lines", F.lit(1))).alias("line_words"),
    )
    return d.select(*[F.col(f"_row.`{c}`").alias(c) for c in keep], *dict.fromkeys(added))


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    bound: float

    def column(self) -> Column:
        c = F.col(self.feature).cast("double")
        return c >= self.bound if self.at_least else c < self.bound

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.bound:.6g}"


Rule = tuple[Condition, ...]


def _all(rule: Sequence[Condition]) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column()
    return out


def as_expression(rules: Sequence[Rule]) -> Column:
    """The list as one ordered conditional: the number of the first rule that applies, else 0.
    A null statistic satisfies no condition."""
    out = None
    for k, rule in enumerate(rules, 1):
        out = F.when(_all(rule), k) if out is None else out.when(_all(rule), k)
    return F.lit(0) if out is None else F.coalesce(out, F.lit(0))


def learn_rules(labelled: DataFrame, label_col: str, features: Sequence[str] = FEATURES, seed_col: str = "doc_id",
                sample_rows: int = 50_000, cuts: int = 24, most_rules: int = 12, most_conditions: int = 4,
                least_rows: int = 8, least_precision: float = 0.95) -> list[Rule]:
    """Sequential covering: rules for label 1, each grown, pruned and accepted on other rows.

    Rows are taken by the hash of ``seed_col`` so that about ``sample_rows`` take part (all of
    them if there are fewer): two thirds grow rules, one third prunes. Thresholds are
    ``cuts`` quantiles of each statistic. A rule grows by the condition of highest
    information gain over what earlier rules left, until no row of label 0 is covered or
    ``most_conditions`` is reached; it is then cut back to the prefix that is worth most on
    the pruning rows. It is kept if it covers at least ``least_rows`` rows there with at least
    ``least_precision`` of label 1; the first that is not ends the list.

    Each step is one grouped count of (statistic, bin, label): at most features x (cuts + 1)
    rows come to the driver. Null labels take no part, null statistics satisfy no condition.
    Without rows of both labels the list is empty.
    """
    known = labelled.filter(F.col(label_col).isNotNull())
    total = known.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label_col).cast("int")).alias("p")).first()
    if not total.n or not total.p or total.p == total.n:
        return []
    u = F.pmod(F.xxhash64(F.col(seed_col)), F.lit(1_000_000)) / 1_000_000
    rows = known.filter(u < sample_rows / total.n).select(
        F.col(label_col).cast("int").alias("_y"), (F.pmod(F.xxhash64(F.col(seed_col), F.lit(1)), F.lit(3)) == 0).alias("_prune"),
        *[F.col(f).cast("double").alias(f) for f in features])
    at = rows.agg(*[F.percentile_approx(f, [i / cuts for i in range(cuts + 1)], 10_000).alias(f) for f in features],
                  *[F.percentile_approx(F.when(F.col("_y") == 1, F.col(f)), [i / cuts for i in range(cuts + 1)], 10_000)
                    .alias(f"{f}_1") for f in features]).first()
    bounds = {f: sorted({*(at[f] or []), *(at[f"{f}_1"] or [])}) for f in features}
    bins = F.array(*[
        F.struct(F.lit(k).alias("f"), F.when(F.col(f).isNotNull(), sum(
            (F.col(f) >= float(b)).cast("int") for b in bounds[f])).alias("b"))
        for k, f in enumerate(features) if bounds[f]])
    rows = saved(rows.withColumn("_bins", bins), "rule-rows")
    grow, prune = rows.filter("NOT _prune"), rows.filter("_prune")

    rules: list[Rule] = []
    while len(rules) < most_rules:
        open_ = as_expression(rules) == 0
        rule: list[Condition] = []
        while len(rule) < most_conditions:
            part = grow.filter(open_ & _all(rule))
            hist = part.select("_y", F.explode("_bins").alias("e")).groupBy("e.f", "e.b").agg(
                F.sum("_y").alias("p"), F.count(F.lit(1)).alias("n")).filter("b IS NOT NULL").collect()
            best, junk, clean = _best(hist, features, bounds)
            if best is None:
                break
            rule.append(best)
            if not clean:
                break
        if not rule:
            break
        got = prune.filter(open_).agg(*[F.count(F.when(_all(rule[:k]), 1)).alias(f"n{k}") for k in range(1, len(rule) + 1)],
                                      *[F.count(F.when(_all(rule[:k]) & (F.col("_y") == 1), 1)).alias(f"p{k}")
                                        for k in range(1, len(rule) + 1)]).first()
        worth = {k: (2 * got[f"p{k}"] - got[f"n{k}"]) / max(got[f"n{k}"], 1) for k in range(1, len(rule) + 1)}
        size = max(worth, key=lambda k: (worth[k], got[f"p{k}"], -k))
        n, p = got[f"n{size}"], got[f"p{size}"]
        if n < least_rows or p < least_precision * n:
            break
        rules.append(tuple(rule[:size]))
    return rules


def _best(hist, features, bounds) -> tuple[Condition | None, int, int]:
    """The condition of highest gain: rows of label 1 covered x bits gained on their share."""
    best, top, left = None, 0.0, (0, 0)
    for k, f in enumerate(features):
        own = sorted((r.b, r.p, r.n) for r in hist if r.f == k)
        p_all, n_all = sum(x[1] for x in own), sum(x[2] for x in own)
        if not p_all or p_all == n_all:
            continue
        base = log2(p_all / n_all)
        below_p = below_n = 0
        seen = {b: (p, n) for b, p, n in own}
        for i, bound in enumerate(bounds[f]):
            p, n = seen.get(i, (0, 0))
            below_p, below_n = below_p + p, below_n + n
            for at_least, p, n in ((False, below_p, below_n), (True, p_all - below_p, n_all - below_n)):
                if p and n < n_all and (gain := p * (log2(p / n) - base)) > top + 1e-9:
                    best, top, left = Condition(f, at_least, float(bound)), gain, (p, n - p)
    return best, *left


def base_failed() -> Column:
    """Fixed rules that come first: under 20 words, or over 30 % of words in repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def apply_rules(stats: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds ``base_failed``, ``rule`` (the first learned rule that rejects the row, else 0) and ``kept``."""
    s = stats.drop("base_failed", "rule", "kept").withColumns({"base_failed": base_failed(), "rule": as_expression(rules)})
    return s.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


@query("op8_quality_rules")
def op8_quality_rules(spark, sf):
    """Statistics of every whole text; the list is learned from the labelled ones."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    stats = saved(text_statistics(docs).drop("text"), "text-statistics")
    labels = table(spark, sf, "labels").groupBy("doc_id").agg((F.min("quality") == 0).alias("junk"))
    open_ = stats.join(labels, "doc_id").filter(~base_failed())
    rules = learn_rules(open_, "junk")
    return apply_rules(stats, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rule", "kept")
