"""Quality classifier: character n-grams, interpolated modified Kneser-Ney, language quantiles."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import log10

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookup import Table
from .registry import query, table
from .util import digest, join_hot, saved

ORDER, BITS = 5, 12              # an n-gram of 5 symbols of 12 bits is one long
BEGIN, END, OTHER, FIRST = 1, 2, 3, 4
CHUNK = 1_000_000                # characters worked on at once
LOW, HIGH = (0.001, 0.005, 0.01), (0.98, 0.985, 0.99, 0.995)  # shares of good rows below a bound
MOST_GRAMS = 8_000_000           # n-grams of all orders that are broadcast; a larger model is joined
MOST_IDS = 5_000_000             # trusted ids that are broadcast, so that texts stay; with more, drawn texts move once
MOST_LANGS = 10_000              # languages whose bounds are broadcast; more meet theirs in a shuffle


@dataclass
class Model:
    """log10 p of every n-gram seen, log10 of the mass each context leaves to shorter ones."""

    symbols: np.ndarray                        # code point of symbol FIRST + i
    p: list[tuple[np.ndarray, np.ndarray]]     # per order: keys, log10 p
    rest: list[tuple[np.ndarray, np.ndarray]]  # per order: context keys, log10 gamma
    unseen: float                              # log10 p of a symbol never seen
    tables: list[tuple[DataFrame, DataFrame]] | None = None  # per order (g, p) and (x, gamma), in place of p and rest


def _mask(k: int) -> int:
    return (1 << BITS * k) - 1


def _unit(id_col: str, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1_000_000)) / 1_000_000


def symbol_map(symbols: np.ndarray) -> np.ndarray:
    out = np.full(0x110000, OTHER, np.int64)
    out[symbols] = np.arange(symbols.size) + FIRST
    return out


def chunks(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK:
            yield first, texts[first:i + 1]
            first, size = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def grams(texts: list[str], to_symbol: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Of all texts end to end: the keys of orders 1 to ORDER at every scored position (each
    character and one end), and where each text's positions begin."""
    size = np.array([len(t) for t in texts])
    points = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
    width = size + ORDER                       # ORDER - 1 begins before, one end after
    start = np.cumsum(width) - width
    x = np.full(int(width.sum()), BEGIN, np.int64)
    scored = np.ones(x.size, bool)
    for k in range(ORDER - 1):
        scored[start + k] = False
    x[start + width - 1] = END
    inside = scored.copy()
    inside[start + width - 1] = False
    x[inside] = to_symbol[points]
    out = [x]
    for _ in range(1, ORDER):
        longer = x.copy()
        longer[1:] |= out[-1][:-1] << BITS
        out.append(longer)
    n = np.cumsum(size + 1) - (size + 1)
    return [g[scored] for g in out], n, size + 1


def _discounts(c: DataFrame) -> tuple[float, float, float]:
    r = c.agg(*[F.count(F.when(F.col("c") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    n = [0, r.n1, r.n2, r.n3, r.n4]
    if not all(n[1:]):
        return 0.5, 0.75, 0.9
    y = n[1] / (n[1] + 2 * n[2])
    return tuple(min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.05), k - 0.05) for k in (1, 2, 3))


def fit(trusted: DataFrame, text_col: str = "text") -> Model:
    """Counts n-grams of the texts and estimates the model with grouped counts and joins.

    Order-5 counts are combined within tasks before they are shuffled by n-gram; lower
    orders count the distinct symbols seen before an n-gram. Each order's counts meet their
    context's totals and the next lower order's probabilities in joins on n-gram hashes.
    Only a finished table of up to MOST_GRAMS n-grams leaves Spark; a larger one stays a table.
    """
    src = trusted.select(F.coalesce(F.col(text_col), F.lit("")).alias("t"))

    def letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, texts in chunks(b.column(0).to_pylist()):
                v, n = np.unique(np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(v.astype(np.int64)), pa.array(n.astype(np.int64))], names=["s", "n"])

    # At most as many rows as there are code points; those beyond the symbols that fit in 12 bits share one.
    seen = src.mapInArrow(letters, "s long, n long").groupBy("s").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "s").limit(
        (1 << BITS) - FIRST).collect()
    symbols = np.array(sorted(r.s for r in seen), np.int64)
    to_symbol = src.sparkSession.sparkContext.broadcast(symbols)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to = symbol_map(to_symbol.value)
        for b in batches:
            for _, texts in chunks(b.column(0).to_pylist()):
                v, n = np.unique(grams(texts, to)[0][-1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(v), pa.array(n.astype(np.int64))], names=["g", "c"])

    counts = {ORDER: saved(src.mapInArrow(count, "g long, c long").groupBy("g").agg(F.sum("c").alias("c")), "ngrams")}
    for k in range(ORDER - 1, 0, -1):
        counts[k] = saved(counts[k + 1].groupBy(F.col("g").bitwiseAND(F.lit(_mask(k))).alias("g")).agg(
            F.count(F.lit(1)).alias("c")), "ngrams")
    joined = sum(c.count() for c in counts.values()) > MOST_GRAMS
    vocabulary, unseen = symbols.size + 2, 0.0
    p, rest, tables, below = [], [], [], None
    for k in range(1, ORDER + 1):
        d1, d2, d3 = _discounts(counts[k])
        c = counts[k].select("g", "c", F.shiftright("g", BITS).alias("x"), F.col("g").bitwiseAND(F.lit(_mask(k - 1))).alias("low"),
                             F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3).alias("d"))
        left = c.groupBy("x").agg(F.sum("c").alias("total"), (F.sum("d") / F.sum("c")).alias("gamma"))
        row = c.join(left, "x")
        if below is None:
            row = row.withColumn("under", F.lit(1.0 / (vocabulary + 1)))
        else:
            row = row.join(below.select(F.col("g").alias("low"), F.col("p").alias("under")), "low")
        below = saved(row.select("g", ((F.col("c") - F.col("d")) / F.col("total") + F.col("gamma") * F.col("under")).alias("p")),
                      "probabilities")
        left = left.select("x", "gamma")
        if k == 1:
            first = left.first()
            unseen = log10((first.gamma if first else 1.0) / (vocabulary + 1))
        if joined:
            tables.append((below, saved(left, "contexts")))
            continue
        got, ctx = below.toArrow(), left.toArrow()
        p.append((got["g"].to_numpy(), np.log10(got["p"].to_numpy()).astype(np.float32)))
        rest.append((ctx["x"].to_numpy(), np.log10(ctx["gamma"].to_numpy()).astype(np.float32)))
    return Model(symbols, p, rest, unseen, tables or None)


class Scorer:
    def __init__(self, model: Model):
        self.to = symbol_map(model.symbols)
        self.p = [Table(k, v, np.float32(np.nan)) for k, v in model.p]
        self.rest = [Table(k, v, np.float32(0)) for k, v in model.rest]
        self.unseen = model.unseen

    def log10_p(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per text: the sum of log10 p over its characters and end, and their number."""
        keys, start, size = grams(texts, self.to)
        out = self.p[-1].get(keys[-1])
        todo = np.flatnonzero(np.isnan(out))
        back = np.zeros(todo.size, np.float32)
        for k in range(ORDER - 1, 0, -1):
            back += self.rest[k].get(keys[k][todo] >> BITS)
            got = self.p[k - 1].get(keys[k - 1][todo])
            ok = ~np.isnan(got)
            out[todo[ok]] = back[ok] + got[ok]
            todo, back = todo[~ok], back[~ok]
        out[todo] = back + np.float32(self.unseen)
        return np.add.reduceat(out.astype(np.float64), start), size


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Adds ``perplexity`` per character (null for null or empty text); rows stay where they are,
    unless the model is a table (see score_joined)."""
    if model is not None and model.tables:
        return score_joined(docs, model, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c != "perplexity"]
    src = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            texts, out = b.column(len(keep)).to_pylist(), []
            for _, part in chunks(texts):
                total, n = scorer.log10_p(part)
                out += [10 ** (-s / m) if t else None for s, m, t in zip(total, n, part, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.array(out, pa.float64())], names=[*keep, "perplexity"])

    return src.mapInArrow(run, f"{schema}, perplexity double")


def score_joined(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """As score(), for a model of any size: each text's distinct n-grams, counted, meet their
    probabilities in joins. Equal texts are scored once; texts that are equal or n-grams that are
    common are no hot keys (join_hot), and a k-gram is looked up by its context and its last
    k - 1 symbols, of which each has at most one row per symbol."""
    keep = [c for c in docs.columns if c != "perplexity"]
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(*keep, digest(text).alias("_d"))
    symbols = docs.sparkSession.sparkContext.broadcast(model.symbols)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to = symbol_map(symbols.value)
        for b in batches:
            for first, texts in chunks(b.column(1).to_pylist()):
                keys, _, size = grams(texts, to)
                row = np.repeat(np.arange(first, first + len(texts)), size)
                order = np.lexsort((keys[-1], row))
                g, row = keys[-1][order], row[order]
                at = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (row[1:] != row[:-1])]))
                n = np.diff(np.append(at, g.size))
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row[at])), pa.array(g[at]), pa.array(n)], names=["d", "g", "n"])

    texts = docs.select(digest(text).alias("d"), text.alias("t")).filter("t <> ''")
    found = saved(texts.mapInArrow(count, "d binary, g long, n long").groupBy("d", "g").agg(F.max("n").alias("n")), "text-ngrams", 1000)
    values = None
    for k in range(1, ORDER + 1):
        p, rest = model.tables[k - 1]
        row = found.groupBy(F.col("g").bitwiseAND(F.lit(_mask(k))).alias("g")).agg(F.count(F.lit(1)).alias("w")).join(p, "g", "left")
        under = F.lit(model.unseen)
        if values is not None:
            row = row.withColumn("x", F.shiftright("g", BITS)).join(rest, "x", "left").withColumn(
                "low", F.col("g").bitwiseAND(F.lit(_mask(k - 1)))).join(values.select(F.col("g").alias("low"), F.col("lp").alias("under")), "low")
            under = F.coalesce(F.log10("gamma"), F.lit(0.0)) + F.col("under")
        values = saved(row.select("g", "w", F.coalesce(F.log10("p"), under).alias("lp")), "n-gram-values")
    total = join_hot(found, values, ["g"], "w").groupBy("d").agg(
        F.pow(F.lit(10.0), -F.sum(F.col("n") * F.col("lp")) / F.sum("n")).alias("perplexity"))
    total = saved(total.withColumnRenamed("d", "_d").join(own.groupBy("_d").agg(F.count(F.lit(1)).alias("_w")), "_d", "right"), "perplexities")
    return join_hot(own, total, ["_d"], "_w").select(*keep, "perplexity")


@dataclass
class Classifier:
    model: Model
    bounds: DataFrame                # lang, low, high, w (documents): every language with trusted text
    low: float | None                # for a null language
    high: float | None


def levels(below: list[int], above: list[int], n: int, least: int = 20) -> tuple[int | None, int]:
    """Indices of LOW (or None) and HIGH: where the share of ``n`` bad rows beyond the bound most
    exceeds the share of good ones; HIGH[-1] alone if there are few bad rows."""
    if n < least:
        return None, len(HIGH) - 1
    gain = [below[i] / n - q for i, q in enumerate(LOW)]
    low = max(range(len(LOW)), key=gain.__getitem__)
    high = max(range(len(HIGH)), key=lambda i: (above[i] / n - (1 - HIGH[i]), i))
    return low if gain[low] > 0 else None, high


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_chars: int | None = None, least_rows: int = 200, bad: DataFrame | None = None) -> tuple[Classifier, DataFrame]:
    """A classifier, and (id, lang, perplexity) of every row of ``docs``.

    ``labels`` has the ids of trusted documents. The model is fitted on all those whose id hash
    falls below 80 % (a caller may ask for a smaller share, of some ``sample_chars`` characters). All
    documents are scored. A language's bounds are quantiles of the perplexities of all its other
    trusted documents, as those that taught the model look too good to it; which of LOW and HIGH, or none below, is taken from the ids
    in ``bad``, each judged in its own language (see levels()). Languages with fewer than ``least_rows`` of them,
    and null, have the bounds of all together. Languages without trusted documents are not bounded. Trusted ids without a document do not matter; null ids are not trusted.
    """
    ids = labels.select(F.col(id_col).alias("_id")).distinct()
    d = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    share = 0.8
    if sample_chars is not None:
        chars = d.select("id", F.length("text").alias("n")).join(ids, F.col("id") == F.col("_id")).agg(F.sum("n").alias("n")).first().n or 0
        share = min(share, sample_chars / max(chars, 1))
    drawn = _unit("id", 3) < share
    texts, same = d.filter(drawn).select("id", "text"), F.col("id") == F.col("_id")
    few = ids.count() <= MOST_IDS
    model = fit(texts.join(F.broadcast(ids), same, "left_semi") if few else saved(texts.join(ids, same, "left_semi"), "trusted"))
    scores = saved(score(d, model).select("id", "lang", "perplexity"), "perplexities")
    good = scores.filter(F.col("perplexity").isNotNull()).join(ids, F.col("id") == F.col("_id"), "left_semi")
    own = F.when(~drawn, F.col("perplexity"))
    held = good.filter(~drawn)
    shares = [*LOW, *HIGH]
    whole = held.agg(F.percentile_approx("perplexity", shares, 10_000).alias("q")).first().q or [None] * len(shares)
    of_all = F.array(*[F.lit(q).cast("double") for q in whole])
    bounds = good.filter("lang IS NOT NULL").groupBy("lang").agg(
        F.percentile_approx(own, shares, 10_000).alias("q"), F.count(own).alias("n"))
    bounds = saved(bounds.join(scores.groupBy("lang").agg(F.count(F.lit(1)).alias("w")), "lang").select(
        "lang", F.when(F.col("n") >= least_rows, F.col("q")).otherwise(of_all).alias("q"), "w"), "bounds")
    low, high = None, len(HIGH) - 1
    if bad is not None and whole[0] is not None:
        wrong = scores.filter(F.col("perplexity").isNotNull() & F.col("lang").isNotNull()).join(
            bad.select(F.col(id_col).alias("_id")).distinct(), F.col("id") == F.col("_id"), "left_semi")
        wrong = join_hot(saved(wrong.select("lang", "perplexity"), "bad"), bounds, ["lang"], "w")
        side = [F.col("perplexity") < F.col("q")[i] if i < len(LOW) else F.col("perplexity") > F.col("q")[i] for i in range(len(shares))]
        r = wrong.agg(F.count(F.lit(1)), *[F.count(F.when(s, 1)) for s in side]).first()
        low, high = levels(list(r[1:1 + len(LOW)]), list(r[1 + len(LOW):]), r[0])
    at = lambda i: F.lit(None).cast("double") if i is None else F.col("q")[i]
    bounds = bounds.select("lang", at(low).alias("low"), at(len(LOW) + high).alias("high"), "w")
    return Classifier(model, bounds, None if low is None else whole[low], whole[len(LOW) + high]), scores


def judge(scored: DataFrame, classifier: Classifier, lang_col: str = "lang") -> DataFrame:
    """Adds ``low``, ``high`` and ``kept``: perplexity within its language's bounds. Rows without a
    perplexity (no text) are not kept, rows of a language without trusted text are.

    The MOST_LANGS languages with most documents meet their bounds by broadcast. If there are
    more, the others do in a shuffled join, in which no key is hot and all else is scattered.
    """
    b = classifier.bounds.select(F.col("lang").alias("_lang"), F.struct("low", "high").alias("_high"), F.col("w").alias("_w"))
    out = scored.drop("low", "high", "kept")
    if b.count() <= MOST_LANGS:
        out = out.join(F.broadcast(b.drop("_w")), F.col(lang_col) == F.col("_lang"), "left")
    else:
        hot = saved(b.orderBy(F.desc("_w"), "_lang").limit(MOST_LANGS).drop("_w"), "bounds")
        cold = b.join(F.broadcast(hot.select("_lang")), "_lang", "left_anti").select(
            F.concat(F.lit("l"), "_lang").alias("_key"), F.col("_high").alias("_low_high"))
        out = out.join(F.broadcast(hot), F.col(lang_col) == F.col("_lang"), "left")
        key = F.when(F.col("_lang").isNull() & F.col(lang_col).isNotNull(), F.concat(F.lit("l"), F.col(lang_col)))
        out = out.withColumn("_own", F.coalesce(key, F.concat(F.lit("x"), F.xxhash64("perplexity").cast("string"))))
        out = out.join(cold, F.col("_own") == F.col("_key"), "left").withColumn("_high", F.coalesce("_high", "_low_high"))
    for c, v in (("low", classifier.low), ("high", classifier.high)):
        out = out.withColumn(c, F.when(F.col(lang_col).isNull(), F.lit(v).cast("double")).otherwise(F.col("_high")[c]))
    out = out.drop("_lang", "_high", "_own", "_key", "_low_high")
    return out.withColumn("kept", F.col("perplexity").isNotNull() & F.coalesce(F.col("perplexity") <= F.col("high"), F.lit(True))
                          & F.coalesce(F.col("perplexity") >= F.col("low"), F.lit(True)))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents labelled good and not toxic, by every label they have."""
    return labels.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t")).filter("q = 1 AND t = 0").select("doc_id")


def distrusted_ids(labels: DataFrame) -> DataFrame:
    """Documents with a label of bad quality."""
    return labels.filter("quality = 0").select("doc_id")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier trained on them keeps. Texts are scored in
    place a second time rather than shuffled to meet their scores."""
    classifier, _ = train(docs, trusted_ids(labels), bad=distrusted_ids(labels))
    return judge(score(docs, classifier.model), classifier).filter("kept").select(*docs.columns)


@query("op3_quality_classifier")
def op3_quality_classifier(spark, sf):
    """Perplexity of every whole document, its language's bounds and the verdict."""
    labels = table(spark, sf, "labels")
    classifier, scores = train(table(spark, sf, "documents"), trusted_ids(labels), bad=distrusted_ids(labels))
    return judge(scores, classifier).withColumnRenamed("id", "doc_id")
