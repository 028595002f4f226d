import random
from collections import defaultdict
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import perplexity as X
from tallyloom.llm.lookup import Table
from tallyloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute(texts, scored):
    """log10 p of each text under interpolated modified Kneser-Ney, from the definition."""
    n = 5
    c = defaultdict(int)
    for t in texts:
        s = ["<s>"] * (n - 1) + list(t) + ["</s>"]
        for i in range(n - 1, len(s)):
            c[tuple(s[i - n + 1:i + 1])] += 1
    counts = {n: dict(c)}
    for k in range(n - 1, 0, -1):
        c = defaultdict(int)
        for g in counts[k + 1]:
            c[g[1:]] += 1
        counts[k] = dict(c)
    size = len({ch for t in texts for ch in t}) + 3

    def discounts(c):
        m = [0] + [sum(v == k for v in c.values()) for k in (1, 2, 3, 4)]
        if not all(m[1:]):
            return 0.5, 0.75, 0.9
        y = m[1] / (m[1] + 2 * m[2])
        return [min(max(k - (k + 1) * y * m[k + 1] / m[k], 0.05), k - 0.05) for k in (1, 2, 3)]

    d = {k: discounts(counts[k]) for k in counts}
    off = lambda k, v: d[k][min(v, 3) - 1]

    def p(g):
        if not g:
            return 1 / size
        k = len(g)
        own = {h: v for h, v in counts[k].items() if h[:-1] == g[:-1]}
        if not own:
            return p(g[1:])
        total = sum(own.values())
        v = own.get(g, 0)
        return (v - off(k, v) if v else 0) / total + sum(off(k, x) for x in own.values()) / total * p(g[1:])

    out = []
    for t in scored:
        s = ["<s>"] * (n - 1) + list(t) + ["</s>"]
        out.append(sum(log10(p(tuple(s[i - n + 1:i + 1]))) for i in range(n - 1, len(s))))
    return out


def test_model_is_the_definition(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("aab cd") for _ in range(rng.randrange(1, 60))) for _ in range(25)] + ["abc" * 30, "é😀é"]
    scored = [*texts[:6], "zzz", "a", "dd dd abz", "😀😀", "abc" * 50]
    model = X.fit(spark.createDataFrame([(t,) for t in texts] + [(None,), ("",)], "text string").filter("text <> ''"))
    got, size = X.Scorer(model).log10_p(scored)
    assert np.allclose(got, brute(texts, scored), rtol=1e-4)
    assert size.tolist() == [len(t) + 1 for t in scored]


def test_table():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 2**60, 5000))
    t = Table(keys[::2], np.arange(keys[::2].size, dtype=np.float32), np.float32(-1))
    assert (t.get(keys[::2]) == np.arange(keys[::2].size)).all() and (t.get(keys[1::2]) == -1).all()
    assert (Table(np.zeros(0, np.int64), np.zeros(0, np.float32), np.float32(-1)).get(keys) == -1).all()


def test_query_separates_labels(spark):
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = QUERIES["op3_quality_classifier"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    rate = lambda q: np.mean([r.kept for r in rows if quality.get(r.doc_id) == q])
    assert rate(1) >= 0.97 and rate(0) <= 0.5


def test_rare_languages_have_their_own_bounds(spark, monkeypatch):
    rows = [(i, float(i % 100), f"l{i % 3}") for i in range(900)] + [(2000, 500.0, "new"), (2001, 500.0, None), (2002, None, "l0")]
    scored = spark.createDataFrame(rows, "id long, perplexity double, lang string")
    bounds = spark.createDataFrame([("l0", 3.0, 10.0, 300), ("l1", None, 50.0, 300), ("l2", None, 99.0, 300)],
                                   "lang string, low double, high double, w long")
    c = X.Classifier(None, bounds, None, 80.0)
    def kept():
        return {r.id for r in X.judge(scored, c).filter("kept").collect()}
    want = {i for i, p, lang in rows[:900] if (lang != "l0" or p >= 3) and p <= {"l0": 10, "l1": 50, "l2": 99}[lang]} | {2000}
    assert kept() == want
    monkeypatch.setattr(X, "MOST_LANGS", 1)
    assert kept() == want


def test_a_share_under_a_thousandth_is_bounded_by_its_own(spark, monkeypatch):
    docs = spark.range(300_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"),
                                       F.when(F.col("id") % 1200 == 0, "rare").otherwise("en").alias("lang"))
    monkeypatch.setattr(X, "fit", lambda d: None)
    monkeypatch.setattr(X, "score", lambda d, m: d.withColumn("perplexity", F.when(F.col("lang") == "rare", 9.0).otherwise(3.0)))
    c, _ = X.train(docs, docs.select("doc_id"), sample_chars=1_000, least_rows=100)
    assert {r.lang: r.high for r in c.bounds.collect()} == {"rare": 9.0, "en": 3.0}


def test_bounds_follow_the_bad_rows(spark, monkeypatch):
    assert X.levels([0, 0, 0], [100, 90, 80, 60], 100) == (None, 0)
    assert X.levels([30, 50, 60], [40, 40, 40, 40], 100) == (2, 3)
    assert X.levels([9, 9, 9], [9, 9, 9, 9], 9) == (None, 3)
    p = F.when(F.col("doc_id") >= 2000, 0.5).otherwise(F.col("doc_id") % 1000 + 1.0)  # repeated junk: low perplexity
    docs = spark.range(2100).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"))
    monkeypatch.setattr(X, "fit", lambda d: None)
    monkeypatch.setattr(X, "score", lambda d, m: d.withColumn("perplexity", p if "doc_id" in d.columns else F.when(
        F.col("id") >= 2000, 0.5).otherwise(F.col("id") % 1000 + 1.0)))
    labels = docs.select("doc_id", (F.col("doc_id") < 2000).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    left = {r.doc_id for r in X.keep_good(docs, labels).collect()}
    assert max(left) < 2000 and len(left) > 1900


def test_rows(spark):
    good = [(i, "the plain words of a plain text " * 3, "en") for i in range(60)]
    rows = good + [(100, None, "en"), (101, "", None), (102, "#|#|§§%&" * 30, None), (None, good[0][1], "en"),
                   (5, good[5][1], "en"), (103, "the plain words of a plain text " * 9_000, "xx")]
    docs = spark.createDataFrame([(d, t, l, 1.0, "z") for d, t, l in rows],
                                 "doc_id long, text string, lang string, perplexity double, high string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(7, 1, 0), (999, 1, 0), (None, 1, 0), (8, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    left = X.keep_good(docs, labels)
    assert left.columns == docs.columns
    ids = sorted((r.doc_id for r in left.collect()), key=str)
    assert ids == sorted([*range(60), 5, 103, None], key=str)
    # nothing trusted: whatever has text stays
    assert X.keep_good(docs, labels.limit(0)).count() == len(rows) - 2
    assert X.keep_good(docs.limit(0), labels).count() == 0


def test_every_trusted_text_outside_the_bounds_teaches(spark, monkeypatch):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("t"), 50_000).alias("text"), F.lit("en").alias("lang"))
    taught = []
    monkeypatch.setattr(X, "fit", lambda d: taught.append(d.count()))
    monkeypatch.setattr(X, "score", lambda d, m: d.withColumn("perplexity", F.lit(3.0)))
    X.train(docs, docs.select("doc_id"))
    monkeypatch.setattr(X, "MOST_IDS", 10)
    X.train(docs, docs.select("doc_id"))
    assert taught == [docs.filter(X._unit("doc_id", 3) < 0.8).count()] * 2 and taught[0] > 1500


def test_a_model_of_any_size_scores_alike(spark, monkeypatch):
    rng = random.Random(7)
    texts = ["".join(rng.choice("aab cd") for _ in range(rng.randrange(1, 60))) for _ in range(25)] + ["é😀é"]
    scored = [*texts[:6], "zzz", "a", "dd dd abz", "😀😀", "abc" * 50, texts[0], texts[0], "", None]
    docs = spark.createDataFrame(list(enumerate(scored)), "id long, text string").withColumn("d", F.lit(1)).repartition(3)
    monkeypatch.setattr(X, "MOST_GRAMS", 10)
    model = X.fit(spark.createDataFrame([(t,) for t in texts], "text string"))
    assert model.tables and not model.p
    out = X.score(docs, model)
    assert out.columns == ["id", "text", "d", "perplexity"]
    got = sorted((r.id, r.perplexity) for r in out.collect())
    assert [i for i, _ in got] == list(range(len(scored))) and [p for _, p in got[-2:]] == [None, None]
    want = [10 ** (-s / (len(t) + 1)) for s, t in zip(brute(texts, scored[:-2]), scored[:-2], strict=True)]
    assert np.allclose([p for _, p in got[:-2]], want, rtol=1e-4)
