"""Measures, splits, similar cases, classifiers."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import metrics as E
from tallyloom.operators import models as M


def test_average_precision_is_a_step_sum(spark):
    df = spark.createDataFrame([(.9, 1), (.8, 0), (.7, 1), (.6, 0), (.5, 1)], "s double, y int")
    assert E.average_precision(df, F.col("y") == 1, "s").first()[0] == pytest.approx(0.7555555556)


def test_roc_with_ties(spark):
    rng = np.random.default_rng(2)
    p = pd.DataFrame({"s": rng.integers(0, 12, 400).astype(float), "y": rng.integers(0, 2, 400)})
    p.loc[:150, "s"] = 5.0
    df = spark.createDataFrame(p)
    pos, neg = p[p.y == 1].s.to_numpy(), p[p.y == 0].s.to_numpy()
    want = ((pos[:, None] > neg).mean() + (pos[:, None] == neg).mean() / 2)
    assert E.roc_auc(df, F.col("y") == 1, "s").first()[0] == pytest.approx(want)
    c = E.roc_curve(df, F.col("y") == 1, "s").orderBy(F.desc("score")).toPandas()
    assert c.fpr.is_monotonic_increasing and c.tpr.is_monotonic_increasing
    assert c.fpr.iloc[-1] == c.tpr.iloc[-1] == 1.0
    none = df.withColumn("y", F.lit(0))
    assert E.roc_curve(none, F.col("y") == 1, "s").count() == 0


def test_split_sizes_and_repeatability(spark):
    df = spark.range(1001).select("id", F.when(F.col("id") % 20 == 0, "r").otherwise("c").alias("y"))
    a = E.stratified_split(df, "y", "id", seed="1").toPandas()
    assert a[a.is_test].groupby("y").size().to_dict() == {"c": round(950 * .25 + 1e-9), "r": 13}
    b = E.stratified_split(df.repartition(7), "y", "id", seed="1").toPandas()
    assert set(a[a.is_test].id) == set(b[b.is_test].id)
    c = E.stratified_split(df, "y", "id", seed="2").toPandas()
    assert set(a[a.is_test].id) != set(c[c.is_test].id)


def test_confusion_and_report(spark):
    df = spark.createDataFrame([(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 3, "y int, p int")
    c = E.confusion_matrix(df, "y", "p", [0, 1, 2])
    assert c.count() == 9 and c.agg(F.sum("n")).first()[0] == 10
    r = {x["label"]: x for x in E.classification_report(c).collect()}
    assert r["0"]["recall"] == pytest.approx(5 / 7) and r["1"]["precision"] == pytest.approx(3 / 5)
    assert r["2"]["f1"] == 0 and r["weighted avg"]["support"] == 10


def test_flags(spark):
    df = spark.createDataFrame([("b", " Neither ", "Both"), ("b", None, "Both"), ("c", "Neither", "Neither"),
                                (None, "Neither", "Both")], "bureau string, l string, p string")
    got = {r["bureau"]: r["flagged"] for r in E.flagged_by_bureau(df, "bureau", "l", "p").collect()}
    assert got == {"b": 1, "c": 0}


def test_text_classifier_learns(spark):
    rows = [(i, "alpha beta gamma" if i % 3 else "delta epsilon zeta", int(i % 3 > 0)) for i in range(60)]
    df = spark.createDataFrame(rows, "id int, text string, y int")
    m = M.fit_text_classifier(df, "text", "y", binary=True, min_df=2, max_df=0.99)
    p = M.predict(m, df, "text", "m")
    assert p.filter("m_class = y").count() == 60
    assert p.filter("m_confidence < 50").count() == 0
    top = M.top_coefficients(m, spark, 3).filter("side = 'top'").toPandas()
    assert set(top.term) <= {"alpha", "beta", "gamma", "alpha beta", "beta gamma"}


def test_models_of_the_same_rows_count_words_once(spark, monkeypatch):
    rows = [(f"{a} {b}", i % 2, i % 3) for i, (a, b) in enumerate([("alpha", "beta"), ("beta", "gamma"), ("gamma", "alpha")] * 20)]
    df = spark.createDataFrame(rows, "text string, y int, z int")
    first, want = (M.fit_text_classifier(df, "text", c, min_df=2, max_df=0.99) for c in "yz")
    monkeypatch.setattr(M.CountVectorizer, "fit", None)
    got = M.fit_text_classifier(df, "text", "z", min_df=2, max_df=0.99, same_rows=first)
    at = lambda m: {(r["class"], r["term"]): r["coefficient"] for r in M.top_coefficients(m, spark, 9).collect()}
    assert at(got) == pytest.approx(at(want), abs=1e-6)


def test_complexity_scores_are_made_once(spark, monkeypatch, capsys):
    """The median and the labels come from written scores, not from the texts again."""
    from tallyloom.catalog import models as C
    seen, median = [], M.above_median
    monkeypatch.setattr(M, "above_median", lambda df, *a: seen.append(df) or median(df, *a))
    monkeypatch.setattr(M, "fit_numeric_classifier", lambda *a: None)
    monkeypatch.setattr(C, "_MODELS", {})
    C.fitted(spark, "/root/testdata/sf0.001", "complexity")
    seen[0].explain()
    assert "parquet" not in capsys.readouterr().out


def test_novelty_and_median_label(spark):
    df = spark.createDataFrame([(60.0, None, 70.0), (10.0, 90.0, 20.0)], "a double, b double, c double")
    assert [r[0] for r in df.select(M.novelty(F.col("a"), F.col("b"), F.col("c"))).collect()] == [30.0, 10.0]
    v = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4)], "s double")
    assert [r["label"] for r in M.above_median(v, "s").orderBy("s").collect()] == [0, 0, 1, 1]


@pytest.mark.parametrize("classes", [2, 3])
def test_text_classifier_reaches_the_minimum_in_few_passes(spark, classes):
    """Rare terms next to common ones; the gradient of the stated sum is all but gone after 60 passes."""
    rng = np.random.default_rng(classes)
    words = np.minimum(rng.zipf(1.3, (300, 30)), 400)
    y = (words.sum(1) + rng.integers(0, 200, 300)) % classes
    rows = [(int(c), " ".join(f"w{i}" for i in r)) for c, r in zip(y, words)] + [(0, "none")]
    df = spark.createDataFrame(rows, "y int, text string")
    m = M.fit_text_classifier(df, "text", "y", binary=classes == 2, min_df=2, max_df=0.95, max_iter=60)
    got = m.transform(M.fold_text(df, "text")).select("y", "features", "probability").collect()
    x, label = np.array([r.features.toArray() for r in got]), np.array([r.y for r in got])
    p = np.array([r.probability.toArray() for r in got])
    weight = len(label) / (classes * np.bincount(label))[label]
    hit = np.eye(classes)[label]
    lr = m.stages[-1]
    coef = lr.coefficientMatrix.toArray()
    pull = lambda q: ((weight[:, None] * (q - hit)).T @ x / weight.sum())[-len(coef):]
    left = pull(p) + coef / len(label)
    assert np.linalg.norm(left) < 1e-3 * np.linalg.norm(pull(np.full_like(p, 1 / classes)))
    free = weight @ (p - hit) / weight.sum()
    assert np.abs(free).max() < 1e-3


def test_numeric_classifier_sees_equal_rows_once(spark, monkeypatch):
    """Same coefficients as row by row, from as many rows as there are distinct ones."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 5, 3000), rng.integers(0, 3, 3000)
    y = (a + b + rng.integers(0, 4, 3000) > 4).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"a": a.astype(float), "b": b.astype(float), "z": 0.0, "y": y}))
    args = dict(featuresCol="features", labelCol="y", standardization=False, regParam=1 / 3000, maxIter=1000, tol=1e-10)
    want = Pipeline(stages=[VectorAssembler(inputCols=["a", "b", "z"], outputCol="_raw"), StandardScaler(
        inputCol="_raw", outputCol="features", withMean=False, withStd=True), M.LogisticRegression(**args)]).fit(df)
    seen, fit = [], Pipeline.fit
    monkeypatch.setattr(Pipeline, "fit", lambda self, rows: seen.append(rows.count()) or fit(self, rows))
    got = M.fit_numeric_classifier(df, ["a", "b", "z"], "y")
    assert seen[0] <= 30
    assert np.allclose(got.stages[-1].coefficients, want.stages[-1].coefficients, atol=1e-2)
    assert got.stages[-1].intercept == pytest.approx(want.stages[-1].intercept, abs=1e-2)
