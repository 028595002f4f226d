"""Topic maths against brute force on small fixtures."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import coherence as C
from tallyloom.operators import density as D
from tallyloom.operators import lda as L
from tallyloom.operators import outliers as O
from tallyloom.operators import topics as T

RNG = np.random.default_rng(3)
DOCS = [" ".join(RNG.choice(["aa", "bb", "cc", "dd", "ee"], size=n, p=[.3, .3, .2, .1, .1]))
        for n in (1, 3, 7, 12, 25, 40)] + ["zz zz"]


def docs(spark):
    return spark.createDataFrame([(i, d.split()) for i, d in enumerate(DOCS)], "id int, t array<string>")


@pytest.mark.parametrize("window", [2, 5, 10, 110])
def test_window_counts(spark, window):
    """The interval lengths equal the windows spelled out one by one."""
    topics = {0: ["aa", "bb", "cc"], 1: ["dd", "aa"]}
    single, double, n = C.window_counts(docs(spark), "id", F.col("t"), topics, window)
    wins = []
    for d in DOCS:
        t = d.split()
        wins += [set(t[s:s + window]) for s in range(max(1, len(t) - window + 1))]
    got = {r["word"]: r["c"] for r in single.collect()}
    assert got == {w: sum(w in x for x in wins) for w in ("aa", "bb", "cc", "dd")}
    pairs = {(r["a"], r["b"]): r["c"] for r in double.collect()}
    for a, b in pairs:
        assert pairs[a, b] == sum(a in x and b in x for x in wins)
    assert set(pairs) == {("bb", "aa"), ("cc", "aa"), ("cc", "bb"), ("dd", "aa")}
    assert spark.range(1).select(n.alias("n")).first()["n"] == len(wins)


def test_umass(spark):
    got = C.coherence_umass(docs(spark), "id", F.col("t"), {0: ["aa", "bb", "cc"]}).first()["umass"]
    sets = [set(d.split()) for d in DOCS]
    ws = ["aa", "bb", "cc"]
    want = np.mean([math.log((sum(ws[i] in s and ws[j] in s for s in sets) + 1) / sum(ws[j] in s for s in sets))
                    for i in range(3) for j in range(i)])
    assert got == pytest.approx(want)


def vectors(spark, n=90, d=6, k=4, copies=30):
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(k, d)) * 3
    x = centers[rng.integers(0, k, n)] + rng.normal(size=(n, d)) * 0.6
    x[:copies] = x[0]
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, v array<double>"), x


def test_components_long_path(spark):
    n = 40
    e = [(i, i + 1) for i in range(n)] + [(100, 101)]
    edges = spark.createDataFrame(e + [(b, a) for a, b in e], "src long, dst long")
    nodes = spark.createDataFrame([(i,) for i in list(range(n + 1)) + [100, 101]], "id long")
    got = {r["id"]: r["component"] for r in D.connected_components(edges, nodes).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 100: 100, 101: 100}


def test_nearest_centroid_blocks_equal_matrix(spark):
    df, x = vectors(spark)
    cents = spark.createDataFrame([(t, [float(v) for v in x[40 + t]]) for t in range(7)], "topic int, centroid array<double>")
    a = O.nearest_centroid(df, "id", "v", cents, "topic").orderBy("id").toPandas()
    b = O.nearest_centroid(df, "id", "v", cents, "topic", driver_topics=2).orderBy("id").toPandas()
    assert a.best.tolist() == b.best.tolist()
    assert np.allclose(a.sim, b.sim)


def test_rescue_never_relabels_or_raises_rate(spark):
    df, x = vectors(spark)
    df = df.withColumn("topic", F.when(F.col("id") % 3 == 0, -1).otherwise((F.col("id") % 4).cast("int")))
    out = O.rescue_by_centroid(df, "id", "topic", "v", 0.2).toPandas()
    kept = out[out.topic >= 0]
    assert (kept.topic == kept.topic_centroid).all()
    assert (out.topic_centroid < 0).mean() <= (out.topic < 0).mean()


def test_prob_rescue_checks_width(spark):
    df = spark.createDataFrame([(-1, [0.5, 0.5])], "topic int, g array<double>")
    assert O.rescue_by_prob(df, "topic", "g", [7, 8]).first()["topic_prob"] == 7
    with pytest.raises(Exception):
        O.rescue_by_prob(df, "topic", "g", [7, 8, 9]).collect()


def test_silhouette_and_cohesion(spark):
    df, x = vectors(spark)
    y = np.arange(len(x)) % 3
    lab = df.withColumn("topic", (F.col("id") % 3).cast("int"))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    dist = 1 - u @ u.T
    sil = []
    for i in range(len(x)):
        own = (y == y[i]) & (np.arange(len(x)) != i)
        a = dist[i, own].mean()
        b = min(dist[i, y == c].mean() for c in range(3) if c != y[i])
        sil.append((b - a) / max(a, b))
    assert T.silhouette(lab, "topic", "v") == pytest.approx(np.mean(sil))
    cents = np.vstack([x[y == c].mean(0) for c in range(3)])
    cu = cents / np.linalg.norm(cents, axis=1, keepdims=True)
    got = T.cohesion_separation(lab, "topic", "v", hot_rows=20).first()
    assert got["cohesion"] == pytest.approx(np.mean([(u[y == c] @ cu[c]).mean() for c in range(3)]))
    assert got["separation"] == pytest.approx(1 - np.mean([cu[i] @ cu[j] for i, j in itertools.combinations(range(3), 2)]))
    one = T.cohesion_separation(lab.withColumn("topic", F.lit(0)), "topic", "v").first()
    assert one["cohesion"] is None and one["separation"] is None


def test_mv_r2(spark):
    rng = np.random.default_rng(0)
    y = rng.random((6, 9)) * (rng.random((6, 9)) > .4)
    y = y / y.sum(1, keepdims=True)
    theta = rng.dirichlet(np.ones(3), 6)
    phi = rng.dirichlet(np.ones(9), 3)
    terms = spark.createDataFrame([(d, f"w{t}", float(y[d, t])) for d in range(6) for t in range(9) if y[d, t] > 0],
                                  "id int, term string, p double")
    th = spark.createDataFrame([(d, theta[d].tolist()) for d in range(6)], "id int, theta array<double>")
    ph = spark.createDataFrame([(f"w{t}", phi[:, t].tolist()) for t in range(9)], "term string, phi array<double>")
    got = T.mv_r2(terms, th, ph, "id", 3).first()
    fit = theta @ phi
    sse, sst = ((y - fit) ** 2).sum(), ((y - y.mean(0)) ** 2).sum()
    assert got["sse"] == pytest.approx(sse) and got["sst"] == pytest.approx(sst)
    assert got["mv_r2"] == pytest.approx(1 - sse / sst)


def test_jsd(spark):
    rng = np.random.default_rng(1)
    phi = rng.dirichlet(np.ones(8) * .3, 4)
    phi[phi < 0.05] = 0
    phi = phi / phi.sum(1, keepdims=True)
    rows = [(k, f"w{t}", float(phi[k, t])) for k in range(4) for t in range(8) if phi[k, t] > 0]
    got = T.separation_jsd(spark.createDataFrame(rows, "topic int, term string, p double"), "topic").first()[0]
    e = 1e-12
    d = []
    for i, j in itertools.combinations(range(4), 2):
        p, q = phi[i], phi[j]
        m = (p + q) / 2
        d.append(.5 * (p * np.log((p + e) / (m + e))).sum() + .5 * (q * np.log((q + e) / (m + e))).sum())
    assert got == pytest.approx(np.mean(d))


def test_phrases_fall_back_to_terms(spark):
    df = spark.createDataFrame([(1, 0, ["a", "b", "c"]), (2, 0, ["a", "b", "c"]), (3, 0, ["x"]), (4, 1, ["solo"])],
                               "id int, topic int, t array<string>")
    words = spark.createDataFrame([(0, ["a"]), (1, ["w1", "w2", "w3", "w4"])], "topic int, words array<string>")
    got = {(r["topic"], r["rank"]): r["phrase"] for r in T.phrase_names(df, "id", "topic", "t", words).collect()}
    assert got == {(0, 1): "A B C", (1, 1): "W1 W2 W3"}


def test_lda_probabilities(spark):
    df = spark.createDataFrame([(i, DOCS[i % len(DOCS)].split()) for i in range(60)], "id int, t array<string>")
    cv, bow = L.bag_of_words(df, "id", "t", 1, 1.0)
    m = L.fit_lda(bow, "id", 3, passes=2)
    a = L.doc_topics(m, bow, "id").toPandas()
    assert np.allclose(np.vstack(a.gamma).sum(1), 1.0)
    assert a.lda_topic.between(0, 2).all()
    assert L.log_perplexity(m, bow) < 0
    again = L.doc_topics(L.fit_lda(bow, "id", 3, passes=2), bow, "id").toPandas()
    assert np.allclose(np.vstack(a.sort_values("id").gamma), np.vstack(again.sort_values("id").gamma))


def test_nearest_centroid_keeps_large_ids_and_zero_vectors(spark):
    cents = spark.createDataFrame([(3_000_000_000, [1.0, 0.0]), (5, [0.0, 1.0])], "topic long, centroid array<double>")
    df = spark.createDataFrame([(1, [2.0, 0.1]), (2, [0.0, 0.0])], "id long, v array<double>")
    for k in (1, 4096):
        got = {r.id: r.best for r in O.nearest_centroid(df, "id", "v", cents, "topic", driver_topics=k).collect()}
        assert got == {1: 3_000_000_000, 2: 5}


def test_lda_rows_lie_in_a_task_per_core_and_are_kept(spark, monkeypatch):
    """A task hands on a whole table of topics and terms, so their number must not follow the shuffle partitions."""
    df = spark.createDataFrame([(i, ["a", "b"] if i % 2 else ["c", "d", "c"]) for i in range(40)], "id int, t array<string>")
    cv, bow = L.bag_of_words(df, "id", "t", 2, 0.9)
    assert sorted(cv.vocabulary) == ["a", "b", "c", "d"]
    seen = []
    monkeypatch.setattr(L.LDA, "fit", lambda self, rows: seen.append((rows.rdd.getNumPartitions(), rows.storageLevel.useMemory)))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 997)
    try:
        L.fit_lda(bow, "id", 2)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0][0] <= spark.sparkContext.defaultParallelism and seen[0][1]


def test_embedding_is_fitted_on_counted_words(spark, monkeypatch):
    """Same vectors as one pipeline gives; the fits do not see the texts."""
    from tallyloom.operators import clusters as CL
    df = spark.createDataFrame([(i, d) for i, d in enumerate(DOCS)] + [(99, "")], "id int, text string")
    want = {r.id: r.v for r in CL.embedding_pipeline("text", 16, 3).fit(df).transform(df).select(
        "id", CL.vector_to_array("embedding_vector").alias("v")).collect()}
    seen, fit = [], CL.PCA.fit
    monkeypatch.setattr(CL.PCA, "fit", lambda self, rows: seen.append(rows.columns) or fit(self, rows))
    got = {r.id: r.embedding for r in CL.embed_documents(df, "text", 16, 3).collect()}
    assert "text" not in seen[0]
    assert got.keys() == want.keys() and all(np.allclose(got[i], want[i], atol=1e-9) for i in got)


def test_k_sweep_cuts_words_once(spark, monkeypatch):
    from tallyloom.operators import clusters as CL
    df = spark.createDataFrame([(i, [float(i % 2), 1.0 - i % 2], "aa bb" if i % 2 else "cc cc") for i in range(8)],
                               "id int, v array<double>, text string")
    seen, measure = [], CL.evaluate_variant
    monkeypatch.setattr(CL, "evaluate_variant", lambda rows, *a: seen.append(rows.columns) or measure(rows, *a))
    got = CL.k_sweep(df, "v", [2], tokens=F.split("text", " ")).first()
    assert (got.topics, got.diversity) == (2, 0.15)
    assert "text" not in seen[0]
