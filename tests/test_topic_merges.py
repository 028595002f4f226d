"""Topic reduction by rounds, rescue by blocks and the topic map against plain numpy."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import lda as L
from tallyloom.operators import outliers as O
from tallyloom.operators import topics as T


def rows(n_topics=13, seed=6):
    r = np.random.default_rng(seed)
    out = []
    for t in range(n_topics):
        words = [f"w{(t * 3 + i) % 20}" for i in range(6)] if t != 4 else ["alone"]
        for _ in range(int(r.integers(1, 9))):
            out.append((len(out), t * 10, [str(w) for w in r.choice(words, int(r.integers(1, 6)))]))
    return out + [(len(out), -1, ["w1", "w2", "w1"]), (len(out) + 1, None, ["w3"]), (len(out) + 2, -1, ["nowhere"])]


def weights(docs, owner):
    tf = {}
    for _, t, w in docs:
        if t is not None and t >= 0:
            tf.setdefault(owner[t], Counter()).update(w)
    total = sum(tf.values(), Counter())
    mean = sum(total.values()) / len(tf)
    return {t: {w: n * math.log(1 + mean / total[w]) for w, n in c.items()} for t, c in tf.items()}, total, mean


def cosine(a, b):
    return sum(x * b.get(w, 0) for w, x in a.items()) / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))


def merged(docs, k):
    n = Counter(t for _, t, _ in docs if t is not None and t >= 0)
    owner = {t: t for t in n}
    while len(set(owner.values())) > k:
        size = Counter()
        for t, o in owner.items():
            size[o] += n[t]
        w, _, _ = weights(docs, owner)
        m = min(len(size) - k, len(size) // 2)
        order = sorted(size, key=lambda t: (size[t], t))
        small, large = order[:m], order[m:]
        biggest = min(size, key=lambda t: (-size[t], t))
        into = {}
        for s in small:
            best = min(large, key=lambda t: (-round(cosine(w[s], w[t]) * 100, 7), t))
            into[s] = best if cosine(w[s], w[best]) > 0 else biggest
        owner = {t: into.get(o, o) for t, o in owner.items()}
    return owner


@pytest.mark.parametrize("k", [1, 3, 12, 50])
def test_reduce_topics(spark, k):
    docs = rows()
    df = spark.createDataFrame(docs, "id int, topic int, t array<string>")
    got = {r.id: r.topic_reduced for r in T.reduce_topics(df, "topic", F.col("t"), k).collect()}
    owner = merged(docs, k)
    assert got == {i: owner.get(t, t) for i, t, _ in docs}
    assert len(set(owner.values())) == min(k, 13)


def test_rescue_by_words(spark):
    docs = rows()
    df = spark.createDataFrame(docs, "id int, topic int, t array<string>")
    got = {r.id: r.topic_terms for r in O.reduce_outliers_ctfidf(df, "id", "topic", F.col("t"), 0.3).collect()}
    w, total, mean = weights(docs, {t: t for _, t, _ in docs if t is not None})
    want = {}
    for i, t, words in docs:
        want[i] = t
        own = {x: n * math.log(1 + mean / total[x]) for x, n in Counter(words).items() if x in total}
        if t == -1 and own:
            best = min(w, key=lambda c: (-round(cosine(own, w[c]), 9), c))
            if round(cosine(own, w[best]), 9) >= 0.3:
                want[i] = best
    assert got == want and got[len(docs) - 3] != -1 and got[len(docs) - 1] == -1


@pytest.mark.parametrize("topics", [1, 2, 7])
def test_topic_map(spark, topics):
    r = np.random.default_rng(topics)
    x = np.where(r.random((topics, 40)) < 0.4, r.random((topics, 40)), 0)
    x[:, 0] = 0.5
    cells = [(f"t{i}", f"w{j}", float(x[i, j])) for i, j in np.argwhere(x > 0)]
    got = L.project_topics(spark.createDataFrame(cells, "topic string, term string, w double"), "topic", "term", "w").orderBy("topic").toPandas()
    centred = x - x.mean(axis=0)
    u, s, _ = np.linalg.svd(centred, full_matrices=False)
    want = np.zeros((topics, 2))
    for k in range(min(2, topics)):
        c = u[:, k] * s[k]
        want[:, k] = c * np.sign(c[np.abs(c).argmax()] or 1)
    # The last axis of two centred rows is no axis.
    assert np.allclose(got[["x", "y"]].to_numpy(), np.where(np.abs(want) < 1e-6, 0, want), atol=1e-6)
