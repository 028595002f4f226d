import random
import re

import numpy as np
import pytest

from tallyloom.llm import setjoin as J
from tallyloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def brute(rows, least=0.8):
    """(id, class, links, copies) of every row."""
    words = [tuple(re.split(r"[\x20\x09-\x0D]+", re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", (t or "").lower()))) for _, t in rows]
    texts = sorted({w for w in words if w != ("",)})
    sets = [{w[i:i + min(5, len(w))] for i in range(len(w) - min(5, len(w)) + 1)} for w in texts]
    links, up = [0] * len(texts), list(range(len(texts)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if k >= least * (len(sets[i]) + len(sets[j]) - k):
                links[i] += 1
                links[j] += 1
                up[top(i)] = top(j)
    at = {t: i for i, t in enumerate(texts)}
    ids, copies = {}, {}
    for (d, _), w in zip(rows, words):
        if w in at:
            copies[w] = copies.get(w, 0) + 1
            if d is not None:
                c = top(at[w])
                ids[c] = min(ids.get(c, d), d)
    return sorted(((d, ids.get(top(at[w])), links[at[w]], copies[w]) if w in at else (d, d, 0, 1)
                   for (d, _), w in zip(rows, words)), key=str)


def got(df):
    return sorted(((r.doc_id, r.class_id, r.n_links, r.n_copies) for r in df.collect()), key=str)


def family(rng, n, size, edits):
    base = [f"v{rng.randrange(5000)}" for _ in range(size)]
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(size)] = f"v{rng.randrange(5000)}"
        yield " ".join(w)


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(J, "SMALL", 20)
    monkeypatch.setattr(J, "TILE", 16)
    rng = random.Random(3)
    texts = [t for n, size, edits in ((70, 150, 3), (5, 60, 1), (8, 400, 9), (3, 12, 1)) for t in family(rng, n, size, edits)]
    texts += [" ".join(f"v{rng.randrange(5000)}" for _ in range(rng.randrange(60))) for _ in range(60)]
    texts += ["one two three", "One  two\tthree", "one two", "", None, " \n", "one two three"] + [texts[0]] * 30
    rows = [(i if i % 17 else None, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, key string, path int")
    assert got(J.near_duplicates(df, recall=0.9999)) == brute(rows)


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op7_chosen_path_join"](spark, SMALL)) == brute(rows)


def test_components_of_a_chain(spark):
    key = lambda i: f"{i:03d}".encode()
    rows = [(key(i + j), b"h%d" % i) for i in range(8) for j in range(2)] + [(b"900", b"x"), (b"901", b"x"), (b"901", b"y")]
    got = {(bytes(r.key), bytes(r.component)) for r in J.components(spark.createDataFrame(rows, "key binary, hub binary")).collect()}
    assert got == {(key(i), b"000") for i in range(9)} | {(b"900", b"900"), (b"901", b"900")}


def test_recall_and_overlaps():
    assert J.runs_for(0.8, 0.99) >= 4 and J.runs_for(0.95, 0.99) < J.runs_for(0.8, 0.99)
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, 80)) for _ in range(9)] + [np.zeros(0, np.int64)]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
    for columns in (7, 4096):
        got = J._overlaps(sets, columns)
        assert all(got[i][j] == want[i][j] for i in range(10) for j in range(10) if i != j)


def test_one_of_each(spark):
    rows = [(5, "a b c d e f g"), (3, "a b c d e f g"), (3, "a b c d e f g"), (None, "A b c d e f g"), (7, "other words here"),
            (8, None), (9, ""), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = J.one_of_each(df)
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(
        [(3, rows[1][1]), (7, rows[4][1]), (8, None), (9, ""), (None, None)], key=str)
    assert J.near_duplicates(df.limit(0)).count() == 0
