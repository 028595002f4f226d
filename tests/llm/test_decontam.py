import random
import re
from collections import Counter

from tallyloom.llm.decontam import decontaminate, find_leaks
from tallyloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def shingles(w, k):
    return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def brute(docs, items, least=0.8):
    out = {}
    for d, t in docs:
        w = words(t)
        for i, it in items:
            x = words(it)
            k = min(5, len(x))
            if not x or not w:
                continue
            own = shingles(x, k)
            if not own.keys() & shingles(w, k).keys():
                continue
            for s in range(max(1, len(w) - len(x) + 1)):
                a = shingles(w[s:s + len(x)], k)
                sim = sum((a & own).values()) / sum((a | own).values())
                if sim >= least and sim > out.get((d, i), (0,))[0]:
                    out[d, i] = (sim, s)
    return out


def found(df):
    return {(r.doc_id, r.item_id): (r.similarity, r.start) for r in df.collect()}


def test_against_brute_force(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, text(n)) for i, n in enumerate([12, 20, 35, 50, 80, 3, 5, 1, 35])]
    items[8] = (8, items[2][1])
    docs = []
    for n in range(120):
        w = list(items[n % 9][1])
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(w)) if w else 0
            edit = rng.randrange(3)
            w[at:at + (edit != 0)] = [] if edit == 2 else [rng.choice(vocab)]
        if n % 10 == 0:
            w = w[len(w) // 2:] + w[:len(w) // 2]
        docs.append((n, "  ".join(["", *text(rng.randrange(40)), *(x.upper() + "," for x in w), *text(rng.randrange(40))])))
    docs += [(1000, None), (1001, ""), (1002, " ".join(text(30_000) + items[3][1])), (1003, "w1 " * 500)]
    texts = [(i, " ".join(w)) for i, w in items] + [(9, None), (10, "!!"), (11, "w1 " * 40)]
    want = brute(docs, texts)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(texts, "item_id long, text string")
    got = found(find_leaks(d, b))
    assert set(got) <= set(want) and len(got) >= 0.99 * len(want) > 50
    exact = {k for k, v in want.items() if v[0] > 0.85}
    assert exact <= set(got)
    assert all(abs(got[k][0] - want[k][0]) < 1e-9 and got[k][1] == want[k][1] for k in got)


def test_query_against_brute_force(spark):
    read = lambda n, *c: [tuple(r) for r in spark.read.parquet(f"{SMALL}/{n}.parquet").select(*c).collect()]
    want = brute(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))
    assert found(QUERIES["op4_decontamination"](spark, SMALL)) == want and want


def test_rows(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    docs = spark.createDataFrame([(1, "x " + item, 1), (1, "nothing", 1), (None, item + " y", 1), (3, "clean", 1), (3, "clean", 1),
                                  (4, None, 1)], "doc_id long, text string, k int")
    items = spark.createDataFrame([(7, item, 0), (7, item, 0), (None, item, 0)], "item_id long, text string, w int")
    got = found(find_leaks(docs, items, most_broadcast=1))
    assert got == {(d, i): (1.0, s) for d, s in ((1, 1), (None, 0)) for i in (7, None)}
    left = decontaminate(docs, items)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [3, 3, 4]
    assert find_leaks(docs.limit(0), items).count() == 0 and find_leaks(docs, items.limit(0)).count() == 0
