import random

import numpy as np

from tallyloom.llm import chunks as C
from tallyloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def slow_cuts(data):
    """The chunk ends of one text, byte by byte."""
    ends, last = [], 0
    for i in range(1, len(data)):
        h = sum(int(C.GEAR[data[i - 1 - k]]) << k for k in range(min(C.WINDOW, i))) % 2**32
        inside = data[i] & 0xC0 == 0x80
        if pending := getattr(slow_cuts, "pending", False):
            hit = True
        else:
            hit = (h < 2**32 // C.ONE_IN and i - last >= C.LEAST) or i - last >= C.MOST
        slow_cuts.pending = hit and inside
        if hit and not inside:
            ends.append(i)
            last = i
    slow_cuts.pending = False
    return ends + [len(data)] if data else []


def chunked(texts):
    raw = [(t or "").encode() for t in texts]
    sizes = np.array([len(r) for r in raw])
    return C.cuts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum(sizes) - sizes, sizes)


def brute(rows, least=64):
    held = {}
    ends = chunked([t for _, t in rows])
    for (d, t), e in zip(rows, ends):
        raw = (t or "").encode()
        for a, b in zip([0, *e], e):
            held.setdefault(raw[a:b], set()).add(d)
    out = {}
    for (d, t), e in zip(rows, ends):
        raw, runs, n = (t or "").encode(), [], 0
        for a, b in zip([0, *e], e):
            ids = [x for x in held[raw[a:b]] if x is not None]
            if len(held[raw[a:b]]) > 1 and d != min(ids):
                n += 1
                runs = runs[:-1] + [(runs[-1][0], b)] if runs and runs[-1][1] == a else runs + [(a, b)]
        runs = [r for r in runs if r[1] - r[0] >= least]
        if runs:
            out[d, t] = (n, runs)
    return out


def test_cuts_are_the_definition_and_resist_shifts():
    rng = random.Random(1)
    texts = ["", "a", "é" * 300, "x" * 1000, *("".join(rng.choice("abc defé") for _ in range(rng.randrange(900))) for _ in range(12))]
    assert chunked(texts) == [slow_cuts(t.encode()) for t in texts]
    base = "".join(rng.choice("abcdefghij ") for _ in range(20_000))
    moved = base[:5000] + "INSERTED" + base[5000:]
    pieces = [{t[a:b] for a, b in zip([0, *e], e)} for t, e in zip((base, moved), chunked([base, moved]))]
    assert len(pieces[0] - pieces[1]) <= 6


def test_most_of_a_short_passage_is_found():
    rng = random.Random(51)
    words = lambda n: " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 10))) for _ in range(n))
    missed = found = total = 0
    for _ in range(300):
        p = words(51)
        docs = [(i, f"{words(rng.randrange(5, 60))} {p} {words(20)}") for i in range(2)]
        runs = [r for _, s in brute(docs).values() for r in s]
        missed += not runs
        found += sum(b - a for a, b in runs)
        total += len(p)
    assert missed <= 0.035 * 300 and found >= 0.72 * total


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = {d: (n, ",".join(f"{a}:{b}" for a, b in s)) for (d, _), (n, s) in brute(rows).items()}
    assert {r.doc_id: (r.n_repeated, r.spans) for r in QUERIES["op2_substring_dedup"](spark, SMALL).collect()} == want and want


def test_rows(spark):
    rng = random.Random(6)
    passage = " ".join("".join(rng.choice("abcdeé") for _ in range(5)) for _ in range(60))
    own = lambda: " ".join("".join(rng.choice("ghijk") for _ in range(5)) for _ in range(40))
    rows = [(3, own() + passage + own()), (1, own() + passage), (None, passage + own()), (2, None), (4, ""), (5, own()),
            (3, own() + passage), (6, "y" * 50_000), (7, "y" * 50_000)]
    rows += [rows[0]]
    df = spark.createDataFrame([(d, t, "k") for d, t in rows], "doc_id long, text string, n_cut string")
    want = brute(rows)
    got = [[(s.start, s.end) for s in r.spans] for r in C.repeated_spans(df).collect()]
    assert sorted(map(str, got)) == sorted(str(s) for _, s in want.values())
    out = C.dedup_substrings(df)
    assert out.columns == ["doc_id", "text", "n_cut"] and out.count() == len(rows)
    for r in out.collect():
        assert (r.text is None) == (r.doc_id == 2)
    kept = {r.doc_id: r for r in out.collect()}
    assert passage in kept[1].text and kept[7].text == "" and kept[6].n_cut == 0
    for d, t in rows:
        if (d, t) in want:
            raw, at, parts = t.encode(), 0, []
            for a, b in want[d, t][1]:
                parts.append(raw[at:a])
                at = b
            text = b"".join(parts + [raw[at:]]).decode()
            assert any(r.doc_id == d and r.text == text for r in out.collect())
    assert C.dedup_substrings(df.limit(0)).count() == 0
