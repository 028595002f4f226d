import random
import re
from collections import Counter

import duckdb
import pytest

from tallyloom.llm import collocations as C
from tallyloom.llm.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"


def pieces(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for p in re.split("[.,;:!?\n\x0b\x0c\r]", low):
        yield re.findall("[^ \t]+", p)


def all_counts(rows):
    f = Counter()
    for text, lang in rows:
        for w in pieces(text):
            for k in (1, 2, 3, 4):
                f.update((lang or "und", *w[i:i + k]) for i in range(len(w) - k + 1))
    return f


def brute(rows, least=30, keep_share=80, top=2000):
    f = all_counts(rows)
    n = Counter()
    for k, v in f.items():
        if len(k) == 2:
            n[k[0]] += v
    cands = {k: v for k, v in f.items() if len(k) > 2 and v >= least}
    longer = Counter()
    for (lang, *w), v in cands.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                key = (lang, *w[i:i + m])
                longer[key] = max(longer[key], v)
    out = {}
    for key, a in cands.items():
        if 100 * longer[key] >= keep_share * a:
            continue
        lang, *w = key
        score, _, l, r = min((2000000 * a // (f[lang, *w[:k]] + f[lang, *w[k:]]), k, f[lang, *w[:k]], f[lang, *w[k:]])
                             for k in range(1, len(w)))
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, rows in out.items()
                  for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top]))


def made(seed=3):
    r = random.Random(seed)
    words = ["of", "the", "in", "New", "york", "Straße", "ÉTÉ", "x" * 300, "a-b", "日本"]
    rows = []
    for i in range(200):
        text = "".join(r.choice(words) + r.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "\r\n", " ", ";"]) for _ in range(60))
        rows.append((text, r.choice(["en", "en", "en", None, "und", "fr"])))
    rows += [(None, "en"), ("", None), (" .,;\n", "fr"), ("only once here", "es"), ("of the " * 20000, "en")] + [rows[0]] * 40
    rows += [("in the middle of new york", "en")] * 50
    return rows


@pytest.mark.parametrize("most_words", [500_000, 6, 0])
def test_against_brute_force(spark, most_words, monkeypatch):
    monkeypatch.setattr(C, "HOT_LEAST", 500)            # "of the" and "of the of" are spread
    rows = made()
    df = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    got = {(r.lang, *r.phrase.split(" ")): r.f for r in C.phrase_counts(df, 20, most_words=most_words).collect()}
    assert got == {k: v for k, v in all_counts(rows).items() if v >= 20}
    out = C.collocations(df, 20, top=25, most_words=most_words)
    assert sorted(tuple(r) for r in out.collect()) == brute(rows, 20, top=25)


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame(made(), "text string, lang string").selectExpr("*", "1 AS w12", "2 AS phrase", "3 AS _s")
    out = C.collocations(df)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in out.collect()) == brute(made())
    assert C.collocations(df.limit(0)).count() == 0


def test_scores_beyond_64_bits(spark):
    exact = "CAST(f AS DECIMAL(20,0)) * 2000000 div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))"
    f = 2**62 + 12345
    row = spark.createDataFrame([(f, f + 1, 2**63 - 1)], "f long, l long, r long").selectExpr(exact + " AS s").first()
    assert row.s == 2000000 * f // (f + 1 + 2**63 - 1)


def test_windows_move_once_and_packed(spark):
    df = spark.createDataFrame(made(), "text string, lang string")
    plan = C.phrase_counts(df)._jdf.queryExecution().executedPlan().toString()
    # Word counts are read back; windows are dealt out once, the sums of ROLLUP once.
    assert plan.count("REPARTITION_BY_COL") == 1 and plan.count("Expand") == 1


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SMALL}/documents.parquet'")
    cols = "lang, rank, phrase, a, l, r, n, score"
    want = con.execute(f"select {cols} from ({SQL['op11_collocations']}) order by 1, 2").fetchall()
    got = QUERIES["op11_collocations"](spark, SMALL).select(*cols.split(", ")).orderBy("lang", "rank").collect()
    assert [tuple(r) for r in got] == want
    assert len(want) > 20
