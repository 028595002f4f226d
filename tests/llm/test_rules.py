import re

from pyspark.sql import functions as F

from tallyloom.llm import rules as R
from tallyloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, dup = text.split("\n"), set(), 0
    for l in lines:
        if re.search(r"[^\x20\x09-\x0D]", l):
            dup += l in seen
            seen.add(l)
    at = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i:i + 8]), []).append(i)
    inside = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(inside)


COLS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
HARD = [None, "", " \n\t ", "a " * 9, "a b c d e f g h a b c d e f g h", "a b c d e f g h i a b c d e f g",
        "x y " * 5000, "one\none\n one\n\n\n \n \none", "É|<>#\x0b\x0cé\r#", "w" * 100_000,
        "a b c d e f g h X a b c d e f g h Y a b c d e f g h", "a b c"]


def test_statistics(spark):
    df = spark.createDataFrame([(i, t, 9) for i, t in enumerate(HARD)], "doc_id long, text string, n_words int")
    got = {r.doc_id: tuple(r[c] for c in COLS) for r in R.text_statistics(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(HARD)}
    assert R.text_statistics(df.limit(0)).count() == 0


def test_query(spark):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    junk = {r.doc_id: r.quality == 0 for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = QUERIES["op8_quality_rules"](spark, SF).collect()
    assert len(rows) == len(text)
    right = kept_clean = clean = caught = 0
    for r in rows:
        want = brute(text[r.doc_id])
        assert tuple(r[c] for c in COLS) == want
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert r.base_failed == failed and (not failed or not r.kept)
        if r.doc_id in junk and not failed:
            clean += not junk[r.doc_id]
            kept_clean += not junk[r.doc_id] and r.kept
    assert kept_clean >= 0.98 * clean
    assert sum(junk.get(r.doc_id, False) and not r.kept for r in rows) >= 0.8 * sum(junk.values())


def test_learns_a_known_list(spark):
    df = spark.range(3000).select(
        F.col("id").alias("doc_id"), (F.pmod(F.xxhash64("id"), F.lit(100)) / 100).alias("a"),
        (F.pmod(F.xxhash64("id", F.lit(7)), F.lit(100)) / 100).alias("b"), F.lit(None).cast("double").alias("c"))
    df = df.withColumn("y", (F.col("a") >= 0.75) | ((F.col("b") < 0.25) & (F.col("a") >= 0.5)))
    rules = R.learn_rules(df, "y", ["a", "b", "c"], cuts=20)
    got = df.withColumn("r", R.as_expression(rules) > 0).filter("r = y").count()
    assert got >= 2900 and len(rules) >= 2
    assert R.learn_rules(df.filter("y"), "y", ["a"]) == [] and R.learn_rules(df.limit(0), "y", ["a"]) == []


def test_no_rules_and_null_statistics(spark):
    df = spark.createDataFrame([(1, 50, 0, None)], "doc_id long, n_words long, n_repeat_words long, a double")
    out = R.apply_rules(df, [(R.Condition("a", True, 0.0),)]).first()
    assert out.kept and out.rule == 0
    assert R.apply_rules(df, []).first().kept
