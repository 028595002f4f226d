"""Range, skew and rank plans against brute force, with hot keys and values."""

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import aggregates as A
from tallyloom.operators import windows as W
from tallyloom.plans import ranges as R
from tallyloom.plans.skew import attach_group_size, lookup_by_weight


def hot_frame(n=3000, seed=1):
    """A third of the rows share one value and one group."""
    rng = np.random.default_rng(seed)
    v = np.where(np.arange(n) % 3 == 0, 5.0, rng.normal(size=n).round(2))
    g = np.where(np.arange(n) % 3 == 1, "hot", rng.choice(list("abcd"), n))
    return pd.DataFrame({"id": np.arange(n), "g": g, "v": v})


def test_exact_quantiles(spark):
    p = hot_frame()
    df = spark.createDataFrame(p)
    probs = {"q1": 0.1, "q2": 0.5, "q3": 0.77, "q4": 1.0}
    got = R.exact_quantiles(df, "v", probs, parts=8).first()
    for k, q in probs.items():
        assert got[k] == pytest.approx(np.quantile(p.v, q))
    by = {r["g"]: r for r in R.exact_quantiles(df, "v", probs, ["g"], parts=8).collect()}
    for g, part in p.groupby("g"):
        for k, q in probs.items():
            assert by[g][k] == pytest.approx(np.quantile(part.v, q))


def test_quantiles_null_group_and_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", None), ("a", 2.0)], "g string, v double")
    got = {r["g"]: r["m"] for r in R.exact_quantiles(df, "v", {"m": 0.5}, ["g"]).collect()}
    assert got == {None: 2.0, "a": 2.0}


@pytest.mark.parametrize("key,parts", [("id", 16), ("id", 200), ("name", 16), ("id", None)])
def test_dense_index(spark, key, parts):
    df = spark.range(997).select((F.col("id") * 7 + 3).alias("id"), F.concat(F.lit("n"), F.hash("id")).alias("name"))
    got = R.dense_index(df, key, parts=parts).toPandas().sort_values(key)
    assert got.doc_index.tolist() == list(range(997))


def test_running_totals_descending(spark):
    p = hot_frame().groupby("v", as_index=False).size()
    df = spark.createDataFrame(p)
    got = R.running_totals(df, "v", ["size"], descending=True, parts=8).toPandas().sort_values("v", ascending=False)
    assert got.size_run.tolist() == p.sort_values("v", ascending=False)["size"].cumsum().tolist()
    assert set(got.size_all) == {3000}


def test_lookup_hot_and_cold_keys(spark):
    p = hot_frame()
    p.loc[p.id % 50 == 0, "g"] = None
    df = spark.createDataFrame(p)
    for hot_rows in (1, 400, 10**9):
        got = attach_group_size(df, ["g"], "n", hot_rows).toPandas()
        assert len(got) == len(p)
        want = p.groupby("g", dropna=False)["id"].transform("size")
        assert got.sort_values("id").n.tolist() == want.tolist()
    dim = spark.createDataFrame([("a", 1, "x")], "g string, n int, extra string")
    kept = lookup_by_weight(df, dim, ["g"], "n")
    assert kept.count() == len(p)
    assert kept.filter("extra = 'x'").count() == (p.g == "a").sum()


def test_duplicates_with_hot_text(spark):
    rows = [(i, " Same\n" if i % 3 == 0 else f"t{i // 2}") for i in range(300)]
    df = spark.createDataFrame(rows, "id int, text string")
    want = pd.Series([t.strip().lower() for _, t in rows]).duplicated(keep=False).tolist()
    got = W.duplicated(df, "text", hot_rows=50).orderBy("id").toPandas().is_duplicate.tolist()
    assert got == want


def test_rank_by_hash(spark):
    df = spark.range(500).select("id", F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("g"),
                                 F.md5(F.col("id").cast("string")).alias("h"))
    got = R.rank_by_hash(df, "h", ["g"], "id").toPandas()
    for g, part in got.groupby("g"):
        part = part.sort_values("h")
        assert part._rank.tolist() == list(range(1, len(part) + 1))
        assert set(part._n) == {len(part)}
    assert hashlib.md5(b"7").hexdigest() == got[got.id == 7].h.iloc[0]


def test_histogram_flat_and_bins(spark):
    df = spark.createDataFrame([(1.0,)] * 5, "v double")
    assert [tuple(r) for r in A.histogram(df, "v", 4).collect()] == [(2, 5)]
    p = hot_frame()
    got = A.histogram(spark.createDataFrame(p), "v", 30).toPandas().set_index("bin").n
    assert got.sum() == len(p)
    want, _ = np.histogram(p.v, 30)
    assert got.reindex(range(30), fill_value=0).tolist() == want.tolist()


def test_index_crosstab_rows_sum_to_one(spark):
    df = spark.createDataFrame(hot_frame())
    cats = ["hot", "a", "b", "c", "d"]
    got = A.crosstab(df.withColumn("k", F.col("id") % 4), "k", "g", cats, "index").toPandas()
    assert np.allclose(got[cats].sum(axis=1), 1.0)


def test_peak_takes_first_year_on_ties(spark):
    df = spark.createDataFrame([("a", "2020-01-01"), ("a", "2021-01-01")], "c string, d string").withColumn(
        "d", F.col("d").cast("date"))
    assert A.peak_period(df, "d", "c").first()["peak_year"] == 2020


@pytest.mark.parametrize("kind", ["int", "string", "date", "timestamp", "decimal(12,2)"])
def test_ranges_of_any_type_without_sketches(spark, kind):
    """Split points come from rows that tasks pick by hash; no task merges the sketches of others."""
    base = spark.range(5000).select((F.col("id") % 1700).alias("v"))
    v = {"date": F.date_add(F.lit("2020-01-01"), F.col("v").cast("int")), "timestamp": F.timestamp_seconds("v")}.get(kind, F.col("v").cast(kind))
    df = base.select(v.alias("v")).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    b = R.with_range(df, "v", df, 64)
    sizes = [r["count"] for r in b.groupBy("_b").count().collect()]
    assert sum(sizes) == 1700 and len(sizes) > 40 and max(sizes) < 150
    run = R.running_totals(df, "v", ["n"], parts=64)
    assert run.agg(F.max("n_run")).first()[0] == 5000
    plan = run._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "kll" not in plan and "TakeOrdered" not in plan
