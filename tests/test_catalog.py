"""Every registered query with SQL agrees with it; plans keep their shape."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, norm

from conftest import SMALL

QUERIES, SQL = entry.queries(), entry.oracle_sql()
FITTED = ("t01", "t13", "t17", "t20", "m03", "m16_score", "r02")


@pytest.fixture(scope="session")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    cur = con.execute(SQL[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    order = sorted(cols)
    want = sorted(tuple(norm(r[cols.index(c)]) for c in order) for r in cur.fetchall())
    got = sorted(tuple(norm(r[c]) for c in order) for r in df.collect())
    assert got == want


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith(FITTED) and n not in SQL))
def test_fitted_queries_give_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_reloaded_model_assigns_the_same(spark):
    assert QUERIES["s05_save_and_load_model"](spark, SMALL).filter("NOT same").count() == 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_sql_only_for_queries():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", [
    "a06_impact_share_by_agency", "a18_agency_dashboard", "t03_ctfidf_terms", "t08_rescue_by_centroid", "t26_separation_jsd",
    "x14_tfidf", "w05_duplicated", "a20_group_median", "p06_describe", "m09_roc_curve", "s03_with_doc_index", "m15_similar_cases"])
def test_plan_shape(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan.replace("ArrowEvalPython", "")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_pushdown(spark):
    plan = QUERIES["q02_filter_in"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(r_name), EqualTo(r_name,ASIA)" in plan
    assert "c_acctbal" not in plan


def test_fits_have_the_settings_of_the_scripts(spark, monkeypatch):
    from tallyloom.catalog import topics_fitted as TF
    monkeypatch.setattr(TF, "fitted", lambda *a: (type("V", (), {"vocabulary": []}), None, None))
    monkeypatch.setattr(TF.L, "lda_grid", lambda bow, key, tokens, vocab, ks, passes=6, seed=42, topn=20: (ks, passes, topn))
    monkeypatch.setattr(TF.CL, "k_sweep", lambda df, vec, ks, seed=42, tokens=None: ks)
    assert QUERIES["t20_lda_grid"](spark, SMALL) == ([15, 20, 25, 30, 35, 40], 6, 20)
    assert {25, 30} <= set(QUERIES["t13_k_sweep"](spark, SMALL))
    assert len(QUERIES["t01_embed_documents"](spark, SMALL).groupBy("pos").count().collect()) == 32
