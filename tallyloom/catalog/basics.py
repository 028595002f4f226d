"""S1-S6, P1-P6."""

from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from ..operators import profile as P
from ..sources import tables as S
from .registry import messy, messy_sql, query, table


_ALL_TEXT = """SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source,
  CAST(n_chars AS VARCHAR) AS n_chars FROM documents"""


@query("s01_read_inventory", _ALL_TEXT)
def s01(spark, sf):
    return S.read_inventory(spark, f"{sf}/documents.parquet")


@query("s01_read_inventory_csv", _ALL_TEXT)
def s01_csv(spark, sf):
    """All columns written as CSV and read back by the header, in another order."""
    out = _scratch(spark, "inventory")
    S.write_table(table(spark, sf, "documents"), out, "csv")
    return S.read_inventory(spark, out, ["n_chars", "text", "source", "doc_id", "lang"], fmt="csv")


def _scratch(spark, name: str) -> str:
    """A new folder on the cluster's shared storage (machine-local only in local mode)."""
    import uuid
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="tallyloom-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("s02_read_topic_outputs", """SELECT doc_id AS doc_index,
  CAST(doc_id % 40 AS INTEGER) AS lda_topic, CAST(n_chars AS DOUBLE) / 100000 AS lda_topic_prob,
  source AS lda_topic_name FROM documents""")
def s02(spark, sf):
    out = _scratch(spark, "topics")
    src = table(spark, sf, "documents").select(
        F.col("doc_id").alias("doc_index"), (F.col("doc_id") % 40).cast("int").alias("lda_topic"),
        (F.col("n_chars").cast("double") / 100000).alias("lda_topic_prob"),
        F.col("source").alias("lda_topic_name"))
    S.write_table(src, out, "csv")
    return S.read_topic_outputs(spark, out)


@query("s03_with_doc_index", """SELECT row_number() OVER (ORDER BY doc_id) - 1 AS doc_index, doc_id, source
  FROM documents""")
def s03(spark, sf):
    return S.with_doc_index(table(spark, sf, "documents").select("doc_id", "source"), "doc_id")


@query("s04_write_table", "SELECT doc_id, lang, source, text, n_chars FROM documents")
def s04(spark, sf):
    """Free text with quotes and line breaks through the CSV sink and back."""
    out = _scratch(spark, "documents")
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "text", "n_chars")
    S.write_table(docs, out, "csv")
    return S.read_csv(spark, out, docs.schema)


@query("s06_rename_columns", """SELECT o_orderkey AS case_id, o_orderstatus AS stage,
  o_orderpriority AS if_other_please_explain1 FROM orders""")
def s06(spark, sf):
    src = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("Stage of Development "),
        F.col("o_orderpriority").alias("If Other, please explain..1"))
    return S.rename_columns(
        src, {"o_orderkey": "case_id", "Stage of Development": "stage"}, ["If Other, please explain"])


_STATS_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS n, count({c}) AS nn, 1 - count({c}) / count(*) AS na_pct,
    {num} AS is_numeric, {dt} AS is_datetime, count(DISTINCT {c}) AS nunique,
    count(DISTINCT {c}) / count({c}) AS card_ratio,
    sum(length(CAST({c} AS VARCHAR))) / count({c}) AS avg_len,
    sum(CASE WHEN length(CAST({c} AS VARCHAR)) > 100 THEN 1 ELSE 0 END) / count({c}) AS pct_long FROM src"""
    for c, num, dt in [
        ("doc_id", "true", "false"), ("lang", "false", "false"), ("source", "false", "false"),
        ("text", "false", "false"), ("quality", "true", "false")])
_PROFILE_WITH = """WITH src AS (SELECT d.doc_id, lang, source, text, quality FROM documents d
  LEFT JOIN labels l ON d.doc_id = l.doc_id), stats AS (""" + _STATS_SQL + ")"
_ROUND = """round(na_pct, 6) AS na_pct, is_numeric, is_datetime, nunique, round(card_ratio, 6) AS card_ratio,
  round(avg_len, 4) AS avg_len, round(pct_long, 6) AS pct_long"""


def _profiled(spark, sf):
    src = table(spark, sf, "documents").select("doc_id", "lang", "source", "text").join(
        table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return P.column_stats(src)


def _round_stats(df):
    return P.rounded(P.rounded(df, 6, "na_pct", "card_ratio", "pct_long"), 4, "avg_len")


@query("p01_column_stats", _PROFILE_WITH + f' SELECT "column", n, nn, {_ROUND} FROM stats')
def p01(spark, sf):
    return _round_stats(_profiled(spark, sf))


@query("p02_classify_columns", _PROFILE_WITH + """ SELECT "column", CASE
  WHEN n < 50 OR na_pct >= 0.98 THEN 'ignored (too sparse)' WHEN is_numeric OR is_datetime THEN 'dates/ids/numeric'
  WHEN avg_len >= 80 OR pct_long >= 0.30 THEN 'open_ended'
  WHEN card_ratio <= 0.05 AND avg_len <= 60 THEN 'categorical' ELSE 'other_text' END AS class FROM stats""")
def p02(spark, sf):
    return P.classify_columns(_profiled(spark, sf)).select("column", "class")


@query("p03_column_roles", _PROFILE_WITH + """ SELECT "column", CASE WHEN "column" = 'source' THEN 'open_ended'
  WHEN is_numeric OR is_datetime THEN 'numeric/date'
  WHEN nunique <= 25 AND card_ratio <= 0.05 THEN 'categorical'
  WHEN avg_len >= 80 OR card_ratio >= 0.25 THEN 'open_ended' ELSE 'other_text' END AS role FROM stats""")
def p03(spark, sf):
    return P.column_roles(_profiled(spark, sf), ["source"]).select("column", "role")


@query("p04_missing_pct", """SELECT 'lang' AS "column", round(sum(CASE WHEN lang = 'en' THEN 1 ELSE 0 END) * 100.0
  / count(*), 6) AS missing_pct FROM documents UNION ALL SELECT 'source', round(sum(CASE WHEN source = 'src1'
  THEN 1 ELSE 0 END) * 100.0 / count(*), 6) FROM documents UNION ALL SELECT 'text', 0.0""")
def p04(spark, sf):
    d = table(spark, sf, "documents").select(
        F.nullif("lang", F.lit("en")).alias("lang"), F.nullif("source", F.lit("src1")).alias("source"), "text")
    return P.rounded(P.missing_pct(d), 6, "missing_pct")


@query("p05_missing_matrix", """SELECT d.doc_id, lang IS NULL AS lang, source IS NULL AS source,
  quality IS NULL AS quality, toxic IS NULL AS toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def p05(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "source").join(
        table(spark, sf, "labels"), "doc_id", "left")
    return P.missing_matrix(d, "doc_id")


@query("p06_describe", """SELECT count(l_extendedprice) AS count, round(avg(l_extendedprice), 4) AS mean,
  round(stddev_samp(l_extendedprice), 4) AS std, min(l_extendedprice) AS min,
  round(quantile_cont(l_extendedprice, 0.25), 4) AS p25, round(quantile_cont(l_extendedprice, 0.5), 4) AS p50,
  round(quantile_cont(l_extendedprice, 0.75), 4) AS p75, max(l_extendedprice) AS max FROM lineitem""")
def p06(spark, sf):
    return P.rounded(P.describe(table(spark, sf, "lineitem"), "l_extendedprice"), 4,
                     "mean", "std", "p25", "p50", "p75")
