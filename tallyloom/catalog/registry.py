"""Query registry and the derived inputs several queries share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.skew import use_all_cores

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def narratives(spark: SparkSession, sf: str, name: str = "documents", *columns: str) -> DataFrame:
    """A text table whose rows are costly to process."""
    df = table(spark, sf, name)
    return use_all_cores(df.select(*columns) if columns else df)


def sql_text(v: str | None) -> str:
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


def sql_list(values: Sequence[str | None]) -> str:
    return "[" + ", ".join(sql_text(v) for v in values) + "]"


# --- impact: documents with the label pair as an impact answer ----------------
IMPACT_SQL = """(SELECT d.doc_id, d.source, d.lang, CASE
  WHEN quality = 1 AND toxic = 1 THEN 'Both' WHEN quality = 1 THEN 'Rights-impacting'
  WHEN toxic = 1 THEN 'Safety-impacting' WHEN quality = 0 THEN 'Neither' END AS impact
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def impact_expr():
    q, t = F.col("quality"), F.col("toxic")
    return (
        F.when((q == 1) & (t == 1), "Both").when(q == 1, "Rights-impacting")
        .when(t == 1, "Safety-impacting").when(q == 0, "Neither")
    )


def impact(spark, sf, *extra: str) -> DataFrame:
    d = narratives(spark, sf, "documents", "doc_id", "source", "lang", *extra) if extra else table(
        spark, sf, "documents").select("doc_id", "source", "lang")
    return d.join(table(spark, sf, "labels"), "doc_id", "left").select(
        "doc_id", "source", "lang", *extra, impact_expr().alias("impact")
    )


# --- lifecycle: order date as created, last ship date as retired ----------------
LIFECYCLE_SQL = """(SELECT o.o_orderkey, o.o_orderstatus, o.o_orderpriority,
  CAST(o.o_orderdate AS DATE) AS created,
  CASE WHEN o.o_orderstatus = 'F' THEN CAST(s.d AS DATE) END AS retired
  FROM orders o LEFT JOIN (SELECT l_orderkey, max(l_shipdate) d FROM lineitem GROUP BY 1) s
  ON o.o_orderkey = s.l_orderkey)"""


def lifecycle(spark, sf) -> DataFrame:
    last = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_shipdate").alias("d"))
    return table(spark, sf, "orders").join(last, "o_orderkey", "left").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority",
        F.col("o_orderdate").cast("date").alias("created"),
        F.when(F.col("o_orderstatus") == "F", F.col("d").cast("date")).alias("retired"),
    )


# --- bureaus: region as agency, nation as bureau ---------------------------------
BUREAUS_SQL = """(SELECT r_name AS agency, n_name AS bureau, c_custkey, c_mktsegment, o_orderkey,
  o_orderstatus, o_orderpriority, o_totalprice
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""


def bureaus(spark, sf) -> DataFrame:
    nation = table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    cust = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return table(spark, sf, "orders").join(cust, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("r_name").alias("agency"), F.col("n_name").alias("bureau"), "c_custkey", "c_mktsegment",
        "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice",
    )


# --- messy: one answer per order, cycling through spelling variants --------------
def messy_sql(answers: Sequence[str | None]) -> str:
    n = len(answers)
    return (f"(SELECT o_orderkey, ({sql_list(answers)})[CAST(o_orderkey % {n} AS INTEGER) + 1] AS answer "
            f"FROM orders)")


def messy(spark, sf, answers: Sequence[str | None]) -> DataFrame:
    arr = F.array(*[F.lit(a).cast("string") for a in answers])
    pick = (F.col("o_orderkey") % len(answers)).cast("int") + 1
    return table(spark, sf, "orders").select("o_orderkey", F.element_at(arr, pick).alias("answer"))


# --- vectors with every seventh one unlabelled -------------------------------------
NOISE_SQL = """(SELECT vec_id, embedding, CASE WHEN vec_id % 7 = 0 THEN -1 ELSE label END AS topic
  FROM embeddings)"""


def vectors_noise(spark, sf) -> DataFrame:
    return table(spark, sf, "embeddings").select(
        "vec_id", "embedding",
        F.when(F.col("vec_id") % 7 == 0, -1).otherwise(F.col("label")).alias("topic"),
    )


GAMMA_SQL = """(SELECT vec_id, label, list_transform(sq, lambda v: v / list_sum(sq)) AS gamma FROM
  (SELECT vec_id, label, list_transform(embedding, lambda v: CAST(v AS DOUBLE) * CAST(v AS DOUBLE)) AS sq
   FROM embeddings))"""


def gamma(spark, sf) -> DataFrame:
    from ..functions.vectors import to_probabilities
    return table(spark, sf, "embeddings").select(
        "vec_id", "label", to_probabilities(F.col("embedding")).alias("gamma"))
