"""Q1-Q4, A17, A18."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cleaning as N
from ..operators import dashboard as B
from .registry import BUREAUS_SQL, bureaus, query, table


def _customers(spark, sf):
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return table(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))


_CUSTOMERS = """customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


@query("q01_filter_cases", f"""SELECT c_custkey, c_name FROM {_CUSTOMERS} WHERE r_name = 'ASIA'
  AND c_mktsegment = 'BUILDING'""")
def q01(spark, sf):
    return B.filter_cases(_customers(spark, sf), ["c_custkey", "c_name"], r_name="ASIA", n_name=None,
                          c_mktsegment="BUILDING")


@query("q02_filter_in", f"""SELECT c_custkey, n_name FROM {_CUSTOMERS} WHERE r_name = 'ASIA'
  AND n_name IN ('NATION_2', 'NATION_7')""")
def q02(spark, sf):
    return B.filter_in(_customers(spark, sf), "r_name", "ASIA", "n_name", ["NATION_2", "NATION_7"]).select(
        "c_custkey", "n_name")


@query("q03_distinct_options", f"SELECT DISTINCT n_name FROM {_CUSTOMERS} WHERE r_name = 'EUROPE'")
def q03(spark, sf):
    return B.distinct_options(_customers(spark, sf), "n_name", r_name="EUROPE")


@query("q04_case_detail", """WITH o AS (SELECT * FROM orders WHERE o_orderkey = 7) SELECT 'Stage' AS label,
  o_orderstatus AS value FROM o UNION ALL SELECT 'Priority', o_orderpriority FROM o""")
def q04(spark, sf):
    o = table(spark, sf, "orders").withColumn("note", F.lit(None).cast("string"))
    return B.case_detail(o, "o_orderkey", 7, {"o_orderstatus": "Stage", "o_orderpriority": "Priority", "note": "Note"})


@query("a17_bureau_status_counts", f"""SELECT bureau, CASE WHEN o_orderstatus = 'F' THEN 'Retired' ELSE 'Active' END
  AS status, count(*) AS count FROM {BUREAUS_SQL} WHERE agency = 'AMERICA' GROUP BY 1, 2""")
def a17(spark, sf):
    b = B.filter_in(bureaus(spark, sf), "agency", "AMERICA", "bureau").withColumn(
        "status", N.status_flag(F.col("o_orderstatus"), "F"))
    return B.bureau_status_counts(b, "bureau", "status")


METRICS = {"status": "o_orderstatus", "priority": "o_orderpriority", "segment": "c_mktsegment",
           "bureau": "bureau", "band": "band"}
_BAND = "CASE WHEN o_totalprice >= 300000 THEN 'High' WHEN o_totalprice >= 150000 THEN 'Medium' ELSE 'Low' END"
A18_SQL = f"""WITH b AS (SELECT *, {_BAND} AS band FROM {BUREAUS_SQL} WHERE agency = 'ASIA') """ + " UNION ALL ".join(
    f"SELECT '{m}' AS metric, {c} AS value, count(*) AS count FROM b WHERE {c} IS NOT NULL GROUP BY 2"
    for m, c in METRICS.items())


@query("a18_agency_dashboard", A18_SQL)
def a18(spark, sf):
    b = B.filter_in(bureaus(spark, sf), "agency", "ASIA", "bureau")
    p = F.col("o_totalprice")
    b = b.withColumn("band", F.when(p >= 300000, "High").when(p >= 150000, "Medium").otherwise("Low"))
    return B.agency_dashboard(b, METRICS)
