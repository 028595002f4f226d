"""J1-J6, A1-A16, A19-A23, W1-W10."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.cleaning import strip
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import windows as W
from ..operators.profile import rounded
from .registry import (
    BUREAUS_SQL, GAMMA_SQL, IMPACT_SQL, LIFECYCLE_SQL, NOISE_SQL, bureaus, gamma, impact, lifecycle, query, table,
    vectors_noise,
)

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


# --- joins ---------------------------------------------------------------------
@query("j01_left_join", """SELECT d.doc_id, d.source, l.quality, l.toxic FROM documents d
  LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def j01(spark, sf):
    return J.left_join(table(spark, sf, "documents").select("doc_id", "source"), table(spark, sf, "labels"), "doc_id")


@query("j02_label_lookup", """SELECT c_custkey, 'lda_t' || c_nationkey AS topic_key, c_nationkey, n_name
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def j02(spark, sf):
    names = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return J.label_lookup(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), names, "c_nationkey", "n_name")


@query("j03_consolidate_by_id", "SELECT d.doc_id, d.source, " + ", ".join(
    f"round(g.gamma[{i + 1}], 6) AS lda_t{i}" for i in range(64))
    + f" FROM documents d LEFT JOIN {GAMMA_SQL} g ON d.doc_id = g.vec_id")
def j03(spark, sf):
    probs = W.one_hot(gamma(spark, sf).select(
        F.col("vec_id").alias("doc_id"), *[F.round(F.get("gamma", F.lit(i)), 6).alias(f"lda_t{i}") for i in range(64)],
        "label"), "label", [0, 1], "lda_dom_t", "_").drop("label")
    return J.consolidate(table(spark, sf, "documents").select("doc_id", "source"), probs, "doc_id")


@query("j03_consolidate_fan_out", f"""SELECT d.doc_id, d.source, l.doc_id AS other, l.quality AS lda_t0
  FROM documents d LEFT JOIN (SELECT documents.doc_id, source, quality FROM labels JOIN documents
  ON labels.doc_id = documents.doc_id) l ON d.source = l.source""")
def j03b(spark, sf):
    """A repeated key multiplies rows, as the name-keyed join does."""
    d = table(spark, sf, "documents").select("doc_id", "source")
    probs = table(spark, sf, "labels").join(d, "doc_id").select(
        "source", F.col("doc_id").alias("other"), F.col("quality").alias("lda_t0"), F.lit(1).alias("lda_dom_t_0"))
    return J.consolidate(d, probs, "source")


@query("j03_consolidate_dedupe", """SELECT d.doc_id, d.source, l.n AS lda_t0 FROM documents d LEFT JOIN
  (SELECT source, count(*) AS n FROM documents JOIN labels ON documents.doc_id = labels.doc_id GROUP BY 1) l
  ON d.source = l.source""")
def j03c(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source")
    n = d.join(table(spark, sf, "labels"), "doc_id").groupBy("source").agg(F.count(F.lit(1)).alias("lda_t0"))
    twice = n.unionByName(n)
    return J.consolidate(d, twice, "source", dedupe=True)


@query("j04_outer_counts", """SELECT source, count(*) AS total, count(*) FILTER (lang = 'en') AS in_group,
  count(*) FILTER (lang <> 'en') AS in_rest FROM documents GROUP BY 1""")
def j04(spark, sf):
    return J.outer_counts(table(spark, sf, "documents"), "source", F.col("lang") == "en")


@query("j05_dedup_join", """SELECT d.doc_id, d.lang, x.quality FROM documents d LEFT JOIN (SELECT DISTINCT doc_id, quality
  FROM labels) x ON d.doc_id = x.doc_id""")
def j05(spark, sf):
    labels = table(spark, sf, "labels")
    return J.dedup_join(table(spark, sf, "documents").select("doc_id", "lang"), labels.unionByName(labels),
                        ["doc_id"], ["quality"])


@query("j06_ratio_join", """SELECT year(o_orderdate) AS year, o_orderpriority, count(*) AS n,
  count(*) FILTER (o_orderstatus = 'F') AS k, round(count(*) FILTER (o_orderstatus = 'F') * 100.0 / count(*), 1) AS pct
  FROM orders GROUP BY 1, 2""")
def j06(spark, sf):
    o = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate").cast("long"))
    return J.ratio_join(o, ["year", "o_orderpriority"], F.col("o_orderstatus") == "F")


# --- counts ----------------------------------------------------------------------
@query("a01_value_counts", """SELECT o_orderpriority AS value, count(*) AS count,
  round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS pct FROM orders GROUP BY 1""")
def a01(spark, sf):
    return rounded(A.value_counts(table(spark, sf, "orders"), "o_orderpriority", normalize=True), 6, "pct")


@query("a01_value_counts_nulls", f"""SELECT impact AS value, count(*) AS count FROM {IMPACT_SQL} GROUP BY 1""")
def a01b(spark, sf):
    return A.value_counts(impact(spark, sf), "impact", dropna=False)


@query("a02_counts_in_order", """WITH c AS (SELECT position, label, (SELECT count(*) FROM orders WHERE
  o_orderpriority = label) AS count FROM (VALUES (0, '5-LOW'), (1, '1-URGENT'), (2, '9-NEVER')) v(position, label))
  SELECT position, label, count, round(count * 100.0 / sum(count) OVER (), 1) AS pct FROM c""")
def a02(spark, sf):
    return A.counts_in_order(table(spark, sf, "orders"), "o_orderpriority", ["5-LOW", "1-URGENT", "9-NEVER"])


@query("a02_counts_with_remainder", """WITH c AS (SELECT position, label, (SELECT count(*) FROM orders WHERE
  CASE WHEN o_orderpriority IN ('5-LOW', '1-URGENT') THEN o_orderpriority ELSE 'Other' END = label) AS count
  FROM (VALUES (0, '5-LOW'), (1, '1-URGENT'), (2, 'Other')) v(position, label))
  SELECT position, label, count, round(count * 100.0 / sum(count) OVER (), 1) AS pct FROM c""")
def a02b(spark, sf):
    return A.counts_in_order(table(spark, sf, "orders"), "o_orderpriority", ["5-LOW", "1-URGENT"], other="Other")


@query("a02_counts_preferred", """SELECT o_orderpriority AS value, count(*) AS count, CASE o_orderpriority
  WHEN '5-LOW' THEN 1 WHEN '1-URGENT' THEN 2 ELSE 3 END AS position FROM orders GROUP BY 1""")
def a02c(spark, sf):
    return A.counts_preferred(table(spark, sf, "orders"), "o_orderpriority", ["5-LOW", "1-URGENT"])


@query("a03_top_n_counts", """SELECT p_brand AS value, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM part), 6)
  AS pct FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def a03(spark, sf):
    return rounded(A.top_n_counts(table(spark, sf, "part"), "p_brand", 10), 6, "pct")


@query("a04_group_proportions", "SELECT agency, " + ", ".join(
    f"round(count(*) FILTER (c_mktsegment = '{s}') / count(c_mktsegment), 6) AS \"{s}\"" for s in SEGMENTS)
    + f" FROM {BUREAUS_SQL} GROUP BY 1")
def a04(spark, sf):
    return rounded(A.group_proportions(bureaus(spark, sf), "agency", "c_mktsegment", SEGMENTS), 6, *SEGMENTS)


@query("a05_crosstab", "SELECT o_orderstatus, " + ", ".join(
    f"count(*) FILTER (o_orderpriority = '{p}') AS \"{p}\"" for p in PRIORITIES) + " FROM orders GROUP BY 1")
def a05(spark, sf):
    return A.crosstab(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority", PRIORITIES)


@query("a05_crosstab_index", "SELECT o_orderstatus, " + ", ".join(
    f"round(count(*) FILTER (o_orderpriority = '{p}') / count(*), 4) AS \"{p}\"" for p in PRIORITIES)
    + " FROM orders GROUP BY 1")
def a05b(spark, sf):
    return A.crosstab(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority", PRIORITIES, "index", 4)


@query("a05_crosstab_columns", "SELECT o_orderstatus, " + ", ".join(
    f"round(count(*) FILTER (o_orderpriority = '{p}') / (SELECT count(*) FROM orders WHERE o_orderpriority = '{p}'), 4) "
    f"AS \"{p}\"" for p in PRIORITIES) + " FROM orders GROUP BY 1")
def a05c(spark, sf):
    return A.crosstab(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority", PRIORITIES, "columns", 4)


_IMPACTFUL = "impact IN ('Rights-impacting', 'Safety-impacting', 'Both')"


def _shares(prefix=""):
    return ", ".join(
        f"round(count(*) FILTER (impact = '{t}') / count(*), 6) AS {n}_share"
        for t, n in zip(A.IMPACT_TYPES, ("rights", "safety", "both")))


A06_SQL = f"""SELECT coalesce(source, 'Unknown') AS agency, count(*) AS total,
  count(*) FILTER ({_IMPACTFUL}) AS impact_count, {_shares()},
  round(count(*) FILTER ({_IMPACTFUL}) / count(*), 6) AS impact_share
  FROM {IMPACT_SQL} GROUP BY 1 HAVING count(*) FILTER ({_IMPACTFUL}) > 0"""


@query("a06_impact_share_by_agency", A06_SQL)
def a06(spark, sf):
    return rounded(A.impact_share_by_agency(impact(spark, sf), "source", "impact"), 6,
                   "rights_share", "safety_share", "both_share", "impact_share")


_A07 = f"""SELECT source AS agency, count(*) FILTER ({_IMPACTFUL}) AS impact_count, count(*) AS total,
  round(count(*) FILTER ({_IMPACTFUL}) / count(*), 6) AS impact_pct,
  count(*) FILTER (impact = 'Rights-impacting') AS rights, count(*) FILTER (impact = 'Safety-impacting') AS safety,
  count(*) FILTER (impact = 'Both') AS both, count(*) FILTER ({_IMPACTFUL}) <= 3 AS low_count
  FROM {IMPACT_SQL} GROUP BY 1 HAVING count(*) FILTER ({_IMPACTFUL}) > 0"""


@query("a07_impact_summary", _A07)
def a07(spark, sf):
    return rounded(A.impact_summary(impact(spark, sf), "source", "impact"), 6, "impact_pct")


@query("a07_impact_both_ends", f"""SELECT *, 'top' AS side FROM (SELECT * FROM ({_A07}) ORDER BY impact_pct DESC, agency
  LIMIT 5) UNION ALL SELECT *, 'bottom' FROM (SELECT * FROM ({_A07}) ORDER BY impact_pct, agency DESC LIMIT 5)""")
def a07b(spark, sf):
    return A.both_ends(a07(spark, sf), "impact_pct", "agency", 5)


@query("a08_impactful_rate", f"""SELECT count(*) AS total, count(*) FILTER ({_IMPACTFUL}) AS flagged,
  round(count(*) FILTER ({_IMPACTFUL}) * 100.0 / count(*), 6) AS pct FROM {IMPACT_SQL}""")
def a08(spark, sf):
    return rounded(A.flag_rate(impact(spark, sf), F.col("impact").isin(*A.IMPACT_TYPES)), 6, "pct")


_A09 = f"""SELECT bureau, round(count(*) FILTER (o_orderstatus = 'F') * 100.0 / count(*), 6) AS rate, count(*) AS n
  FROM {BUREAUS_SQL} GROUP BY 1"""


@query("a09_rate_by_group", _A09)
def a09(spark, sf):
    return rounded(A.rate_by_group(bureaus(spark, sf), "bureau", F.col("o_orderstatus") == "F"), 6, "rate")


@query("a10_small_group_filter", f"SELECT * FROM ({_A09}) WHERE rate >= 30 AND n <= 700")
def a10(spark, sf):
    return A.small_group_filter(a09(spark, sf), 30, 700)


@query("a11_counts_by_year", """SELECT year(o_orderdate) AS year, count(*) AS count FROM orders GROUP BY 1""")
def a11(spark, sf):
    return A.counts_by_year(table(spark, sf, "orders"), "o_orderdate")


@query("a12_share_by_year", """SELECT year(o_orderdate) AS year, round(count(*) FILTER (o_orderstatus = 'F') * 100.0
  / count(*), 6) AS share FROM orders GROUP BY 1""")
def a12(spark, sf):
    return rounded(A.share_by_year(table(spark, sf, "orders"), "o_orderdate", F.col("o_orderstatus") == "F"), 6, "share")


@query("a12_share_by_retired_year", f"""SELECT year(retired) AS year, round(count(*) FILTER (o_orderpriority = '1-URGENT')
  * 100.0 / count(*), 6) AS share FROM {LIFECYCLE_SQL} WHERE retired IS NOT NULL GROUP BY 1""")
def a12b(spark, sf):
    return rounded(A.share_by_year(lifecycle(spark, sf), "retired", F.col("o_orderpriority") == "1-URGENT"), 6, "share")


@query("a13_mix_by_year", "SELECT year(o_orderdate) AS year, " + ", ".join(
    f"round(count(*) FILTER (o_orderstatus = '{s}') * 100.0 / count(*), 6) AS \"{s}\"" for s in "FOP")
    + " FROM orders GROUP BY 1")
def a13(spark, sf):
    return rounded(A.mix_by_year(table(spark, sf, "orders"), "o_orderdate", "o_orderstatus", list("FOP")), 6, *"FOP")


_COUNTS = ", ".join(f"count(*) FILTER (o_orderpriority = '{p}') AS \"{p}\"" for p in PRIORITIES)


@query("a14_year_by_category", f"SELECT year(o_orderdate) AS year, {_COUNTS}, count(*) AS total FROM orders GROUP BY 1")
def a14(spark, sf):
    return A.year_by_category(table(spark, sf, "orders"), "o_orderdate", "o_orderpriority", PRIORITIES)


@query("a14_retired_year_by_category", f"""SELECT year(retired) AS year, {_COUNTS}, count(*) AS total
  FROM {LIFECYCLE_SQL} WHERE retired IS NOT NULL GROUP BY 1""")
def a14b(spark, sf):
    return A.year_by_category(lifecycle(spark, sf), "retired", "o_orderpriority", PRIORITIES)


@query("a15_heat_pct", "SELECT year(o_orderdate) AS year, " + ", ".join(
    f"round(count(*) FILTER (o_orderpriority = '{p}' AND o_orderstatus = 'F') * 100.0 / "
    f"nullif(count(*) FILTER (o_orderpriority = '{p}'), 0), 1) AS \"{p}_pct\", "
    f"count(*) FILTER (o_orderpriority = '{p}') AS \"{p}_n\"" for p in PRIORITIES) + " FROM orders GROUP BY 1")
def a15(spark, sf):
    return A.heat_pct(table(spark, sf, "orders"), "o_orderdate", "o_orderpriority", PRIORITIES,
                      F.col("o_orderstatus") == "F")


@query("a16_peak_period", """SELECT category, year AS peak_year, n AS peak_count FROM (SELECT o_orderpriority AS category,
  year(o_orderdate) AS year, count(*) AS n, row_number() OVER (PARTITION BY o_orderpriority
  ORDER BY count(*) DESC, year(o_orderdate)) AS rn FROM orders GROUP BY 1, 2) WHERE rn = 1""")
def a16(spark, sf):
    return A.peak_period(table(spark, sf, "orders"), "o_orderdate", "o_orderpriority")


@query("a19_topic_health", f"""WITH s AS (SELECT topic, count(*) AS n FROM {NOISE_SQL} GROUP BY 1) SELECT
  round(sum(CASE WHEN topic < 0 THEN n ELSE 0 END) / sum(n), 6) AS outlier_rate,
  count(*) FILTER (topic >= 0) AS n_topics, round(count(*) FILTER (topic >= 0 AND n < 45)
  / count(*) FILTER (topic >= 0), 6) AS tiny_topic_share FROM s""")
def a19(spark, sf):
    return rounded(A.topic_health(vectors_noise(spark, sf), "topic", tiny=45), 6, "outlier_rate", "tiny_topic_share")


@query("a20_group_median", "SELECT lang, round(median(n_chars), 4) AS median FROM documents GROUP BY 1")
def a20(spark, sf):
    return rounded(A.group_median(table(spark, sf, "documents"), "lang", "n_chars"), 4, "median")


@query("a21_prob_bins", """WITH p AS (SELECT l_discount * 6 AS p FROM lineitem), b AS (SELECT CASE WHEN p < 0.20 THEN '<0.20'
  WHEN p < 0.35 THEN '0.20-0.35' WHEN p < 0.50 THEN '0.35-0.50' ELSE '>=0.50' END AS bin FROM p)
  SELECT position, label, (SELECT count(*) FROM b WHERE bin = label) AS count,
  round((SELECT count(*) FROM b WHERE bin = label) * 100.0 / (SELECT count(*) FROM b), 1) AS pct
  FROM (VALUES (0, '<0.20'), (1, '0.20-0.35'), (2, '0.35-0.50'), (3, '>=0.50')) v(position, label)""")
def a21(spark, sf):
    return A.prob_bins(table(spark, sf, "lineitem").select((F.col("l_discount") * 6).alias("p")), "p")


@query("a22_entropy_quartiles", """WITH e AS (SELECT quantile_cont(l_extendedprice, 0.25) AS a, quantile_cont(l_extendedprice, 0.5)
  AS b, quantile_cont(l_extendedprice, 0.75) AS c FROM lineitem) SELECT CASE WHEN l_extendedprice <= a THEN 1
  WHEN l_extendedprice <= b THEN 2 WHEN l_extendedprice <= c THEN 3 ELSE 4 END AS quartile, count(*) AS n
  FROM lineitem, e GROUP BY 1""")
def a22(spark, sf):
    return A.quantile_bins(table(spark, sf, "lineitem").select("l_extendedprice"), "l_extendedprice")


@query("a23_histogram", """WITH s AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
  SELECT CAST(least(29, floor((o_totalprice - lo) / ((hi - lo) / 30))) AS BIGINT) AS bin, count(*) AS n
  FROM orders, s GROUP BY 1""")
def a23(spark, sf):
    return A.histogram(table(spark, sf, "orders"), "o_totalprice", 30)


@query("a23_histogram_by_class", """WITH s AS (SELECT o_orderstatus AS k, min(o_totalprice) AS lo, max(o_totalprice) AS hi
  FROM orders GROUP BY 1) SELECT o_orderstatus, CAST(least(29, floor((o_totalprice - lo) / ((hi - lo) / 30))) AS BIGINT)
  AS bin, count(*) AS n FROM orders JOIN s ON o_orderstatus = k GROUP BY 1, 2""")
def a23b(spark, sf):
    return A.histogram(table(spark, sf, "orders"), "o_totalprice", 30, ["o_orderstatus"])


# --- windows and reshapes ------------------------------------------------------------
@query("w01_top_k_per_group", """SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice, rank FROM (SELECT *, row_number() OVER
  (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey) AS rank FROM lineitem)
  WHERE rank <= 3""")
def w01(spark, sf):
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return W.top_k_per_group(li, ["l_suppkey"], [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber"),
                                                 F.asc("l_partkey")], 3)


@query("w02_best_per_key", """SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY
  l_orderkey ORDER BY l_quantity DESC, l_partkey, l_linenumber) AS rn FROM lineitem) WHERE rn = 1""")
def w02(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    return W.best_per_key(li, ["l_orderkey"], [F.desc("l_quantity"), F.asc("l_partkey"), F.asc("l_linenumber")])


@query("w03_multi_key_best", """SELECT p_partkey, p_size, p_retailprice FROM part ORDER BY p_size, p_retailprice DESC,
  p_brand DESC, p_partkey DESC LIMIT 1""")
def w03(spark, sf):
    return W.multi_key_best(table(spark, sf, "part"), [
        F.asc("p_size"), F.desc("p_retailprice"), F.desc("p_brand"), F.desc("p_partkey")]).select(
        "p_partkey", "p_size", "p_retailprice")


@query("w04_constrained_best", """SELECT p_partkey, p_size, p_retailprice FROM part WHERE p_size BETWEEN 20 AND 30
  AND p_retailprice <= 1000 ORDER BY p_retailprice, p_size, p_partkey LIMIT 1""")
def w04(spark, sf):
    ok = F.col("p_size").between(20, 30) & (F.col("p_retailprice") <= 1000)
    return W.constrained_best(table(spark, sf, "part"), ok, [F.asc("p_retailprice"), F.asc("p_size"), F.asc("p_partkey")]
                              ).select("p_partkey", "p_size", "p_retailprice")


@query("w04_constrained_best_fallback", """SELECT p_partkey, p_size, p_retailprice FROM part
  ORDER BY p_retailprice DESC, p_size, p_partkey LIMIT 1""")
def w04b(spark, sf):
    return W.constrained_best(table(spark, sf, "part"), F.col("p_size") < 0,
                              [F.desc("p_retailprice"), F.asc("p_size"), F.asc("p_partkey")]
                              ).select("p_partkey", "p_size", "p_retailprice")


_NORM = r"regexp_replace(lower(text), '^\s+|\s+$', '', 'g')"


@query("w05_duplicated", f"""SELECT doc_id, lang, count(*) OVER (PARTITION BY {_NORM}) > 1 AS is_duplicate FROM documents""")
def w05(spark, sf):
    return W.duplicated(table(spark, sf, "documents").select("doc_id", "lang", "text"), "text").drop("text")


@query("w05_duplicate_share", f"""SELECT count(*) AS total, count(*) FILTER (dup) AS flagged,
  round(count(*) FILTER (dup) * 100.0 / count(*), 6) AS pct FROM (SELECT lang, count(*) OVER (PARTITION BY {_NORM}) > 1
  AS dup FROM documents) WHERE lang <> 'en'""")
def w05b(spark, sf):
    """Share of duplicates among flagged rows, divided by the flagged rows."""
    return rounded(A.flag_rate(w05(spark, sf).filter("lang <> 'en'"), F.col("is_duplicate")), 6, "pct")


@query("w06_melt", f"""WITH s AS (SELECT bureau, round(count(*) FILTER (o_orderstatus = 'F') / count(*), 6) AS f,
  round(count(*) FILTER (o_orderstatus = 'O') / count(*), 6) AS o FROM {BUREAUS_SQL} GROUP BY 1)
  SELECT bureau, 'f_share' AS "group", f AS share FROM s UNION ALL SELECT bureau, 'o_share', o FROM s""")
def w06(spark, sf):
    n = F.count(F.lit(1))
    wide = bureaus(spark, sf).groupBy("bureau").agg(
        F.round(F.count_if(F.col("o_orderstatus") == "F") / n, 6).alias("f_share"),
        F.round(F.count_if(F.col("o_orderstatus") == "O") / n, 6).alias("o_share"))
    return W.melt(wide, ["bureau"], ["f_share", "o_share"], "group", "share")


@query("w07_one_hot", "SELECT o_orderkey, o_orderpriority, " + ", ".join(
    f"CASE WHEN o_orderpriority = '{p}' THEN 1 ELSE 0 END AS \"priority={p}\"" for p in PRIORITIES) + " FROM orders")
def w07(spark, sf):
    return W.one_hot(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", PRIORITIES,
                     "priority")


@query("w08_explode_probs", f"""SELECT vec_id, CAST(i - 1 AS INTEGER) AS topic, round(gamma[i], 8) AS prob FROM
  (SELECT vec_id, gamma, unnest(range(1, len(gamma) + 1)) AS i FROM {GAMMA_SQL})""")
def w08(spark, sf):
    return rounded(W.explode_probs(gamma(spark, sf), "vec_id", "gamma"), 8, "prob")


@query("w09_spread_probs", f"""SELECT g.vec_id, topic, """ + ", ".join(
    f"CASE WHEN topic >= 0 THEN round(gamma[{i + 1}], 8) ELSE 0.0 END AS lda_t{i}" for i in range(64))
    + f" FROM {GAMMA_SQL} g JOIN {NOISE_SQL} n ON g.vec_id = n.vec_id")
def w09(spark, sf):
    g = gamma(spark, sf).withColumn("topic", F.when(F.col("vec_id") % 7 == 0, -1).otherwise(F.col("label")))
    return rounded(W.spread_probs(g.drop("label"), "gamma", 64, topic="topic"), 8, *[f"lda_t{i}" for i in range(64)])


@query("w10_dominant", f"""SELECT vec_id, CAST(list_position(gamma, list_max(gamma)) - 1 AS INTEGER) AS topic,
  round(list_max(gamma), 8) AS prob FROM {GAMMA_SQL}""")
def w10(spark, sf):
    return rounded(W.dominant(gamma(spark, sf), "gamma").select("vec_id", "topic", "prob"), 8, "prob")
