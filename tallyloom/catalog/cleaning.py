"""Normalisers on every order row."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cleaning as N
from ..functions import constants as K
from ..functions import dates as D
from ..functions import scoring
from ..operators import aggregates as A
from .registry import (
    LIFECYCLE_SQL, bureaus, lifecycle, messy, messy_sql, query, sql_list, table,
)

CATEGORICAL = [" Yes ", "YES – done", "no - later", "", "nan", "NA", "N/A", "n/a", None, "Maybe", "Nan", "no"]
_STRIP = r"regexp_replace(answer, '^\s+|\s+$', '', 'g')"


def _answers(name, answers, build, sql_case, out="cleaned"):
    """One query: the builder over the messy answers, checked by a hand-written CASE."""
    sql = (f"SELECT o_orderkey, answer, {sql_case} AS {out} FROM (SELECT *, {_STRIP} AS s, "
           f"lower({_STRIP}) AS low FROM {messy_sql(answers)})")

    @query(name, sql)
    def run(spark, sf):
        return messy(spark, sf, answers).select("o_orderkey", "answer", build(F.col("answer")).alias(out))
    return run


_answers("n01_clean_categorical", CATEGORICAL, N.clean_categorical, r"""CASE
  WHEN s IS NULL OR s IN ('', 'Nan', 'nan', 'NA') THEN 'Unknown' WHEN s IN ('N/A', 'n/a') THEN 'Not applicable'
  WHEN regexp_matches(s, '(?i)^yes\s*[-–].*$') THEN 'Yes' WHEN regexp_matches(s, '(?i)^no\s*[-–].*$') THEN 'No'
  ELSE s END""")
_answers("n02_clean_text", CATEGORICAL, N.clean_text, "CASE WHEN s NOT IN ('', 'Nan', 'nan') THEN s END")

IMPACTS = ["Rights-Impacting\n", "Safety-Impacting", "rights – impacting", "both", "Neither", "Both ",
           "Case-by-case assessment", "No, use case is too new to fully assess impacts; will be reassessed before "
           "end of initiation stage.", "nan", None, "other", "", "Safety-impacting", "Rights  impacting"]
_MAP4 = """CASE low WHEN 'rights-impacting' THEN 'Rights-impacting' WHEN 'safety-impacting' THEN 'Safety-impacting'
  WHEN 'both' THEN 'Both' WHEN 'neither' THEN 'Neither' ELSE low END"""
_NEW = " OR ".join(f"low = '{t}'" for t in K.TOO_NEW_ANSWERS)
for _policy, _case in {
    "simple": "CASE answer WHEN 'Safety-Impacting' THEN 'Safety-impacting' "
              "WHEN 'Rights-Impacting' || chr(10) THEN 'Rights-impacting' ELSE answer END",
    "grouped": f"CASE WHEN low IS NULL OR low IN ('', 'nan') THEN 'Unknown' WHEN {_NEW} THEN 'Too new to assess' "
               f"ELSE {_MAP4} END",
    "unknown": f"CASE WHEN low IS NULL OR low IN ('', 'nan') OR {_NEW} THEN 'Unknown' ELSE {_MAP4} END",
    "lower": f"CASE WHEN low IN ('', 'nan') THEN NULL ELSE {_MAP4} END",
    "regex": r"""CASE WHEN low IS NULL OR low = 'nan' THEN NULL
      WHEN regexp_full_match(low, 'rights\s*[–—\s-]?\s*impacting') THEN 'Rights-impacting'
      WHEN regexp_full_match(low, 'safety\s*[–—\s-]?\s*impacting') THEN 'Safety-impacting'
      WHEN low = 'both' THEN 'Both' WHEN low = 'neither' THEN 'Neither'
      WHEN starts_with(low, 'no, use case is too new') OR contains(low, 'reassessed')
        OR contains(low, 'case-by-case') THEN 'Neither' ELSE s END""",
}.items():
    _answers(f"n03_normalize_impact_{_policy}", IMPACTS,
             lambda c, p=_policy: N.normalize_impact(c, p), _case)
_answers("n04_impact_code", IMPACTS + ["Rights and safety impacting"], N.impact_code, """CASE
  WHEN contains(low, 'both') OR (contains(low, 'right') AND contains(low, 'safety')) THEN 3
  WHEN contains(low, 'neither') THEN 0 WHEN contains(low, 'right') THEN 1 WHEN contains(low, 'safety') THEN 2 END""")

RESOURCING = ["Developed in-house", "contract", "both contract and in-house", "combination", "no contract", "neither",
              "external", "inhouse", "data not reported by submitter", " ", None, "In House", "Contracts", "nan"]
_answers("n05_normalize_resourcing", RESOURCING, N.normalize_resourcing, """CASE WHEN s IS NULL OR s = '' THEN 'Unknown'
  WHEN contains(low, 'contract') OR contains(low, 'external') THEN CASE WHEN regexp_matches(low,
    'in-house|in house|combination|both') THEN 'Both' ELSE 'External Contracting' END
  WHEN regexp_matches(low, 'in-house|in house') THEN 'In-House' WHEN contains(low, 'neither') THEN 'Neither'
  ELSE 'Unknown' END""")
_answers("n06_dev_bucket", RESOURCING, N.dev_bucket, """CASE
  WHEN s IS NULL OR s = '' OR contains(low, 'data not reported by submitter') THEN 'Unknown'
  WHEN regexp_matches(low, 'both|combination') THEN 'Hybrid (Contract + In-house)'
  WHEN regexp_matches(low, 'no contract|in-house|in house|inhouse') THEN CASE WHEN regexp_matches(low,
    'contract|external') THEN 'Hybrid (Contract + In-house)' ELSE 'In-house' END
  WHEN regexp_matches(low, 'contract|external') THEN 'Contract' ELSE 'Unknown' END""")
_answers("n07_dev_method_simple", RESOURCING, N.dev_method_simple, """CASE WHEN low IS NULL OR low IN ('', 'nan')
  THEN 'Unknown' WHEN contains(low, 'contract') THEN 'Contract'
  WHEN regexp_matches(low, 'in[- ]?house') THEN 'In-house' ELSE low END""")
_answers("n09_map_dev_type", RESOURCING, N.map_dev_type, """CASE WHEN contains(low, 'contract') THEN 'contract'
  WHEN regexp_matches(low, 'in-house|in house') THEN 'in-house' END""")
_answers("n10_normalize_pii", ["Yes", "y", "TRUE", "no", "N", "False ", "N/A", "maybe", "", None],
         N.normalize_pii, """CASE WHEN low IN ('yes', 'y', 'true') THEN 'Yes'
  WHEN low IN ('no', 'n', 'false') THEN 'No' ELSE 'Unknown' END""")
_answers("n11_normalize_demographics", ["None", "N/A", "Age; Sex", " ", None, "na", "Not Applicable", "Race"],
         N.normalize_demographics, """CASE WHEN s IS NULL OR low IN ('', 'none', 'n/a', 'na', 'not applicable',
  'no demographic variables') THEN 'No' ELSE 'Yes' END""")
AREAS = ["Law & Justice", "Mission-Enabling ", "Other; Mission-Enabling (internal agency support)",
         "NLP;Classification", "Unlisted", None, " transportation ; other", "Deep Learning"]
_answers("n12_clean_topic_area", AREAS, N.clean_topic_area, """coalesce(CASE trim(split_part(low, ';', 1))
  WHEN 'law & justice' THEN 'Law & Justice' WHEN 'mission-enabling' THEN 'Mission-Enabling'
  WHEN 'nlp' THEN 'Natural Language Processing' WHEN 'transportation' THEN 'Transportation'
  WHEN 'deep learning' THEN 'Deep Learning' END, 'Other')""")
_answers("n13_simplify_ato", ["Yes", "Operated in an approved enclave", "Data.State-SBU", "No", "Not Applicable",
                              "Unknown", None, "pending", " No - later"], N.simplify_ato, """CASE
  WHEN answer IS NULL OR answer = 'Unknown' THEN 'Unknown'
  WHEN s IN ('Yes', 'Operated in an approved enclave', 'Data.State-SBU') THEN 'Yes'
  WHEN starts_with(s, 'No') THEN 'No' ELSE 'Other' END""")
_answers("n14_simplify_independent_eval", [
    "Yes", "True", "Planned or in-progress", "AI is not safety or rights-impacting.", "Does not apply",
    "CAIO has waived this minimum practice", "Not Applicable", "Unknown", None, "TBD"],
    N.simplify_independent_eval, """CASE WHEN answer IS NULL OR answer = 'Unknown' THEN 'Unknown'
  WHEN s IN ('Yes', 'True') THEN 'Yes' WHEN s = 'Planned or in-progress' THEN 'Planned'
  WHEN contains(low, 'not safety or rights-impacting') OR contains(low, 'does not apply') THEN 'Not applicable'
  WHEN contains(s, 'waived this minimum practice') THEN 'Waived' WHEN s = 'Not Applicable' THEN 'Not applicable'
  ELSE s END""")
_answers("n15_simplify_operational_testing", [
    "No testing: none", "Benchmark evaluation: lab", "Performance evaluation in operational environment: done", "Yes",
    "Impact evaluation in operational environment: done", "was waived this minimum practice", "Not Applicable",
    "Unknown", None, "else"], N.simplify_operational_testing, """CASE
  WHEN answer IS NULL OR answer = 'Unknown' THEN 'Unknown' WHEN s = 'Not Applicable' THEN 'Not applicable'
  WHEN s LIKE 'No testing%' THEN 'None' WHEN s LIKE 'Benchmark evaluation%' THEN 'Benchmark only'
  WHEN s LIKE 'Performance evaluation in operational environment%' OR s = 'Yes' THEN 'Operational test'
  WHEN s LIKE 'Impact evaluation in operational environment%' THEN 'Impact evaluation'
  WHEN s LIKE '%waived this minimum practice%' THEN 'Waived' ELSE 'Other' END""")
_answers("n16_simplify_monitoring", [
    "No monitoring protocols have been established", "No monitoring protocols yet",
    "Intermittent and Manually Updated: x", "Automated and Regularly Scheduled Updates: x",
    "Established Process of Machine Learning Operations: x", "AI is not safety or rights-impacting",
    "Not Applicable", "Unknown", None, "else"], N.simplify_monitoring, """CASE
  WHEN answer IS NULL OR answer = 'Unknown' THEN 'Unknown'
  WHEN s = 'Not Applicable' OR contains(low, 'not safety or rights-impacting') THEN 'Not applicable'
  WHEN s LIKE 'No monitoring protocols%' THEN 'None' WHEN s LIKE 'Intermittent and Manually Updated%' THEN 'Manual'
  WHEN s LIKE 'Automated and Regularly Scheduled Updates%' THEN 'Automated'
  WHEN s LIKE 'Established Process of Machine Learning Operations%' THEN 'MLOps' ELSE 'Other' END""")
FIXES = {"Not Applicable": "Not applicable", "N/A": "Not applicable", "Na": "Unknown"}
_TITLE = ("list_aggregate(list_transform(regexp_extract_all(low, '[a-z]+|[^a-z]+'), "
          "lambda p: upper(p[1]) || p[2:]), 'string_agg', '')")
_answers("n17_title_unknown", ["yes", "n/a", "NA", "not applicable", "data.state-sbu", " MIXED case ", "", "nan", None],
         lambda c: N.title_unknown(c, FIXES), f"""CASE WHEN s IS NULL OR low IN ('', 'nan', 'na') THEN 'Unknown'
  WHEN low IN ('n/a', 'not applicable') THEN 'Not applicable' ELSE {_TITLE} END""")


PRIORITY_FIX = {"4-NOT SPECIFIED": "Unknown", "5-LOW": "Low"}


@query("n08_recode", """SELECT o_orderkey, CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'Unknown'
  WHEN '5-LOW' THEN 'Low' ELSE o_orderpriority END AS priority FROM orders""")
def n08(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", N.recode(F.col("o_orderpriority"), PRIORITY_FIX).alias("priority"))


@query("n18_status_flag", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'Retired' ELSE 'Active' END
  AS status FROM orders""")
def n18(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", N.status_flag(F.col("o_orderstatus"), "F").alias("status"))


@query("n19_contains_flag", """SELECT doc_id, coalesce(contains(lower(text), 'there'), false) AS has_word,
  source = 'src1' AS is_src1 FROM documents""")
def n19(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", N.contains_flag(F.col("text"), "There").alias("has_word"),
        N.equals_flag(F.col("source"), "src1").alias("is_src1"))


_SHORT_SQL = r"""SELECT {id}, CASE WHEN length({c}) <= 30 THEN {c} WHEN k = 0 THEN {c}[1:27] || '...'
  ELSE array_to_string(w[1:k], ' ') || '...' END AS label FROM (SELECT *, CASE WHEN length(w[1]) > 30 THEN 0
  ELSE greatest(1, len(list_filter(range(1, len(w) + 1), lambda i:
    list_sum(list_transform(w[1:i], lambda x: length(x) + 1)) <= 30))) END AS k FROM
  (SELECT {id}, {c}, regexp_split_to_array(regexp_replace({c}, '^\s+|\s+$', '', 'g'), '\s+')[1:31] AS w FROM {t}))"""


@query("n20_short_label", _SHORT_SQL.format(id="doc_id", c="text", t="documents"))
def n20(spark, sf):
    return table(spark, sf, "documents").select("doc_id", N.short_label(F.col("text")).alias("label"))


@query("n21_nice_title", f"""SELECT p_partkey, array_to_string(list_transform(string_split(p_name, ' '), lambda w:
  CASE WHEN upper(w) IN ('RING', 'AI') THEN upper(w) ELSE upper(w[1]) || lower(w[2:]) END), ' ') AS title FROM part""")
def n21(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", N.nice_title(F.col("p_name"), ["AI", "RING"]).alias("title"))


@query("n22_snippet", "SELECT doc_id, replace(substr(text, 1, 180), chr(10), ' ') AS snippet FROM documents")
def n22(spark, sf):
    return table(spark, sf, "documents").select("doc_id", N.snippet(F.col("text"), 180).alias("snippet"))


# --- dates ----------------------------------------------------------------------
_RAW_DATE_SQL = """(SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'TBD' WHEN 1 THEN
  strftime(o_orderdate, '%m/%d/%Y') WHEN 2 THEN ' ' || month(o_orderdate) || '/' || day(o_orderdate) || '/'
  || year(o_orderdate) WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '' END AS raw, o_orderdate FROM orders)"""


def _raw_dates(spark, sf):
    d = F.col("o_orderdate")
    k = F.col("o_orderkey") % 5
    raw = (F.when(k == 0, "TBD").when(k == 1, F.date_format(d, "MM/dd/yyyy"))
           .when(k == 2, F.concat(F.lit(" "), F.month(d), F.lit("/"), F.dayofmonth(d), F.lit("/"), F.year(d)))
           .when(k == 3, F.date_format(d, "yyyy-MM-dd")).otherwise(""))
    return table(spark, sf, "orders").select("o_orderkey", raw.alias("raw"))


@query("d01_parse_us_date", f"""SELECT o_orderkey, raw, CASE WHEN o_orderkey % 5 IN (1, 2)
  THEN CAST(o_orderdate AS DATE) END AS parsed FROM {_RAW_DATE_SQL}""")
def d01(spark, sf):
    return _raw_dates(spark, sf).withColumn("parsed", D.parse_us_date(F.col("raw")))


@query("d02_created_date", f"""SELECT l.o_orderkey, coalesce(CASE WHEN r.o_orderkey % 5 IN (1, 2) THEN
  CAST(r.o_orderdate AS DATE) + 30 END, retired, created) AS created_date FROM {LIFECYCLE_SQL} l
  JOIN {_RAW_DATE_SQL} r ON l.o_orderkey = r.o_orderkey""")
def d02(spark, sf):
    j = lifecycle(spark, sf).join(_raw_dates(spark, sf), "o_orderkey")
    impl = F.date_add(D.parse_us_date(F.col("raw")), 30)
    return j.select("o_orderkey", D.created_date(impl, F.col("retired"), F.col("created")).alias("created_date"))


@query("d03_year_and_retired_flag", f"""SELECT o_orderkey, year(CASE WHEN o_orderkey % 5 IN (1, 2) THEN o_orderdate END)
  AS year, o_orderkey % 5 IN (1, 2) AS retired_parsed, raw IS NOT NULL AS retired_raw FROM {_RAW_DATE_SQL}""")
def d03(spark, sf):
    return _raw_dates(spark, sf).select(
        "o_orderkey", F.year(D.parse_us_date(F.col("raw"))).cast("long").alias("year"),
        D.retired_flag(F.col("raw")).alias("retired_parsed"),
        D.retired_flag(F.col("raw"), parsed=False).alias("retired_raw"))


_DAYS_SQL = f"""(SELECT o_orderkey, date_diff('day', created, retired) AS days FROM {LIFECYCLE_SQL}
  WHERE retired IS NOT NULL AND created IS NOT NULL)"""


@query("d04_lifecycle_days", f"SELECT o_orderkey, days, greatest(0, days) AS clipped FROM {_DAYS_SQL}")
def d04(spark, sf):
    return A.lifecycle(lifecycle(spark, sf), "o_orderkey").withColumn(
        "days", F.col("days").cast("long")).withColumn("clipped", F.greatest(F.lit(0).cast("long"), "days"))


@query("d04_lifecycle_summary", f"""SELECT count(days) AS count, round(avg(days), 6) AS mean,
  round(stddev_samp(days), 6) AS std, CAST(min(days) AS DOUBLE) AS min, quantile_cont(days, 0.25) AS p25,
  quantile_cont(days, 0.5) AS p50, quantile_cont(days, 0.75) AS p75, CAST(max(days) AS DOUBLE) AS max
  FROM {_DAYS_SQL}""")
def d04b(spark, sf):
    from ..operators.profile import describe, rounded
    return rounded(describe(A.lifecycle(lifecycle(spark, sf), "o_orderkey"), "days"), 6, "mean", "std")


@query("d05_lifecycle_histogram", f"""WITH v AS (SELECT greatest(0, days) AS v FROM {_DAYS_SQL}),
  s AS (SELECT min(v) AS lo, max(v) AS hi, greatest(10, CAST(floor(sqrt(count(*))) AS BIGINT)) AS bins FROM v)
  SELECT b AS bin, count(*) AS n FROM (SELECT CAST(least(bins - 1, floor((v - lo) / ((hi - lo) / bins))) AS BIGINT)
  AS b FROM v, s) GROUP BY 1""")
def d05(spark, sf):
    days = A.lifecycle(lifecycle(spark, sf), "o_orderkey").select(F.greatest(F.lit(0), "days").alias("v"))
    return A.histogram(days, "v")


# --- bands -----------------------------------------------------------------------
_SCORE = "CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN p_partkey % 9 = 1 THEN p_size / 50.0 ELSE p_size * 2.0 END"


def _scores(spark, sf):
    k, s = F.col("p_partkey") % 9, F.col("p_size")
    return table(spark, sf, "part").select(
        "p_partkey", F.when(k == 0, F.lit(None).cast("double")).when(k == 1, s / F.lit(50.0)).otherwise(s * 2.0)
        .alias("score"))


@query("q05_complexity_band", f"""SELECT p_partkey, CASE WHEN s IS NULL THEN 'No model score available.'
  WHEN p < 40 THEN 'Low' WHEN p < 70 THEN 'Medium' ELSE 'High' END AS band FROM (SELECT p_partkey, s,
  CASE WHEN s <= 1 THEN s * 100 ELSE s END AS p FROM (SELECT p_partkey, {_SCORE} AS s FROM part))""")
def q05(spark, sf):
    return _scores(spark, sf).select("p_partkey", scoring.complexity_band(F.col("score")).alias("band"))


@query("q06_proposal_band", f"""SELECT p_partkey, CASE WHEN s IS NULL THEN 'Insufficient Inputs'
  WHEN s >= 66 THEN 'High Complexity' WHEN s >= 40 THEN 'Medium Complexity' ELSE 'Low Complexity' END AS band
  FROM (SELECT p_partkey, {_SCORE} AS s FROM part)""")
def q06(spark, sf):
    return _scores(spark, sf).select("p_partkey", scoring.proposal_band(F.col("score")).alias("band"))
