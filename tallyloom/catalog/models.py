"""M1-M16."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import scoring
from ..functions import text as X
from ..functions.cleaning import impact_code, lookup
from ..operators import metrics as E
from ..operators import models as M
from ..operators import similar as Z
from ..operators import windows as W
from ..operators.profile import rounded
from ..session import cut_lineage
from .basics import _scratch
from .registry import IMPACT_SQL, impact, narratives, query, table
from .texts import AREA_BY_LANG, TFIDF_SQL, ngrams_sql, words_sql


@query("m01_stratified_split", """SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5(CAST(doc_id AS VARCHAR)),
  doc_id) <= round(count(*) OVER (PARTITION BY quality) * 0.25) AS is_test FROM labels""")
def m01(spark, sf):
    return E.stratified_split(table(spark, sf, "labels").select("doc_id", "quality"), "quality", "doc_id")


@query("m02_class_weights", """SELECT quality, n, round(sum(n) OVER () / (count(*) OVER () * n), 8) AS weight FROM
  (SELECT quality, count(*) AS n FROM labels GROUP BY 1)""")
def m02(spark, sf):
    return rounded(E.class_weights(table(spark, sf, "labels"), "quality"), 8, "weight")


_MODELS: dict = {}


def _texts(spark, sf):
    d = impact(spark, sf, "text")
    return d.withColumn("row_text", X.row_to_text([F.col("lang"), F.col("text"), F.col("source")])).withColumn(
        "impact_class", impact_code(F.col("impact")))


TOPIC_COLS = [f"topic_{i:02d}" for i in range(40)]


def _topic_features(df, topic_id):
    """A real one-hot of the topic id; an unknown topic is all zeros."""
    return df.select("*", *[F.coalesce((topic_id == i).cast("double"), F.lit(0.0)).alias(c)
                            for i, c in enumerate(TOPIC_COLS)])


def fitted(spark, sf, which: str):
    """One of the three models, fitted once per session and data folder on training rows."""
    at = (spark.sparkContext.applicationId, sf, which)
    if at in _MODELS:
        return _MODELS[at]
    if which == "complexity":
        # Median, labels and split read the scores again and again; the texts are searched once.
        scored = cut_lineage(narratives(spark, sf).select("doc_id", scoring.complexity_score(
            F.col("doc_id") % 40, F.col("text"), lookup(F.col("lang"), AREA_BY_LANG)).alias("score")))
        rows = _topic_features(M.above_median(scored, "score"), F.col("doc_id") % 40)
        train = E.stratified_split(rows, "label", "doc_id").filter(~F.col("is_test"))
        _MODELS[at] = M.fit_numeric_classifier(train, TOPIC_COLS, "label")
        return _MODELS[at]
    src = _texts(spark, sf).filter("impact_class IS NOT NULL")
    src = src.withColumn("quality", F.col("impact").isin("Both", "Rights-impacting").cast("int"))
    train = E.stratified_split(src, "impact_class", "doc_id").filter(~F.col("is_test"))
    label, binary = ("impact_class", False) if which == "impact" else ("quality", True)
    other = _MODELS.get((*at[:2], "resourcing" if which == "impact" else "impact"))     # both labels are of the same rows
    _MODELS[at] = M.fit_text_classifier(train, "row_text", label, binary=binary, same_rows=other)
    return _MODELS[at]


def _predicted(spark, sf):
    m1 = fitted(spark, sf, "impact")
    src = _texts(spark, sf).filter("impact_class IS NOT NULL")
    test = E.stratified_split(src, "impact_class", "doc_id").filter("is_test")
    return M.predict(m1, test.select("doc_id", "source", "impact", "impact_class", "row_text").withColumnRenamed(
        "impact_class", "actual"), "row_text", "impact").drop("row_text")


@query("m03_impact_classifier")
def m03(spark, sf):
    p = _predicted(spark, sf)
    return p.select("doc_id", "actual", "impact_class", F.round("impact_confidence", 4).alias("confidence"))


@query("m04_resourcing_classifier")
def m04(spark, sf):
    m3 = fitted(spark, sf, "resourcing")
    p = M.predict(m3, _texts(spark, sf).select("doc_id", "row_text"), "row_text", "resourcing")
    return p.select("doc_id", "resourcing_class", F.round("resourcing_confidence", 4).alias("confidence"))


LINE_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_returnflag"]


def lines(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
                                             "l_returnflag", "l_extendedprice")
    return M.numeric_features(M.above_median(li, "l_extendedprice"), LINE_FEATURES)


@query("m05_complexity_label", """SELECT l_returnflag, count(*) AS n, count(*) FILTER (l_extendedprice > (SELECT median(l_extendedprice)
  FROM lineitem)) AS above FROM lineitem GROUP BY 1""")
def m05a(spark, sf):
    li = M.above_median(table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice"), "l_extendedprice")
    return li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("above"))


@query("m05_complexity_classifier")
def m05(spark, sf):
    """Scaled and fitted on three quarters of the rows, measured on the rest."""
    src = lines(spark, sf).withColumn("key", F.concat_ws("-", "l_orderkey", F.col("l_linenumber").cast("int")))
    split = E.stratified_split(src, "label", "key")
    model = M.fit_numeric_classifier(split.filter(~F.col("is_test")), LINE_FEATURES, "label")
    p = M.predict(model, split.filter("is_test"), None, "complexity")
    return E.confusion_matrix(p, "label", "complexity_class", [0, 1])


@query("m06_predict_all")
def m06(spark, sf):
    m1 = fitted(spark, sf, "impact")
    p = M.predict(m1, _texts(spark, sf).select("doc_id", "row_text"), "row_text", "impact")
    return p.groupBy("impact_class").agg(F.count(F.lit(1)).alias("docs"), F.round(F.avg("impact_confidence"), 4).alias("confidence"))


@query("m07_accuracy", "SELECT round(avg(CASE WHEN quality = toxic THEN 1 ELSE 0 END), 8) AS accuracy, count(*) AS n FROM labels")
def m07(spark, sf):
    return rounded(E.accuracy(table(spark, sf, "labels"), "quality", "toxic"), 8, "accuracy")


_CONF = """(SELECT CAST(a AS INTEGER) AS actual, CAST(p AS INTEGER) AS predicted, (SELECT count(*) FROM labels WHERE quality = a
  AND toxic = p) AS n FROM range(0, 3) x(a), range(0, 3) y(p))"""


@query("m07_confusion_matrix", f"SELECT * FROM {_CONF}")
def m07b(spark, sf):
    return E.confusion_matrix(table(spark, sf, "labels"), "quality", "toxic", [0, 1, 2])


@query("m08_classification_report", f"""WITH c AS {_CONF}, per AS (SELECT k, coalesce(tp / nullif(guessed, 0), 0) AS p,
  coalesce(tp / nullif(support, 0), 0) AS r, support FROM (SELECT k, (SELECT sum(n) FROM c WHERE actual = k) AS support,
  (SELECT sum(n) FROM c WHERE predicted = k) AS guessed, (SELECT sum(n) FROM c WHERE actual = k AND predicted = k) AS tp
  FROM range(0, 3) t(k))), f AS (SELECT CAST(k AS VARCHAR) AS label, p, r, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f1,
  support FROM per), u AS (SELECT * FROM f UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f1), sum(support) FROM f
  UNION ALL SELECT 'weighted avg', sum(p * support) / sum(support), sum(r * support) / sum(support),
  sum(f1 * support) / sum(support), sum(support) FROM f)
  SELECT label, round(p, 8) AS precision, round(r, 8) AS recall, round(f1, 8) AS f1, CAST(support AS BIGINT) AS support FROM u""")
def m08(spark, sf):
    return rounded(E.classification_report(m07b(spark, sf)), 8, "precision", "recall", "f1")


_SCORED = """(SELECT n_chars AS score, quality = 1 AS y FROM documents JOIN labels ON documents.doc_id = labels.doc_id)"""
_RUN = f"""(SELECT score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM
  (SELECT score, count(*) FILTER (y) AS pos, count(*) FILTER (NOT y) AS neg FROM {_SCORED} GROUP BY 1) WINDOW w AS (ORDER BY score DESC))"""


def _scored(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "n_chars").join(table(spark, sf, "labels"), "doc_id")


@query("m09_roc_curve", f"SELECT score, round(fp / n, 8) AS fpr, round(tp / p, 8) AS tpr FROM {_RUN}")
def m09(spark, sf):
    return rounded(E.roc_curve(_scored(spark, sf), F.col("quality") == 1, "n_chars"), 8, "fpr", "tpr")


@query("m09_roc_auc", f"SELECT round(sum(neg * (2 * tp - pos) / 2.0) / any_value(p * n), 8) AS auc FROM {_RUN}")
def m09b(spark, sf):
    return rounded(E.roc_auc(_scored(spark, sf), F.col("quality") == 1, "n_chars"), 8, "auc")


@query("m10_pr_curve", f"SELECT score, round(tp / (tp + fp), 8) AS precision, round(tp / p, 8) AS recall FROM {_RUN}")
def m10(spark, sf):
    return rounded(E.pr_curve(_scored(spark, sf), F.col("quality") == 1, "n_chars"), 8, "precision", "recall")


@query("m10_average_precision", f"SELECT round(sum(pos / p * tp / (tp + fp)), 8) AS average_precision FROM {_RUN}")
def m10b(spark, sf):
    return rounded(E.average_precision(_scored(spark, sf), F.col("quality") == 1, "n_chars"), 8, "average_precision")


@query("m11_top_coefficients")
def m11(spark, sf):
    m1 = fitted(spark, sf, "impact")
    return rounded(M.top_coefficients(m1, spark, 20), 6, "coefficient")


@query("m12_probability_histogram")
def m12(spark, sf):
    m3 = fitted(spark, sf, "resourcing")
    src = _texts(spark, sf).filter("impact IS NOT NULL").select(
        "row_text", F.col("impact").isin("Both", "Rights-impacting").cast("int").alias("y"))
    p = M.predict(m3, src, "row_text", "r").select("y", F.get("r_probs", F.lit(1)).alias("p"))
    return E.probability_histogram(p, "p", "y", 30)


_PRED = """CASE WHEN lang = 'en' THEN 'Neither' WHEN lang = 'de' THEN 'Both' WHEN lang = 'fr' THEN 'Rights only' ELSE 'Safety only' END"""
PRED_BY_LANG = {"en": "Neither", "de": "Both", "fr": "Rights only", "es": "Safety only"}


def _flagged(spark, sf):
    return impact(spark, sf).withColumn("predicted", lookup(F.col("lang"), PRED_BY_LANG))


@query("m13_flag_mismatch", f"""SELECT doc_id, impact, coalesce(lower(trim(impact)) = 'neither' AND {_PRED} <> 'Neither', false)
  AS mismatch FROM {IMPACT_SQL}""")
def m13(spark, sf):
    return _flagged(spark, sf).select("doc_id", "impact", E.flag_mismatch(F.col("impact"), F.col("predicted")).alias("mismatch"))


@query("m14_flagged_by_bureau", f"""SELECT source, count(*) FILTER (impact = 'Neither' AND {_PRED} <> 'Neither') AS flagged
  FROM {IMPACT_SQL} WHERE impact IS NOT NULL GROUP BY 1""")
def m14(spark, sf):
    return E.flagged_by_bureau(_flagged(spark, sf), "source", "impact", "predicted")


_QUB = f"(SELECT item_id, list_concat(t, {ngrams_sql('t', 2)}) AS g FROM (SELECT item_id, {words_sql(stop=True)} AS t FROM benchmark))"


@query("m15_similar_cases", f"""WITH d AS MATERIALIZED (SELECT doc_id, term, weight FROM {TFIDF_SQL}), tf AS (SELECT doc_id, unnest(g) AS term FROM
  (SELECT doc_id, list_distinct(list_concat(t, {ngrams_sql('t', 2)})) AS g FROM (SELECT doc_id, {words_sql(stop=True)} AS t FROM documents))),
  v AS (SELECT term, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) + 1 AS idf FROM tf GROUP BY 1 HAVING count(*) >= 5
    AND count(*) <= 0.9 * (SELECT count(*) FROM documents)),
  q AS (SELECT item_id, term, count(*) * any_value(idf) AS w FROM (SELECT item_id, unnest(g) AS term FROM {_QUB}) JOIN v USING (term) GROUP BY 1, 2),
  qn AS (SELECT item_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY item_id)) AS w FROM q),
  s AS (SELECT item_id, doc_id, sum(weight * w) * 100 AS sim FROM d JOIN qn USING (term) GROUP BY 1, 2)
  SELECT item_id, doc_id, source, lang, round(sim, 4) AS similarity, rank FROM (SELECT *, row_number() OVER (PARTITION BY item_id
  ORDER BY round(sim, 7) DESC, doc_id) AS rank FROM s) JOIN documents USING (doc_id) WHERE rank <= 5""")
def m15(spark, sf):
    q = table(spark, sf, "benchmark").select("item_id", X.word_tokens(F.col("text"), K.ENGLISH_STOP).alias("t"))
    t = X.ngrams(F.col("t"), 1, 2)
    return rounded(Z.similar_cases(q, _cases(spark, sf), "item_id", "doc_id", t, t, 5, 5, 0.9, ["source", "lang"]), 4, "similarity")


def _cases(spark, sf):
    return narratives(spark, sf).select(
        "doc_id", "source", "lang", X.word_tokens(F.col("text"), K.ENGLISH_STOP).alias("t"))


def proposals(df):
    """User turns as proposals; every fifth one names no topic."""
    topic = F.when(F.col("conv_id") % 5 != 0, F.col("conv_id") % 40)
    p = df.filter("role = 'user'").select(
        "conv_id", "turn", X.row_to_text([F.col("text")], skip_blank=True).alias("proposal"), topic.alias("topic_id"))
    return _topic_features(p, F.col("topic_id"))


def score(spark, sf, df):
    m1, m2, m3 = (fitted(spark, sf, w) for w in ("impact", "complexity", "resourcing"))
    s = M.score_proposals(proposals(df), "proposal", m1, m3, m2, "topic_id")
    return rounded(s.drop("proposal", *TOPIC_COLS), 4, "impact_confidence", "complexity_confidence",
                   "resourcing_confidence", "novelty")


KEY = ["conv_id", "turn"]


def _asked(df):
    """Proposals with their words, under one key."""
    return proposals(df).select(F.struct(*KEY).alias("query"), X.word_tokens(F.col("proposal"), K.ENGLISH_STOP).alias("t"))


def found_cases(spark, path, df):
    return Z.similar_stored(spark, path, _asked(df), "query", X.ngrams(F.col("t"), 1, 2), 5)


def stored_cases(spark, sf) -> str:
    path = _scratch(spark, "cases")
    Z.store_index(_cases(spark, sf), "doc_id", X.ngrams(F.col("t"), 1, 2), path, ["source", "lang"], 5, 0.9)
    return path


def score_with_cases(spark, sf, path, df):
    return M.with_cases(score(spark, sf, df), KEY, Z.as_list(found_cases(spark, path, df), "query", "doc_id"))


def flat_cases(found):
    return rounded(found.select("query.*", "doc_id", "source", "lang", "similarity", "rank"), 4, "similarity")


@query("m16_score_proposals")
def m16(spark, sf):
    """Scores, and the five nearest cases with their attributes."""
    return score_with_cases(spark, sf, stored_cases(spark, sf), table(spark, sf, "conversations"))


_PROPOSALS = f"""(SELECT conv_id, turn, list_concat(t, {ngrams_sql('t', 2)}) AS g FROM
  (SELECT conv_id, turn, {words_sql(stop=True)} AS t FROM conversations WHERE role = 'user'))"""
CASES_SQL = f"""WITH d AS MATERIALIZED (SELECT doc_id, term, weight FROM {TFIDF_SQL}), tf AS (SELECT doc_id, unnest(g) AS term FROM
  (SELECT doc_id, list_distinct(list_concat(t, {ngrams_sql('t', 2)})) AS g FROM (SELECT doc_id, {words_sql(stop=True)} AS t FROM documents))),
  v AS (SELECT term, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) + 1 AS idf FROM tf GROUP BY 1 HAVING count(*) >= 5
    AND count(*) <= 0.9 * (SELECT count(*) FROM documents)),
  q AS (SELECT conv_id, turn, term, count(*) * any_value(idf) AS w FROM (SELECT conv_id, turn, unnest(g) AS term FROM {_PROPOSALS})
    JOIN v USING (term) GROUP BY 1, 2, 3),
  qn AS (SELECT conv_id, turn, term, w / sqrt(sum(w * w) OVER (PARTITION BY conv_id, turn)) AS w FROM q),
  s AS (SELECT conv_id, turn, doc_id, sum(weight * w) * 100 AS sim FROM d JOIN qn USING (term) GROUP BY 1, 2, 3)
  SELECT conv_id, turn, doc_id, source, lang, round(sim, 4) AS similarity, rank FROM (SELECT *, row_number() OVER (
  PARTITION BY conv_id, turn ORDER BY round(sim, 7) DESC, doc_id) AS rank FROM s) JOIN documents USING (doc_id) WHERE rank <= 5"""


@query("m16_similar_cases", CASES_SQL)
def m16_cases(spark, sf):
    return flat_cases(found_cases(spark, stored_cases(spark, sf), table(spark, sf, "conversations")))


@query("m16_novelty", """SELECT l_orderkey, l_linenumber, l_partkey, round(100 - greatest(l_quantity, CASE WHEN l_tax > 0 THEN l_discount * 900 ELSE 0 END,
  l_extendedprice / 1200), 6) AS novelty FROM lineitem""")
def m16b(spark, sf):
    c = F.when(F.col("l_tax") > 0, F.col("l_discount") * 900)
    return rounded(table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        M.novelty(F.col("l_quantity"), c, F.col("l_extendedprice") / 1200).alias("novelty")), 6, "novelty")
