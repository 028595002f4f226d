"""Operators that fit a model."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as X
from ..operators import clusters as CL
from ..operators import density as D
from ..operators import lda as L
from ..operators import topics as T
from ..operators import windows as W
from ..operators.profile import rounded
from ..operators.textfeatures import term_counts
from ..session import cut_lineage, written
from ..sources import tables as S
from .basics import _scratch
from .registry import gamma, narratives, query, table
from .texts import words_sql

TOPICS = 40
K_GRID = [15, 20, 25, 30, 35, 40]
_FITTED: dict = {}


def fitted(spark, sf):
    """One fit per session and data folder, shared by the queries below."""
    at = (spark.sparkContext.applicationId, sf)
    if at not in _FITTED:
        stop = list(K.ENGLISH_STOP) + K.DOMAIN_STOP
        # Vocabulary, fit, assignments and names read the tokens again and again; the texts are cut once.
        d = written(narratives(spark, sf).select("doc_id", "text", X.simple_tokens(F.col("text"), stop).alias("tokens")))
        cv, bow = L.bag_of_words(d, "doc_id", "tokens", 5, 0.9)
        _FITTED[at] = (cv, bow, L.fit_lda(bow, "doc_id", TOPICS, passes=6))
    return _FITTED[at]


@query("t01_embed_documents")
def t01(spark, sf):
    e = CL.embed_documents(narratives(spark, sf).select("doc_id", "text"))
    return e.select("doc_id", F.posexplode("embedding").alias("pos", "value"))


DENSITY = {"eps": 0.65, "min_samples": 4, "min_cluster": 8}


@query("t02_density_topics", f"""WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
  edge AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a, v b WHERE list_cosine_similarity(a.e, b.e) >= {1 - DENSITY['eps']}),
  core AS (SELECT a AS id FROM edge GROUP BY 1 HAVING count(*) >= {DENSITY['min_samples']}),
  link AS (SELECT a, b FROM edge WHERE a IN (SELECT id FROM core) AND b IN (SELECT id FROM core)),
  reach AS (SELECT id, id AS other FROM core UNION SELECT r.id, l.b FROM reach r JOIN link l ON r.other = l.a),
  comp AS (SELECT id, min(other) AS c FROM reach GROUP BY 1),
  lab AS (SELECT e.b AS vec_id, min(c) AS topic FROM edge e JOIN comp ON e.a = comp.id GROUP BY 1),
  big AS (SELECT topic FROM lab GROUP BY 1 HAVING count(*) >= {DENSITY['min_cluster']})
  SELECT v.vec_id, CASE WHEN lab.topic IN (SELECT topic FROM big) THEN lab.topic ELSE -1 END AS topic
  FROM v LEFT JOIN lab ON v.vec_id = lab.vec_id""")
def t02(spark, sf):
    return D.density_topics(table(spark, sf, "embeddings"), "vec_id", "embedding", **DENSITY)


SWEEP = {"eps": [0.5, 0.55, 0.6, 0.65], "min_samples": [2, 3, 4, 5], "min_cluster": [8, 10]}
_eps, _least, _most = ("unnest([" + ", ".join(map(str, SWEEP[k])) + "])" for k in ("eps", "min_samples", "min_cluster"))
_TERMS = f"(SELECT doc_id AS vec_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({words_sql(stop=True)}) AS term FROM documents) GROUP BY 1, 2)"


@query("t13_density_sweep", f"""WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
  pair AS (SELECT a.vec_id AS a, b.vec_id AS b, list_cosine_similarity(a.e, b.e) AS c FROM v a, v b),
  edge AS (SELECT eps, a, b FROM pair, (SELECT {_eps} AS eps) WHERE c >= 1 - CAST(eps AS DOUBLE)),
  core AS (SELECT eps, least, a AS id FROM (SELECT eps, a, count(*) AS n FROM edge GROUP BY ALL), (SELECT {_least} AS least) WHERE n >= least),
  link AS (SELECT e.eps, x.least, a, b FROM edge e JOIN core x ON x.eps = e.eps AND x.id = a
    JOIN core y ON y.eps = e.eps AND y.id = b AND y.least = x.least WHERE a <> b),
  reach AS (SELECT eps, least, id, id AS other FROM core
    UNION SELECT r.eps, r.least, r.id, l.b FROM reach r JOIN link l ON r.eps = l.eps AND r.least = l.least AND r.other = l.a),
  comp AS (SELECT eps, least, id, min(other) AS c FROM reach GROUP BY ALL),
  lab AS (SELECT e.eps, least, e.b AS vec_id, min(c) AS topic FROM edge e JOIN comp ON e.a = comp.id AND e.eps = comp.eps GROUP BY ALL),
  size AS (SELECT eps, least, topic, count(*) AS n FROM lab GROUP BY ALL),
  big AS (SELECT size.*, most FROM size, (SELECT {_most} AS most) WHERE n >= most),
  health AS (SELECT eps, least, most, count(*) AS n_topics, sum(n) AS covered, count(*) FILTER (n < 6) AS tiny FROM big GROUP BY ALL),
  tf AS (SELECT eps, least, topic, term, sum(tf) AS tf FROM lab JOIN {_TERMS} USING (vec_id) GROUP BY ALL),
  kept AS (SELECT tf.*, most FROM tf JOIN big USING (eps, least, topic)),
  score AS (SELECT *, round(tf * ln(1 + sum(tf) OVER s / (SELECT count(DISTINCT topic) FROM kept k WHERE k.eps = kept.eps AND
    k.least = kept.least AND k.most = kept.most) / sum(tf) OVER t), 9) AS w FROM kept
    WINDOW s AS (PARTITION BY eps, least, most), t AS (PARTITION BY eps, least, most, term)),
  best AS (SELECT * FROM score QUALIFY row_number() OVER (PARTITION BY eps, least, most, topic ORDER BY w DESC, term) <= 10),
  div AS (SELECT eps, least, most, count(DISTINCT term) / (count(DISTINCT topic) * 10) AS d FROM best GROUP BY ALL),
  grid AS (SELECT eps, least, most FROM (SELECT {_eps} AS eps), (SELECT {_least} AS least), (SELECT {_most} AS most))
  SELECT CAST(eps AS DOUBLE) AS eps, least AS min_samples, most AS min_cluster, coalesce(n_topics, 0) AS n_topics,
    round(1 - coalesce(covered, 0) / (SELECT count(*) FROM v), 6) AS outlier_rate,
    round(coalesce(tiny / n_topics, 1.0), 6) AS tiny_topic_share, round(d, 6) AS diversity
  FROM grid LEFT JOIN health USING (eps, least, most) LEFT JOIN div USING (eps, least, most)""")
def t13_density(spark, sf):
    """32 settings from one graph; words of the document with the vector's id."""
    words = term_counts(table(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), "text"), ["vec_id"],
                        X.word_tokens(F.col("text"), K.ENGLISH_STOP))
    out = D.density_sweep(table(spark, sf, "embeddings"), "vec_id", "embedding", tokens=words, **SWEEP)
    return rounded(out, 6, "outlier_rate", "tiny_topic_share", "diversity")


@query("t13_k_sweep")
def t13(spark, sf):
    """Numbers of topics; words of the document with the vector's id."""
    words = table(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    v = table(spark, sf, "embeddings").select("vec_id", "embedding").join(words, "vec_id", "left")
    return CL.k_sweep(v, "embedding", K_GRID, tokens=X.word_tokens(F.col("text"), K.ENGLISH_STOP))


@query("t17_fit_lda")
def t17(spark, sf):
    cv, _, model = fitted(spark, sf)
    w = L.topic_words(model, cv.vocabulary, 10)
    return w.select("topic", F.posexplode(F.arrays_zip("words", "weights")).alias("rank", "z")).select(
        "topic", "rank", F.col("z.words").alias("term"), F.round("z.weights", 6).alias("weight"))


@query("t18_doc_topics")
def t18(spark, sf):
    _, bow, model = fitted(spark, sf)
    return L.doc_topics(model, bow, "doc_id").select(
        "doc_id", "lda_topic", F.round("lda_topic_prob", 4).alias("lda_topic_prob"), "lda_topic_name")


@query("t19_topic_terms")
def t19(spark, sf):
    cv, bow, model = fitted(spark, sf)
    return L.topic_terms(L.doc_topics(model, bow, "doc_id"), L.topic_words(model, cv.vocabulary, 15))


@query("t20_lda_grid")
def t20(spark, sf):
    cv, bow, _ = fitted(spark, sf)
    return L.lda_grid(bow, "doc_id", "tokens", cv.vocabulary, K_GRID)


@query("t24_log_perplexity")
def t24(spark, sf):
    _, bow, model = fitted(spark, sf)
    return bow.agg(F.count(F.lit(1)).alias("docs"), F.round(F.lit(L.log_perplexity(model, bow)), 6).alias("log_perplexity"))


@query("t31_topic_summary")
def t31(spark, sf):
    cv, bow, model = fitted(spark, sf)
    a = cut_lineage(L.doc_topics(model, bow, "doc_id").select("doc_id", "gamma", "lda_topic"))     # read three times
    words = L.topic_words(model, cv.vocabulary, 15)
    sizes = a.groupBy(F.col("lda_topic").alias("topic")).agg(F.count(F.lit(1)).alias("count"))
    docs = a.select("doc_id", "gamma", F.col("lda_topic").alias("topic")).join(bow.select("doc_id", "text", "tokens"), "doc_id")
    reps = T.representative_by_prob(docs.drop("topic"), "doc_id", "gamma", "text", 2, 280)
    names = T.phrase_names(docs, "doc_id", "topic", "tokens", words).filter("rank = 1").select(
        "topic", F.col("phrase").alias("topic_name"))
    return T.topic_summary(sizes, words, reps, names)


@query("t35_project_2d")
def t35(spark, sf):
    return rounded(L.project_2d(gamma(spark, sf), "vec_id", "gamma"), 6, "x", "y")


@query("t36_topic_features")
def t36(spark, sf):
    _, bow, model = fitted(spark, sf)
    return L.topic_features(L.doc_topics(model, bow, "doc_id"), "doc_id", TOPICS)


@query("s05_save_and_load_model")
def s05(spark, sf):
    """Assignments from the reloaded model, next to the original ones."""
    cv, bow, model = fitted(spark, sf)
    path = _scratch(spark, "model")
    S.save_model(PipelineModel([cv, model]), path)
    again = S.load_model(path)
    a = L.doc_topics(model, bow, "doc_id").select("doc_id", "lda_topic")
    b = L.doc_topics(again.stages[1], again.stages[0].transform(bow.drop("features")), "doc_id").select(
        "doc_id", F.col("lda_topic").alias("reloaded_topic"))
    return a.join(b, "doc_id").withColumn("same", F.col("lda_topic") == F.col("reloaded_topic"))
