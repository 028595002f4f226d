"""T3-T16, T21-T23, T25-T34 on labels, terms and probabilities given as input."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as X
from ..functions import vectors as V
from ..operators import aggregates as A
from ..operators import coherence as C
from ..operators import lda as L
from ..operators import outliers as O
from ..operators import topics as T
from ..operators.profile import rounded
from .registry import GAMMA_SQL, IMPACT_SQL, NOISE_SQL, gamma, impact, narratives, query, sql_list, table, vectors_noise
from .texts import ngrams_sql, words_sql

LANGS = ["de", "en", "es", "fr"]


def _tokens(c="text"):
    return X.word_tokens(F.col(c), K.ENGLISH_STOP)


def _class_sql(topic):
    return f"""(WITH tf AS (SELECT {topic}, term, count(*) AS tf FROM (SELECT {topic}, unnest({words_sql(stop=True)}) AS term
  FROM documents) GROUP BY 1, 2), a AS (SELECT sum(tf) / count(DISTINCT {topic}) AS a FROM tf),
  f AS (SELECT term, sum(tf) AS f FROM tf GROUP BY 1) SELECT {topic}, term, tf, ln(1 + a / f) AS idf,
  tf * ln(1 + a / f) AS score FROM tf JOIN f USING (term), a)"""


def _top_sql(topic, n):
    return f"""(SELECT * FROM (SELECT {topic}, term, score, row_number() OVER (PARTITION BY {topic}
  ORDER BY round(score, 9) DESC, term) AS rank FROM {_class_sql(topic)}) WHERE rank <= {n})"""


def top_by(spark, sf, topic, n):
    tf = T.class_terms(narratives(spark, sf), topic, _tokens())
    return T.top_terms(T.ctfidf(tf, topic), topic, n)


@query("t03_ctfidf_terms", f"SELECT lang, term, round(score, 6) AS score, rank FROM {_top_sql('lang', 15)}")
def t03(spark, sf):
    return rounded(top_by(spark, sf, "lang", 15).select("lang", "term", "score", "rank"), 6, "score")


def _merge_sql(k: int, rounds: int) -> str:
    """Rounds written out one after another; those beyond the last change nothing."""
    out = [f"""tf AS MATERIALIZED (SELECT source AS topic, term, count(*) AS tf FROM (SELECT source, unnest({words_sql(stop=True)}) AS term
  FROM documents WHERE source IS NOT NULL) GROUP BY 1, 2),
  own0 AS (SELECT source AS topic, source AS owner, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY 1, 2)"""]
    for i in range(rounds):
        out.append(f"""live{i} AS (SELECT owner, sum(n) AS n, row_number() OVER (ORDER BY sum(n), owner) AS r, count(*) OVER () AS t FROM own{i} GROUP BY 1),
  set{i} AS (SELECT owner, n, r <= greatest(0, least(t - {k}, t // 2)) AS small FROM live{i}),
  w{i} AS (SELECT owner, term, sum(f.tf) AS tf FROM tf f JOIN own{i} USING (topic) GROUP BY 1, 2),
  s{i} AS (SELECT owner, term, tf * ln(1 + (SELECT sum(tf) / count(DISTINCT owner) FROM w{i}) / sum(tf) OVER (PARTITION BY term)) AS w FROM w{i}),
  u{i} AS MATERIALIZED (SELECT owner, term, small, w / sqrt(sum(w * w) OVER (PARTITION BY owner)) AS w FROM s{i} JOIN set{i} USING (owner)),
  best{i} AS (SELECT a.owner AS a, b.owner AS b FROM u{i} a JOIN u{i} b USING (term) WHERE a.small AND NOT b.small GROUP BY 1, 2
    QUALIFY row_number() OVER (PARTITION BY a.owner ORDER BY round(sum(a.w * b.w) * 100, 7) DESC, b.owner) = 1),
  own{i + 1} AS (SELECT topic, o.n, CASE WHEN NOT small THEN o.owner ELSE coalesce(b, (SELECT owner FROM set{i} ORDER BY n DESC, owner LIMIT 1))
    END AS owner FROM own{i} o JOIN set{i} x ON x.owner = o.owner LEFT JOIN best{i} ON a = o.owner)""")
    return "WITH " + ",\n  ".join(out) + f"""
  SELECT doc_id, source, coalesce(owner, source) AS topic_reduced FROM documents LEFT JOIN own{rounds} ON topic = source"""


@query("t04_reduce_topics", _merge_sql(4, 4))
def t04(spark, sf):
    d = narratives(spark, sf).select("doc_id", "source", "text")
    return T.reduce_topics(d, "source", _tokens(), 4).select("doc_id", "source", "topic_reduced")


_NOISY = """(SELECT doc_id, text, CASE WHEN lang = 'fr' THEN -1 ELSE CAST(substr(source, 4) AS INTEGER) END AS topic
  FROM documents)"""


def _noisy(spark, sf):
    return narratives(spark, sf).select(
        "doc_id", "text", F.when(F.col("lang") == "fr", -1).otherwise(F.substring("source", 4, 9).cast("int")).alias("topic"))


@query("t05_reduce_outliers_ctfidf", f"""WITH tf AS (SELECT topic, term, count(*) AS tf FROM (SELECT topic, unnest({words_sql(stop=True)})
  AS term FROM {_NOISY} WHERE topic >= 0) GROUP BY 1, 2), a AS (SELECT sum(tf) / count(DISTINCT topic) AS a FROM tf),
  f AS (SELECT term, ln(1 + (SELECT a FROM a) / sum(tf)) AS idf FROM tf GROUP BY 1),
  s AS (SELECT topic, term, tf * idf AS w FROM tf JOIN f USING (term)),
  len AS (SELECT topic, sqrt(sum(w * w)) AS l FROM s GROUP BY 1),
  d AS (SELECT doc_id, term, count(*) * any_value(idf) AS x FROM (SELECT doc_id, unnest({words_sql(stop=True)}) AS term
    FROM {_NOISY} WHERE topic < 0) JOIN f USING (term) GROUP BY 1, 2),
  dl AS (SELECT doc_id, sqrt(sum(x * x)) AS l FROM d GROUP BY 1),
  sim AS (SELECT doc_id, topic, round(dot / (len.l * dl.l), 9) AS sim FROM (SELECT doc_id, topic, sum(x * w) AS dot
    FROM d JOIN s USING (term) GROUP BY 1, 2) JOIN len USING (topic) JOIN dl USING (doc_id)),
  best AS (SELECT doc_id, topic AS b FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY sim DESC, topic) AS rn
    FROM sim) WHERE rn = 1 AND sim >= 0.2)
  SELECT n.doc_id, topic, coalesce(b, topic) AS topic_terms FROM {_NOISY} n LEFT JOIN best ON n.doc_id = best.doc_id""")
def t05(spark, sf):
    return O.reduce_outliers_ctfidf(_noisy(spark, sf), "doc_id", "topic", _tokens(), 0.2).drop("text")


IDS = [100 + i for i in range(64)]


@query("t06_rescue_by_prob", f"""SELECT g.vec_id, topic, CASE WHEN topic < 0 AND list_max(gamma) >= 0.06 THEN
  CAST(99 + list_position(gamma, list_max(gamma)) AS INTEGER) ELSE topic END AS topic_prob
  FROM {GAMMA_SQL} g JOIN {NOISE_SQL} n ON g.vec_id = n.vec_id""")
def t06(spark, sf):
    return O.rescue_by_prob(_gamma_noise(spark, sf), "topic", "gamma", IDS, 0.06).select("vec_id", "topic", "topic_prob")


def _gamma_noise(spark, sf):
    return vectors_noise(spark, sf).withColumn("gamma", V.to_probabilities(F.col("embedding")))


CENT_SQL = f"""(SELECT topic, list(m ORDER BY pos) AS centroid, any_value(n) AS n FROM (SELECT topic, pos,
  avg(CAST(embedding[pos] AS DOUBLE)) AS m, count(*) AS n FROM (SELECT topic, embedding, unnest(range(1, 65)) AS pos
  FROM {NOISE_SQL} WHERE topic >= 0) GROUP BY 1, 2) GROUP BY 1)"""


@query("t07_topic_centroids", f"""SELECT topic, n, CAST(i - 1 AS INTEGER) AS pos, round(centroid[i], 6) AS mean FROM
  (SELECT *, unnest(range(1, 65)) AS i FROM {CENT_SQL})""")
def t07(spark, sf):
    c = T.topic_centroids(vectors_noise(spark, sf), "topic", "embedding")
    return rounded(c.select("topic", "n", F.posexplode("centroid").alias("pos", "mean")), 6, "mean")


_SIM = "list_cosine_similarity(CAST(embedding AS DOUBLE[]), centroid)"
_NEAR_SQL = f"""(SELECT vec_id, b AS best, sim, n FROM (SELECT v.vec_id, c.topic AS b, c.n, {_SIM} AS sim, row_number() OVER
  (PARTITION BY vec_id ORDER BY {_SIM} DESC, c.topic) AS rn FROM {NOISE_SQL} v, {CENT_SQL} c WHERE v.topic < 0) WHERE rn = 1)"""


@query("t08_rescue_by_centroid", f"""SELECT v.vec_id, topic, CASE WHEN sim >= 0.30 THEN round(sim, 4) END AS sim,
  CASE WHEN sim >= 0.30 THEN best ELSE topic END AS topic_centroid FROM {NOISE_SQL} v LEFT JOIN {_NEAR_SQL} x
  ON v.vec_id = x.vec_id""")
def t08(spark, sf):
    r = O.rescue_by_centroid(vectors_noise(spark, sf), "vec_id", "topic", "embedding", 0.30)
    return rounded(r.drop("embedding"), 4, "sim")


_STRICT = "sim >= 0.40 AND n >= 40 AND list_max(gamma) >= 0.05"


@query("t08_rescue_strict", f"""SELECT v.vec_id, v.topic, CASE WHEN {_STRICT} THEN best ELSE v.topic END AS topic_strict
  FROM {NOISE_SQL} v JOIN {GAMMA_SQL} g ON v.vec_id = g.vec_id LEFT JOIN {_NEAR_SQL} x ON v.vec_id = x.vec_id""")
def t08b(spark, sf):
    v = _gamma_noise(spark, sf).withColumn("p_max", F.array_max("gamma")).drop("gamma")
    r = O.rescue_by_centroid(v, "vec_id", "topic", "embedding", 0.40, "topic_strict", "p_max", 0.05, 40)
    return r.select("vec_id", "topic", "topic_strict")


_RESCUED = f"""(SELECT v.vec_id, v.topic AS before, x.sim, list_max(gamma) AS p_max, CASE WHEN v.topic < 0 AND list_max(gamma) >= 0.09
  THEN CAST(list_position(gamma, list_max(gamma)) - 1 AS INTEGER) % 10 WHEN v.topic < 0 AND sim >= 0.30 THEN best ELSE v.topic END
  AS after FROM {NOISE_SQL} v JOIN {GAMMA_SQL} g ON v.vec_id = g.vec_id LEFT JOIN {_NEAR_SQL} x ON v.vec_id = x.vec_id)"""


def _rescued(spark, sf):
    """Probability step, then centroids of the rows labelled from the start."""
    v = _gamma_noise(spark, sf)
    r = O.rescue_by_prob(v, "topic", "gamma", [i % 10 for i in range(64)], 0.09)
    c = O.rescue_by_centroid(v.select("vec_id", "topic", "embedding"), "vec_id", "topic", "embedding", 0.30)
    j = r.join(c.select("vec_id", "topic_centroid", "sim"), "vec_id")
    j = j.withColumn("after", F.when(F.col("topic_prob") >= 0, F.col("topic_prob")).otherwise(F.col("topic_centroid")))
    return O.rescue_methods(j.withColumn("p_max", F.array_max("gamma")), "topic", "after", "p_max", 0.09)


_METHOD = "CASE WHEN NOT (before < 0 AND after >= 0) THEN 'none' WHEN p_max >= 0.09 THEN 'prob' ELSE 'centroid' END"


@query("t09_rescue_rates", f"""SELECT round(count(*) FILTER (before < 0) / count(*), 6) AS rate_before,
  round(count(*) FILTER (after < 0) / count(*), 6) AS rate_after, count(*) FILTER (m = 'prob') AS by_prob,
  count(*) FILTER (m = 'centroid') AS by_centroid FROM (SELECT *, {_METHOD} AS m FROM {_RESCUED})""")
def t09(spark, sf):
    return rounded(O.rescue_rates(_rescued(spark, sf), "topic", "after"), 6, "rate_before", "rate_after")


@query("t09_rescue_inflow", f"""SELECT after AS topic_id, m AS method, count(*) AS count FROM (SELECT *, {_METHOD} AS m FROM {_RESCUED})
  WHERE m <> 'none' GROUP BY 1, 2""")
def t09b(spark, sf):
    return O.rescue_inflow(_rescued(spark, sf), "after")


@query("t09_topic_sizes", f"""SELECT label AS topic_id, (SELECT count(*) FROM {_RESCUED} WHERE after = label) AS size,
  NOT EXISTS (SELECT 1 FROM {_RESCUED} WHERE after = label) AS empty FROM (SELECT DISTINCT label FROM embeddings)""")
def t09c(spark, sf):
    return O.topic_sizes(_rescued(spark, sf), "after", table(spark, sf, "embeddings").select("label").distinct())


@query("t09_similarity_percentiles", "SELECT " + ", ".join(
    f"round(quantile_cont(sim, {q}), 6) AS p{int(q * 100)}" for q in (0.1, 0.25, 0.5, 0.75, 0.9))
    + f" FROM {_NEAR_SQL}")
def t09d(spark, sf):
    v = vectors_noise(spark, sf)
    near = O.nearest_centroid(v.filter("topic < 0"), "vec_id", "embedding", T.topic_centroids(v, "topic", "embedding"), "topic")
    return rounded(O.similarity_percentiles(near, "sim"), 6, "p10", "p25", "p50", "p75", "p90")


_OWN = f"(SELECT v.vec_id, v.topic, {_SIM} AS score FROM {NOISE_SQL} v JOIN {CENT_SQL} c ON v.topic = c.topic)"


@query("t10_representative_docs", f"""SELECT vec_id, topic, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER
  (PARTITION BY topic ORDER BY round(score, 9) DESC, vec_id) AS rank FROM {_OWN}) WHERE rank <= 5""")
def t10(spark, sf):
    r = T.representative_docs(vectors_noise(spark, sf), "vec_id", "topic", "embedding", 5)
    return rounded(r.select("vec_id", "topic", "score", "rank"), 6, "score")


@query("t10_representative_by_prob", f"""SELECT CAST(t.topic AS INTEGER) AS topic, t.rank, t.vec_id AS doc_id, round(t.p, 4) AS score,
  replace(substr(d.text, 1, 300), chr(10), ' ') AS snippet FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY p DESC, vec_id)
  AS rank FROM (SELECT vec_id, i - 1 AS topic, gamma[i] AS p FROM (SELECT vec_id, gamma, unnest(range(1, 65)) AS i FROM {GAMMA_SQL})
  JOIN documents ON vec_id = doc_id)) t JOIN documents d ON t.vec_id = d.doc_id WHERE rank <= 5""")
def t10b(spark, sf):
    j = narratives(spark, sf).select("doc_id", "text").join(
        gamma(spark, sf).withColumnRenamed("vec_id", "doc_id"), "doc_id")
    return T.representative_by_prob(j, "doc_id", "gamma", "text", 5)


@query("t11_topic_diversity", f"""SELECT round(count(DISTINCT term) / (count(DISTINCT source) * 10), 8) AS diversity
  FROM {_top_sql('source', 10)}""")
def t11(spark, sf):
    return rounded(T.topic_diversity(top_by(spark, sf, "source", 10), "source", 10), 8, "diversity")


@query("t12_cohesion_separation", f"""SELECT (SELECT round(avg(s), 6) FROM (SELECT topic, avg(score) AS s FROM {_OWN} GROUP BY 1)) AS cohesion,
  (SELECT count(*) FROM {CENT_SQL}) AS topics, (SELECT round(1 - avg(list_cosine_similarity(a.centroid, b.centroid)), 6)
  FROM {CENT_SQL} a JOIN {CENT_SQL} b ON a.topic < b.topic) AS separation""")
def t12(spark, sf):
    return rounded(T.cohesion_separation(vectors_noise(spark, sf), "topic", "embedding"), 6, "cohesion", "separation")


@query("t12_silhouette", f"""WITH v AS (SELECT vec_id, topic, CAST(embedding AS DOUBLE[]) AS e FROM {NOISE_SQL} WHERE topic >= 0),
  d AS (SELECT a.vec_id, a.topic AS ta, b.topic AS tb, sum(1 - list_cosine_similarity(a.e, b.e)) AS s,
  count(*) AS n FROM v a, v b WHERE a.vec_id <> b.vec_id GROUP BY 1, 2, 3),
  ab AS (SELECT vec_id, max(CASE WHEN ta = tb THEN s / n END) AS a, min(CASE WHEN ta <> tb THEN s / n END) AS b FROM d GROUP BY 1)
  SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette, CAST(count(*) AS BIGINT) AS docs FROM ab""")
def t12b(spark, sf):
    v = vectors_noise(spark, sf)
    s = T.silhouette(v, "topic", "embedding")
    return v.filter("topic >= 0").agg(F.round(F.lit(s), 6).alias("silhouette"), F.count(F.lit(1)).alias("docs"))


@query("t14_topic_overlap", f"""WITH a AS {_top_sql('lang', 12)}, b AS {_top_sql('source', 12)}, j AS (SELECT lang, source, count(*) AS shared,
  count(*) / (24 - count(*)) AS jaccard FROM a JOIN b USING (term) GROUP BY 1, 2), r AS (SELECT *, row_number() OVER
  (PARTITION BY lang ORDER BY jaccard DESC, source) AS rn FROM j) SELECT l.lang, source, coalesce(shared, 0) AS shared,
  round(coalesce(jaccard, 0), 8) AS jaccard FROM (SELECT DISTINCT lang FROM a) l LEFT JOIN r ON l.lang = r.lang AND rn = 1""")
def t14(spark, sf):
    return rounded(T.topic_overlap(top_by(spark, sf, "lang", 12), top_by(spark, sf, "source", 12), "lang", "source"), 8, "jaccard")


@query("t15_topic_flow", "SELECT source, " + ", ".join(f"count(*) FILTER (lang = '{x}') AS {x}" for x in LANGS)
       + " FROM documents GROUP BY 1")
def t15(spark, sf):
    return A.crosstab(table(spark, sf, "documents"), "source", "lang", LANGS)


@query("t16_topic_table", f"""WITH w AS (SELECT lang, list(term ORDER BY rank) AS words FROM {_top_sql('lang', 10)} GROUP BY 1)
  SELECT d.lang, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM documents), 2) AS pct,
  array_to_string(any_value(words), ', ') AS keywords, CASE WHEN d.lang = 'en' THEN 'English narratives' ELSE d.lang || ': '
  || array_to_string(any_value(words)[1:4], ', ') END AS label FROM documents d JOIN w ON d.lang = w.lang GROUP BY 1""")
def t16(spark, sf):
    words = T.topic_words(top_by(spark, sf, "lang", 10), "lang")
    return T.topic_table(table(spark, sf, "documents"), "lang", words, 10, {"en": "English narratives"})


# --- coherence -------------------------------------------------------------------------
WORD_LISTS = {0: ["the", "and", "of", "to", "that"], 1: ["de", "la", "le", "que", "les"],
              2: ["der", "und", "the", "sch", "de"]}
_PAIRS = ", ".join(f"({t}, {i}, {j}, '{ws[i]}', '{ws[j]}')" for t, ws in WORD_LISTS.items()
                   for i in range(len(ws)) for j in range(i))
_ALL = sql_list(sorted({w for ws in WORD_LISTS.values() for w in ws}))
_HAS = f"(SELECT doc_id, list_distinct(list_filter({words_sql()}, lambda w: list_contains({_ALL}, w))) AS w FROM documents)"


def _docs(spark, sf):
    return narratives(spark, sf).select("doc_id", X.word_tokens(F.col("text")).alias("t"))


@query("t21_coherence_umass", f"""WITH h AS {_HAS}, p AS (SELECT * FROM (VALUES {_PAIRS}) v(topic, i, j, wi, wj))
  SELECT topic, round(avg(s), 6) AS umass FROM (SELECT topic, wi, wj, ln((count(*) FILTER (list_contains(w, wi)
  AND list_contains(w, wj)) + 1.0) / nullif(count(*) FILTER (list_contains(w, wj)), 0)) AS s FROM p, h GROUP BY 1, 2, 3)
  GROUP BY 1""")
def t21(spark, sf):
    return rounded(C.coherence_umass(_docs(spark, sf), "doc_id", F.col("t"), WORD_LISTS), 6, "umass")


def _window_sql(w):
    """Every window spelled out, then counted: independent of the interval arithmetic."""
    return f"""toks AS (SELECT doc_id, {words_sql()} AS t FROM documents),
  occ AS (SELECT doc_id, n, pos, t[pos + 1] AS word FROM (SELECT doc_id, t, len(t) AS n, unnest(range(0, len(t))) AS pos FROM toks)
    WHERE list_contains({_ALL}, t[pos + 1])),
  cov AS (SELECT DISTINCT doc_id, word, unnest(range(greatest(0, pos - {w - 1}), least(pos, greatest(0, n - {w})) + 1)) AS s FROM occ),
  single AS (SELECT word, count(*) AS c FROM cov GROUP BY 1),
  pair AS (SELECT a.word AS a, b.word AS b, count(*) AS c FROM cov a JOIN cov b ON a.doc_id = b.doc_id AND a.s = b.s GROUP BY 1, 2),
  nw AS (SELECT sum(greatest(1, len(t) - {w - 1})) AS n FROM toks WHERE len(t) > 0)"""


_NPMI = "ln((coalesce(pair.c, 0) / n + 1e-12) / ((x.c / n) * (y.c / n))) / -ln(coalesce(pair.c, 0) / n + 1e-12)"


@query("t22_coherence_npmi", f"""WITH {_window_sql(10)}, p AS (SELECT * FROM (VALUES {_PAIRS}) v(topic, i, j, wi, wj))
  SELECT topic, round(avg({_NPMI}), 6) AS npmi FROM p LEFT JOIN single x ON x.word = wi LEFT JOIN single y ON y.word = wj
  LEFT JOIN pair ON pair.a = wi AND pair.b = wj, nw GROUP BY 1""")
def t22(spark, sf):
    return rounded(C.coherence_npmi(_docs(spark, sf), "doc_id", F.col("t"), WORD_LISTS), 6, "npmi")


@query("t22_npmi_summary", f"""WITH {_window_sql(10)}, p AS (SELECT * FROM (VALUES {_PAIRS}) v(topic, i, j, wi, wj)),
  r AS (SELECT topic, avg({_NPMI}) AS v FROM p LEFT JOIN single x ON x.word = wi LEFT JOIN single y ON y.word = wj
  LEFT JOIN pair ON pair.a = wi AND pair.b = wj, nw GROUP BY 1)
  SELECT round(avg(v), 6) AS overall, round(min(v), 6) AS weakest, round(median(v), 6) AS median FROM r""")
def t22b(spark, sf):
    per = C.coherence_npmi(_docs(spark, sf), "doc_id", F.col("t"), WORD_LISTS)
    return rounded(per.agg(F.avg("npmi").alias("overall"), F.min("npmi").alias("weakest"),
                           F.median("npmi").alias("median")), 6, "overall", "weakest", "median")


_GRID = ", ".join(f"({t}, {i}, {j}, '{wi}', '{wj}')" for t, ws in WORD_LISTS.items()
                  for i, wi in enumerate(ws) for j, wj in enumerate(ws))


@query("t23_coherence_cv", f"""WITH {_window_sql(110)}, p AS (SELECT * FROM (VALUES {_GRID}) v(topic, i, j, wi, wj)),
  v AS (SELECT topic, i, j, {_NPMI} AS v FROM p LEFT JOIN single x ON x.word = wi LEFT JOIN single y ON y.word = wj
    LEFT JOIN pair ON pair.a = wi AND pair.b = wj, nw),
  s AS (SELECT topic, j, sum(v) AS s FROM v GROUP BY 1, 2)
  SELECT topic, round(avg(c), 6) AS c_v FROM (SELECT topic, i, sum(v * s) / sqrt(sum(v * v) * sum(s * s)) AS c
  FROM v JOIN s USING (topic, j) GROUP BY 1, 2) GROUP BY 1""")
def t23(spark, sf):
    return rounded(C.coherence_cv(_docs(spark, sf), "doc_id", F.col("t"), WORD_LISTS), 6, "c_v")


# --- probabilities ------------------------------------------------------------------------
@query("t25_doc_concentration", f"""SELECT round(avg(list_max(gamma)), 8) AS doc_concentration,
  round(avg(len(list_filter(gamma, lambda p: p >= 0.01))), 8) AS doc_density FROM {GAMMA_SQL}""")
def t25(spark, sf):
    return rounded(T.doc_concentration(gamma(spark, sf), "gamma"), 8, "doc_concentration", "doc_density")


_PHI = f"""phi AS (SELECT lang, term, count(*) / sum(count(*)) OVER (PARTITION BY lang) AS p FROM (SELECT lang,
  unnest({words_sql()}) AS term FROM documents) GROUP BY 1, 2)"""


def _phi(spark, sf):
    tf = T.class_terms(narratives(spark, sf), "lang", X.word_tokens(F.col("text")))
    return T.topic_term_probs(tf, "lang")


@query("t26_separation_jsd", f"""WITH {_PHI}, t AS (SELECT DISTINCT term FROM phi), l AS (SELECT DISTINCT lang FROM phi),
  q AS (SELECT l.lang, t.term, coalesce(p, 0) AS p FROM l CROSS JOIN t LEFT JOIN phi ON phi.lang = l.lang AND phi.term = t.term)
  SELECT round(avg(d), 6) AS topic_separation_jsd FROM (SELECT a.lang, b.lang, sum(0.5 * a.p * ln((a.p + 1e-12) /
  (0.5 * (a.p + b.p) + 1e-12)) + 0.5 * b.p * ln((b.p + 1e-12) / (0.5 * (a.p + b.p) + 1e-12))) AS d FROM q a JOIN q b
  ON a.term = b.term AND a.lang < b.lang GROUP BY 1, 2)""")
def t26(spark, sf):
    return rounded(T.separation_jsd(_phi(spark, sf), "lang"), 6, "topic_separation_jsd")


@query("t27_mv_r2", f"""WITH {_PHI}, y AS (SELECT doc_id, lang, term, count(*) / sum(count(*)) OVER (PARTITION BY doc_id) AS p FROM
  (SELECT doc_id, lang, unnest({words_sql()}) AS term FROM documents) GROUP BY 1, 2, 3), l AS (SELECT DISTINCT lang FROM documents),
  fit AS (SELECT l.lang, term, sum(CASE WHEN l.lang = phi.lang THEN 0.7 ELSE 0.1 END * p) AS h FROM l, phi GROUP BY 1, 2),
  n AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1),
  e AS (SELECT (SELECT sum(p * p) FROM y) - 2 * (SELECT sum(p * h) FROM y JOIN fit USING (lang, term))
    + (SELECT sum(n * h * h) FROM fit JOIN n USING (lang)) AS sse,
    (SELECT sum(p * p) FROM y) - (SELECT sum(s * s) FROM (SELECT sum(p) AS s FROM y GROUP BY term)) / (SELECT count(*) FROM documents) AS sst)
  SELECT round(sse, 6) AS sse, round(sst, 6) AS sst, round(1 - sse / sst, 6) AS mv_r2 FROM e""")
def t27(spark, sf):
    from ..operators.textfeatures import term_counts
    d = narratives(spark, sf)
    tf = term_counts(d, ["doc_id"], X.word_tokens(F.col("text")))
    from pyspark.sql import Window
    y = tf.select("doc_id", "term", (F.col("tf") / F.sum("tf").over(Window.partitionBy("doc_id"))).alias("p"))
    theta = d.select("doc_id", F.array(*[F.when(F.col("lang") == x, 0.7).otherwise(0.1) for x in LANGS]).alias("theta"))
    phi = _phi(spark, sf).groupBy("term").agg(F.array(*[
        F.coalesce(F.max(F.when(F.col("lang") == x, F.col("p"))), F.lit(0.0)) for x in LANGS]).alias("phi"))
    return rounded(T.mv_r2(y, theta, phi, "doc_id", len(LANGS)), 6, "sse", "sst", "mv_r2")


_AMB = f"""(SELECT *, prob < 0.08 AS weak, entropy >= 0.78 AS high_entropy, prob < 0.08 OR entropy >= 0.78 AS ambiguous FROM
  (SELECT vec_id, CAST(list_position(gamma, list_max(gamma)) - 1 AS INTEGER) AS topic, list_max(gamma) AS prob,
  -list_sum(list_transform(gamma, lambda p: p * ln(p + 1e-12))) / ln(64.0) AS entropy FROM {GAMMA_SQL}))"""


def _amb(spark, sf):
    return T.doc_ambiguity(gamma(spark, sf), "vec_id", "gamma", 0.08, 0.78)


@query("t28_doc_ambiguity", f"SELECT vec_id, topic, round(prob, 8) AS prob, round(entropy, 8) AS entropy, weak, high_entropy, ambiguous FROM {_AMB}")
def t28(spark, sf):
    return rounded(_amb(spark, sf), 8, "prob", "entropy")


@query("t28_ambiguity_counts", "SELECT count(*) AS total, " + ", ".join(
    f"count(*) FILTER ({c}) AS {c}, round(count(*) FILTER ({c}) * 100.0 / count(*), 6) AS {c}_pct"
    for c in ("weak", "high_entropy", "ambiguous")) + f" FROM {_AMB}")
def t28b(spark, sf):
    return rounded(T.ambiguity_counts(_amb(spark, sf)), 6, "weak_pct", "high_entropy_pct", "ambiguous_pct")


@query("t29_topic_clarity", f"""SELECT CAST(k AS INTEGER) AS topic, count(prob) AS doc_count, round(median(prob), 3) AS median_prob,
  round(count(*) FILTER (prob < 0.1) * 100.0 / nullif(count(prob), 0), 1) AS low_pct FROM (SELECT unnest(range(0, 70)) AS k)
  LEFT JOIN {_AMB} a ON a.topic = k GROUP BY 1""")
def t29(spark, sf):
    topics = spark.range(70).select(F.col("id").cast("int").alias("topic"))
    return T.topic_clarity(_amb(spark, sf), "topic", "prob", topics, 0.1)


_GRAMS = f"list_concat({ngrams_sql('t', 2)}, {ngrams_sql('t', 3)})"
_TITLE = "array_to_string(list_transform(string_split(term, ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


@query("t30_phrase_names", f"""WITH g AS (SELECT doc_id, source, unnest({_GRAMS}) AS term FROM (SELECT doc_id, source,
  list_filter({words_sql(stop=True)}, lambda w: NOT list_contains({sql_list(K.PHRASE_STOP)}, w)) AS t FROM documents)), d AS (SELECT source, doc_id, term, count(*) AS tf FROM g GROUP BY 1, 2, 3),
  s AS (SELECT source, term, sum(tf) AS cf, count(*) AS df, len(string_split(term, ' ')) AS n FROM d GROUP BY 1, 2),
  ok AS (SELECT *, max(n) OVER (PARTITION BY source) AS best FROM s JOIN (SELECT source, count(*) AS docs FROM documents GROUP BY 1)
    USING (source) WHERE df >= 2 AND df <= docs * 0.8)
  SELECT source, rank, term, {_TITLE} AS phrase, CAST(cf AS BIGINT) AS cf, df FROM (SELECT *, row_number() OVER (PARTITION BY source
  ORDER BY n DESC, cf DESC, term DESC) AS rank FROM ok WHERE n = best) WHERE rank <= 2""")
def t30(spark, sf):
    words = X.word_tokens(F.col("text"), [*K.ENGLISH_STOP, *K.PHRASE_STOP])
    d = narratives(spark, sf).select("doc_id", "source", words.alias("t"))
    return T.phrase_names(d, "doc_id", "source", "t")


_SHARE = """(SELECT source, count(*) AS total, count(*) FILTER (lang = 'fr') AS in_group, count(*) FILTER (lang <> 'fr') AS in_rest,
  count(*) FILTER (lang = 'fr') / (SELECT greatest(1, count(*)) FROM documents WHERE lang = 'fr') AS group_share,
  count(*) FILTER (lang <> 'fr') / (SELECT greatest(1, count(*)) FROM documents WHERE lang <> 'fr') AS rest_share,
  count(*) / (SELECT count(*) FROM documents) AS overall_share FROM documents GROUP BY 1)"""


@query("t32_group_topic_share", f"""SELECT source, total, in_group, in_rest, round(group_share, 8) AS group_share,
  round(rest_share, 8) AS rest_share, round(overall_share, 8) AS overall_share FROM {_SHARE}""")
def t32(spark, sf):
    s = T.group_topic_share(table(spark, sf, "documents"), "source", F.col("lang") == "fr")
    return rounded(s, 8, "group_share", "rest_share", "overall_share")


@query("t33_topic_lift", f"""SELECT source, round(group_share / overall_share, 8) AS lift, CASE WHEN group_share / overall_share >= 1.5
  THEN 'more in group' WHEN group_share / overall_share <= 0.75 THEN 'more in rest' ELSE 'similar' END AS focus FROM {_SHARE}""")
def t33(spark, sf):
    s = T.group_topic_share(table(spark, sf, "documents"), "source", F.col("lang") == "fr")
    return rounded(T.topic_lift(s).select("source", "lift", "focus"), 8, "lift")


@query("t34_topic_agency_matrix", "SELECT source, " + ", ".join(
    f"round(count(*) FILTER (lang = '{x}') / (SELECT count(*) FROM documents WHERE lang = '{x}'), 8) AS {x}" for x in LANGS)
    + " FROM documents GROUP BY 1")
def t34(spark, sf):
    return A.crosstab(table(spark, sf, "documents"), "source", "lang", LANGS, "columns", 8)


_AXIS = "list_transform(m, lambda r: list_dot_product(r, {v}))"


@query("t35_topic_map", f"""WITH RECURSIVE t AS (SELECT lang, term, count(*) AS tf FROM (SELECT lang, unnest({words_sql(stop=True)}) AS term FROM documents)
    GROUP BY 1, 2),
  p AS (SELECT lang, term, tf / sum(tf) OVER (PARTITION BY lang) AS w FROM t),
  l AS (SELECT DISTINCT lang FROM p),
  g AS (SELECT a.lang AS a, b.lang AS b, coalesce(sum(x.w * y.w), 0) AS g FROM l a CROSS JOIN l b LEFT JOIN p x ON x.lang = a.lang
    LEFT JOIN p y ON y.lang = b.lang AND y.term = x.term GROUP BY 1, 2),
  c AS (SELECT a, b, g - avg(g) OVER (PARTITION BY a) - avg(g) OVER (PARTITION BY b) + avg(g) OVER () AS g FROM g),
  m AS (SELECT list(r ORDER BY a) AS m FROM (SELECT a, list(g ORDER BY b) AS r FROM c GROUP BY 1)),
  one AS (SELECT 0 AS i, list_transform(range(1, len(m) + 1), lambda k: 1.0 / (k * k)) AS v, m FROM m
    UNION ALL SELECT i + 1, list_transform({_AXIS.format(v='v')}, lambda z: z / sqrt(list_dot_product({_AXIS.format(v='v')}, {_AXIS.format(v='v')}))), m
    FROM one WHERE i < 400),
  e AS (SELECT v AS v1, list_dot_product({_AXIS.format(v='v')}, v) AS l1, m FROM one WHERE i = 400),
  d AS (SELECT v1, l1, list_transform(range(1, len(m) + 1), lambda i: list_transform(range(1, len(m) + 1), lambda j: m[i][j] - l1 * v1[i] * v1[j])) AS m FROM e),
  two AS (SELECT 0 AS i, list_transform(range(1, len(m) + 1), lambda k: 1.0 / (k * k)) AS v, m FROM d
    UNION ALL SELECT i + 1, list_transform({_AXIS.format(v='v')}, lambda z: z / sqrt(list_dot_product({_AXIS.format(v='v')}, {_AXIS.format(v='v')}))), m
    FROM two WHERE i < 400),
  f AS (SELECT v AS v2, list_dot_product({_AXIS.format(v='v')}, v) AS l2 FROM two WHERE i = 400),
  s AS (SELECT lang, v1[k] * sqrt(l1) AS x, v2[k] * sqrt(l2) AS y FROM (SELECT lang, row_number() OVER (ORDER BY lang) AS k FROM l), d, f)
  SELECT lang, round(x * sign(arg_max(x, abs(x)) OVER ()), 8) AS x, round(y * sign(arg_max(y, abs(y)) OVER ()), 8) AS y FROM s""")
def t35_map(spark, sf):
    """Languages by their shares of words."""
    tf = T.class_terms(narratives(spark, sf), "lang", _tokens())
    total = tf.groupBy("lang").agg(F.sum("tf").alias("n"))
    shares = tf.join(F.broadcast(total), "lang").select("lang", "term", (F.col("tf") / F.col("n")).alias("w"))
    return rounded(L.project_topics(shares, "lang", "term", "w"), 8, "x", "y")
