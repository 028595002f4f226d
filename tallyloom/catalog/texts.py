"""X1-X17, W11."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import scoring
from ..functions import text as X
from ..functions.cleaning import lookup
from ..operators import textfeatures as TF
from ..operators import windows as W
from ..operators.profile import rounded
from .registry import narratives, query, sql_list, table

# A non-ASCII letter is a word character in Spark's (?U) patterns but not in the SQL
# engine's; written as "_" it is one in both, and matches none of the token classes.
FOLD_WORD = r"regexp_replace({c}, '[^\x00-\x7F\p{{P}}\p{{S}}\p{{Z}}\p{{C}}]', '_', 'g')"
WORDS = r"regexp_extract_all(lower({c}), '[\p{{L}}\p{{M}}\p{{Nd}}_]{{2,}}')"
STOP_SQL = sql_list(sorted(set(K.ENGLISH_STOP)))


def words_sql(c="text", stop=False):
    w = WORDS.format(c=c)
    return f"list_filter({w}, lambda w: NOT list_contains({STOP_SQL}, w))" if stop else w


def ngrams_sql(t: str, n: int) -> str:
    shifted = ", ".join(f"{t}[{i + 1}:]" for i in range(n))
    joined = " || ' ' || ".join(f"z[{i + 1}]" for i in range(n))
    return f"list_transform(list_zip({shifted}, true), lambda z: {joined})"


@query("x01_concat_fields", """SELECT p_partkey, coalesce(p_name, '') || ' ' || coalesce(nullif(p_brand, 'Brand#1'), '') || ' '
  || coalesce(p_type, '') AS text_all FROM part""")
def x01(spark, sf):
    return table(spark, sf, "part").select("p_partkey", X.concat_fields(
        [F.col("p_name"), F.nullif(F.col("p_brand"), F.lit("Brand#1")), F.col("p_type")]).alias("text_all"))


@query("x02_row_to_text", """SELECT p_partkey, concat_ws(' | ', p_name, nullif(p_brand, 'Brand#1'), CAST(p_size AS VARCHAR))
  AS row_text, concat_ws(' | ', p_name, CASE WHEN p_brand <> 'Brand#1' THEN p_brand END, CAST(p_size AS VARCHAR))
  AS proposal_text FROM part""")
def x02(spark, sf):
    brand = F.nullif(F.col("p_brand"), F.lit("Brand#1"))
    blank = F.when(F.col("p_brand") == "Brand#1", "  ").otherwise(F.col("p_brand"))
    return table(spark, sf, "part").select(
        "p_partkey", X.row_to_text([F.col("p_name"), brand, F.col("p_size")]).alias("row_text"),
        X.row_to_text([F.col("p_name"), blank, F.col("p_size")], skip_blank=True).alias("proposal_text"))


@query("x03_word_count", r"SELECT doc_id, CAST(len(regexp_extract_all(text, '\S+')) AS INTEGER) AS words FROM documents")
def x03(spark, sf):
    return narratives(spark, sf).select("doc_id", X.word_count(F.col("text")).alias("words"))


def _preclean_sql(c):
    t = rf"regexp_replace({c}, '[-–—]+', ' ', 'g')"
    t = rf"regexp_replace({t}, 'https?://\S+|www\.\S+', ' ', 'g')"
    t = rf"regexp_replace({t}, '\b[\w\.-]+@[\w\.-]+\.\w+\b', ' ', 'g')"
    t = rf"lower(trim(regexp_replace({t}, '\s+', ' ', 'g')))"
    for p in [r"\bmission[-\s]+enabling\b", r"\buse[-\s]*case(?:s)?\b", r"\bintended\s+purpose\b",
              r"\bexpected\s+benefits\b"]:
        t = rf"regexp_replace({t}, '{p}', ' ', 'g')"
    return rf"trim(regexp_replace({t}, '\s+', ' ', 'g'))"


@query("x04_light_preclean", f"SELECT doc_id, {_preclean_sql('text')} AS clean FROM documents")
def x04(spark, sf):
    return narratives(spark, sf).select("doc_id", X.light_preclean(F.col("text")).alias("clean"))


@query("x04_light_preclean_phrases", f"""SELECT conv_id, turn, {_preclean_sql(
    "'Mission-enabling use case ' || text || ' www.example.com/a mail-us a.b@c.gov'")} AS clean FROM conversations""")
def x04b(spark, sf):
    t = F.concat(F.lit("Mission-enabling use case "), F.col("text"), F.lit(" www.example.com/a mail-us a.b@c.gov"))
    return table(spark, sf, "conversations").select("conv_id", "turn", X.light_preclean(t).alias("clean"))


LEMMAS = {"children": "child", "people": "person"}
_LEMMA = r"""CASE WHEN w = 'children' THEN 'child' WHEN w = 'people' THEN 'person'
  WHEN regexp_matches(w, 'ies$') AND length(w) >= 5 THEN regexp_replace(w, 'ies$', 'y')
  WHEN regexp_matches(w, '(ss|x|z|ch|sh)es$') AND length(w) >= 5 THEN w[1:length(w) - 2]
  WHEN regexp_matches(w, '[^s]s$') AND length(w) >= 4 THEN w[1:length(w) - 1]
  WHEN regexp_matches(w, 'ing$') AND length(w) >= 6 THEN w[1:length(w) - 3]
  WHEN regexp_matches(w, 'ed$') AND length(w) >= 5 THEN w[1:length(w) - 2] ELSE w END"""


@query("x05_lemmatise", rf"""SELECT doc_id, array_to_string(list_filter(list_transform(list_filter(
  regexp_split_to_array(lower(text), '[^\p{{L}}\p{{M}}\p{{Nd}}_]+'), lambda w: regexp_full_match(w, '\p{{L}}+')
  AND NOT list_contains({STOP_SQL}, w)), lambda w: {_LEMMA}), lambda w: length(w) > 2), ' ') AS text_lemma
  FROM documents""")
def x05(spark, sf):
    return TF.lemmatise(narratives(spark, sf).select("doc_id", "text"), "text", lemmas=LEMMAS).drop("text")


_LABEL_TOKENS = rf"regexp_extract_all({FOLD_WORD.format(c='lower(text)')}, '\b[a-z0-9][a-z0-9-]+\b')"


@query("x06_doc_tokens", rf"""SELECT doc_id, CAST(len(t) AS INTEGER) AS tokens, md5(array_to_string(list_sort(t), ' '))
  AS digest FROM (SELECT doc_id, list_distinct({_LABEL_TOKENS}) AS t FROM documents)""")
def x06(spark, sf):
    d = narratives(spark, sf).select("doc_id", X.label_tokens(F.col("text")).alias("t"))
    return d.select("doc_id", F.size("t").alias("tokens"),
                    F.md5(F.array_join(F.sort_array("t"), " ")).alias("digest"))


_DF = f"""(SELECT word, count(*) AS docs FROM (SELECT doc_id, unnest(list_distinct({_LABEL_TOKENS})) AS word
  FROM documents) GROUP BY 1)"""


@query("x07_doc_freq", f"SELECT word, docs FROM {_DF}")
def x07(spark, sf):
    return TF.doc_freq(narratives(spark, sf), X.label_tokens(F.col("text")))


@query("x07_very_common", f"SELECT word, docs FROM {_DF} WHERE docs / (SELECT count(*) FROM documents) > 0.3")
def x07b(spark, sf):
    return TF.very_common(narratives(spark, sf), X.label_tokens(F.col("text")), 0.3)


@query("x08_label_stopwords", f"""SELECT DISTINCT word FROM (SELECT unnest({STOP_SQL}) AS word UNION ALL
  SELECT unnest({sql_list(K.LABEL_HIDE)}) UNION ALL SELECT word FROM {_DF} WHERE docs /
  (SELECT count(*) FROM documents) > 0.3) WHERE NOT list_contains({sql_list(K.LABEL_KEEP)}, word)""")
def x08(spark, sf):
    return TF.label_stopwords(narratives(spark, sf), X.label_tokens(F.col("text")), share=0.3)


_DOC_WORDS = f"(SELECT DISTINCT lang, unnest({words_sql()}) AS word FROM documents)"


@query("w11_word_set", f"""SELECT DISTINCT word FROM {_DOC_WORDS} WHERE lang IN ('en', 'fr') AND word NOT IN
  (SELECT word FROM {_DOC_WORDS} WHERE lang = 'es')""")
def w11(spark, sf):
    words = narratives(spark, sf).select("lang", F.explode(X.word_tokens(F.col("text"))).alias("word"))
    return W.word_set(words.filter("lang = 'en'"), [words.filter("lang = 'fr'")], words.filter("lang = 'es'"))


_SIMPLE = rf"""list_filter(regexp_extract_all(strip_accents(lower(text)), '[\p{{L}}\p{{M}}_]+'),
  lambda w: length(w) BETWEEN 2 AND 30 AND NOT starts_with(w, '_') AND NOT list_contains({sql_list(sorted(set(K.DOMAIN_STOP)))}, w))"""


@query("x09_tokenize_simple", f"""SELECT doc_id, CAST(len(t) AS INTEGER) AS tokens, md5(array_to_string(t, ' ')) AS digest
  FROM (SELECT doc_id, {_SIMPLE} AS t FROM documents)""")
def x09(spark, sf):
    d = narratives(spark, sf).select("doc_id", X.simple_tokens(F.col("text"), K.DOMAIN_STOP).alias("t"))
    return d.select("doc_id", F.size("t").alias("tokens"), F.md5(F.array_join("t", " ")).alias("digest"))


_BOILER = "|".join(K.BOILERPLATE_PHRASES)
METRICS_SQL = rf"""(SELECT doc_id, lang, source, CAST(len(w) AS INTEGER) AS word_count,
  CAST(len(list_distinct(list_transform(w, lambda x: lower(x)))) AS INTEGER) AS uniq_tokens,
  round(len(list_distinct(list_transform(w, lambda x: lower(x)))) / greatest(1, len(w)), 8) AS lex_diversity,
  CAST(length(text) AS INTEGER) AS char_len,
  round((length(text) - length(translate(text, '.,;:!?()[]{{}}"''/', ''))) / greatest(1, length(text)), 8) AS punct_ratio,
  CAST(len(regexp_extract_all(text, '\p{{Nd}}')) AS INTEGER) AS digit_count,
  regexp_matches(f, '(?i){_BOILER}') AS has_boilerplate FROM (SELECT *, regexp_extract_all(f, '\b[a-zA-Z0-9-]+\b') AS w
  FROM (SELECT *, {FOLD_WORD.format(c='text')} AS f FROM documents)))"""


@query("x10_text_metrics", f"SELECT * EXCLUDE (lang, source) FROM {METRICS_SQL}")
def x10(spark, sf):
    m = X.text_metrics(F.col("text"))
    return rounded(narratives(spark, sf).select("doc_id", *[c.alias(n) for n, c in m.items()]), 8,
                   "lex_diversity", "punct_ratio")


@query("x11_text_audit", f"SELECT * EXCLUDE (source) FROM {METRICS_SQL} WHERE lang <> 'en'")
def x11(spark, sf):
    return rounded(TF.text_audit(narratives(spark, sf), "text", F.col("lang") != "en", ["doc_id", "lang"]), 8,
                   "lex_diversity", "punct_ratio")


@query("x11_near_empty_share", f"""SELECT count(*) AS flagged, count(*) FILTER (word_count <= 30) AS near_empty,
  round(count(*) FILTER (word_count <= 30) / count(*), 8) AS share FROM {METRICS_SQL} WHERE lang <> 'en'""")
def x11b(spark, sf):
    return rounded(TF.near_empty_share(x11(spark, sf), 30), 8, "share")


@query("x12_ngrams", f"""SELECT doc_id, CAST(len(g) AS INTEGER) AS n, md5(array_to_string(g, '|')) AS digest FROM (SELECT doc_id,
  list_concat({ngrams_sql('t', 2)}, {ngrams_sql('t', 3)}) AS g FROM (SELECT doc_id, {words_sql()} AS t FROM documents))""")
def x12(spark, sf):
    t = narratives(spark, sf).select("doc_id", X.word_tokens(F.col("text")).alias("t"))
    g = t.select("doc_id", X.ngrams(F.col("t"), 2, 3).alias("g"))
    return g.select("doc_id", F.size("g").alias("n"), F.md5(F.array_join("g", "|")).alias("digest"))


_TERMS = f"(SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({words_sql()}) AS term FROM documents) GROUP BY 1, 2)"
_VOCAB = f"""(SELECT term, count(*) AS df, sum(tf) AS cf FROM {_TERMS} GROUP BY 1 HAVING count(*) >= 5
  AND count(*) <= 0.9 * (SELECT count(*) FROM documents))"""


@query("x13_vocabulary", f"SELECT term, df, CAST(cf AS BIGINT) AS cf FROM {_VOCAB} ORDER BY df DESC, term LIMIT 50000")
def x13(spark, sf):
    d = narratives(spark, sf)
    terms = TF.term_counts(d, ["doc_id"], X.word_tokens(F.col("text")))
    return TF.vocabulary(terms, d.agg(F.count(F.lit(1))).scalar(), 5, 0.9, keep_n=50_000)


@query("x13_count_vectorize", f"""SELECT doc_id, count(*) AS terms, CAST(sum(tf) AS BIGINT) AS tokens, md5(string_agg(term || ':' || tf,
  ' ' ORDER BY term)) AS digest FROM {_TERMS} WHERE term IN (SELECT term FROM {_VOCAB}) GROUP BY 1""")
def x13b(spark, sf):
    cv = TF.count_vectorize(narratives(spark, sf), "doc_id", X.word_tokens(F.col("text")), 5, 0.9)
    pair = F.concat(F.col("term"), F.lit(":"), F.col("tf").cast("string"))
    return cv.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("terms"), F.sum("tf").alias("tokens"),
        F.collect_list(F.struct("term", pair.alias("p"))).alias("l")).select(
        "doc_id", "terms", "tokens",
        F.md5(F.array_join(F.transform(F.sort_array("l"), lambda s: s["p"]), " ")).alias("digest"))


_UB = f"(SELECT doc_id, list_concat(t, {ngrams_sql('t', 2)}) AS g FROM (SELECT doc_id, {words_sql(stop=True)} AS t FROM documents))"
TFIDF_SQL = f"""(WITH tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(g) AS term FROM {_UB}) GROUP BY 1, 2),
  v AS (SELECT term, count(*) AS df FROM tf GROUP BY 1 HAVING count(*) >= 5 AND count(*) <= 0.9 * (SELECT count(*) FROM documents)),
  w AS (SELECT doc_id, term, tf * (ln(((SELECT count(*) FROM documents) + 1) / (df + 1)) + 1) AS w FROM tf JOIN v USING (term))
  SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM w)"""


def bigram_tokens(c="text", stop=K.ENGLISH_STOP):
    return X.ngrams(X.word_tokens(F.col(c), stop), 1, 2)


@query("x14_tfidf", f"""SELECT doc_id, count(*) AS terms, md5(string_agg(term || ':' || CAST(round(weight * 100000) AS BIGINT),
  ' ' ORDER BY term)) AS digest FROM {TFIDF_SQL} GROUP BY 1""")
def x14(spark, sf):
    d = narratives(spark, sf).select("doc_id", X.word_tokens(F.col("text"), K.ENGLISH_STOP).alias("t"))
    w = TF.tfidf(d, "doc_id", X.ngrams(F.col("t"), 1, 2), 5, 0.9)
    pair = F.concat(F.col("term"), F.lit(":"), F.round(F.col("weight") * 100000).cast("long").cast("string"))
    return w.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("terms"), F.collect_list(F.struct("term", pair.alias("p"))).alias("l")).select(
        "doc_id", "terms", F.md5(F.array_join(F.transform(F.sort_array("l"), lambda s: s["p"]), " ")).alias("digest"))


@query("x15_lowest_idf_terms", f"""SELECT term, df, round(ln(((SELECT count(*) FROM documents) + 1) / (df + 1)) + 1, 8) AS idf
  FROM {_VOCAB} ORDER BY df DESC, term LIMIT 30""")
def x15(spark, sf):
    return rounded(TF.lowest_idf_terms(narratives(spark, sf), "doc_id", X.word_tokens(F.col("text")), 30, 5, 0.9),
                   8, "idf")


def _level_sql(c):
    return "CASE " + " ".join(
        f"WHEN regexp_matches({c}, '(?i)" + "|".join(K.LEVEL_PATTERNS[k]) + f"') THEN {k}" for k in (5, 4, 3, 2, 1)
    ) + " ELSE 2 END"


_FOLDED = FOLD_WORD.format(c="lower(text)")


@query("x16_keyword_level", f"SELECT doc_id, {_level_sql(_FOLDED)} AS level FROM documents")
def x16(spark, sf):
    return narratives(spark, sf).select("doc_id", scoring.keyword_level(F.col("text")).alias("level"))


_TOPIC_POINTS = "CASE doc_id % 45 " + " ".join(f"WHEN {k} THEN {v}" for k, v in K.TOPIC_COMPLEXITY.items()) + " ELSE 2 END"
AREA_BY_LANG = {"en": "Health & Medical", "de": "Law & Justice", "fr": "Mission-Enabling", "es": "Classification"}


@query("x17_complexity_score", f"""SELECT doc_id, round(({_TOPIC_POINTS} + {_level_sql(_FOLDED)} + CASE lang WHEN 'en' THEN 5
  WHEN 'de' THEN 4 WHEN 'es' THEN 3 ELSE 2 END) / 15.0 * 100, 6) AS complexity_score FROM documents""")
def x17(spark, sf):
    score = scoring.complexity_score(F.col("doc_id") % 45, F.col("text"), lookup(F.col("lang"), AREA_BY_LANG))
    return rounded(narratives(spark, sf).select("doc_id", score.alias("complexity_score")), 6, "complexity_score")
