"""Token frames, document frequencies, stop lists, TF-IDF.

Long form is (key, term, tf). Text is hashed by key once and its terms are counted
where they land, so exploded words never cross the network.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import text as X
from ..plans.skew import HOT_ROWS, lookup_by_weight
from .windows import word_set

# Own suffix rules, tried in this order: (pattern, shortest word, replacement).
SUFFIX_RULES = [
    (r"ies$", 5, "y"), (r"(ss|x|z|ch|sh)es$", 5, "$1"), (r"([^s])s$", 4, "$1"),
    (r"ing$", 6, ""), (r"ed$", 5, ""),
]


def suffix_lemma(w: Column) -> Column:
    out = None
    for pattern, shortest, repl in SUFFIX_RULES:
        hit = w.rlike(pattern) & (F.length(w) >= shortest)
        cut = F.regexp_replace(w, pattern, repl)
        out = F.when(hit, cut) if out is None else out.when(hit, cut)
    return out.otherwise(w)


def lemma_tokens(text: Column, lemmas: Mapping[str, str] | None = None,
                 stop: Sequence[str] = tuple(K.ENGLISH_STOP)) -> Column:
    """Alphabetic, non-stop tokens, lemma by dictionary then suffix rule, length > 2."""
    words = F.filter(
        F.split(F.lower(text), r"(?U)[^\p{L}\p{M}\p{Nd}_]+"), lambda w: w.rlike(r"^\p{L}+$"))
    kept = X.drop_words(words, stop)

    def lemma(w):
        rule = suffix_lemma(w)
        if not lemmas:
            return rule
        table = F.create_map(*[F.lit(x) for kv in lemmas.items() for x in kv])
        return F.coalesce(F.element_at(table, w), rule)

    return F.filter(F.transform(kept, lemma), lambda w: F.length(w) > 2)


def lemmatise(df: DataFrame, text: str, name: str = "text_lemma", lemmas: Mapping[str, str] | None = None,
              stop: Sequence[str] = tuple(K.ENGLISH_STOP)) -> DataFrame:
    """X5 as text."""
    return df.withColumn(name, F.array_join(lemma_tokens(F.col(text), lemmas, stop), " "))


def spread_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hash rows over the session's shuffle partitions by key, so that costly row work
    is parallel whatever the file layout and grouping by the key needs no more shuffle."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)


def term_counts(df: DataFrame, keys: Sequence[str], tokens: Column) -> DataFrame:
    """(keys, term, tf). The text crosses the network once, before it is exploded;
    counting then happens in place."""
    # Exploding the expression itself keeps the token array out of the exploded rows.
    words = spread_rows(df, keys).select(*keys, F.explode(tokens).alias("term"))
    return words.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("tf"))


def doc_freq(df: DataFrame, tokens: Column) -> DataFrame:
    """(word, docs) over row-distinct tokens, combined on the map side."""
    return df.select(F.explode(F.array_distinct(tokens)).alias("word")).groupBy("word").agg(
        F.count(F.lit(1)).alias("docs"))


def very_common(df: DataFrame, tokens: Column, share: float = 0.85) -> DataFrame:
    """Words in more than ``share`` of all rows."""
    n = df.agg(F.count(F.lit(1))).scalar()
    return doc_freq(df, tokens).filter(F.col("docs") / n > share)


def label_stopwords(df: DataFrame, tokens: Column, stop: Sequence[str] = tuple(K.ENGLISH_STOP),
                    hide: Sequence[str] = tuple(K.LABEL_HIDE), keep: Sequence[str] = tuple(K.LABEL_KEEP),
                    share: float = 0.85) -> DataFrame:
    """(stop, hide and very common words) without the protected ones."""
    spark = df.sparkSession
    fixed = spark.createDataFrame([(w,) for w in sorted(set(stop) | set(hide))], "word string")
    kept = spark.createDataFrame([(w,) for w in sorted(set(keep))], "word string")
    return word_set(fixed, [very_common(df, tokens, share)], kept)


def text_audit(df: DataFrame, text: str, flag: Column, columns: Sequence[str]) -> DataFrame:
    """X11: flagged rows with their text measures, shortest and least varied first."""
    m = X.text_metrics(F.col(text))
    return df.filter(flag).select(*columns, *[c.alias(n) for n, c in m.items()]).orderBy(
        "word_count", "lex_diversity", F.desc("punct_ratio"), *columns)


def near_empty_share(audit: DataFrame, max_words: int = 3) -> DataFrame:
    """X11: share of the audited rows with at most three words."""
    return audit.agg(
        F.count(F.lit(1)).alias("flagged"), F.count_if(F.col("word_count") <= max_words).alias("near_empty"),
    ).withColumn("share", F.try_divide(F.col("near_empty").cast("double"), "flagged"))


def vocabulary(terms: DataFrame, n_docs: Column, min_df: float = 1, max_df: float = 1.0,
               keep_n: int | None = None) -> DataFrame:
    """(term, df, cf) within the document-frequency limits; floats are shares.

    ``keep_n`` keeps the most frequent terms by document frequency, ties by term.
    """
    def limit(x):
        return n_docs * F.lit(x) if isinstance(x, float) else F.lit(x)
    v = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))
    v = v.filter((F.col("df") >= limit(min_df)) & (F.col("df") <= limit(max_df)))
    return v.orderBy(F.desc("df"), "term").limit(keep_n) if keep_n else v


def count_vectorize(df: DataFrame, key: str, tokens: Column, min_df: float = 1, max_df: float = 1.0,
                    keep_n: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(key, term, tf, df) for the kept vocabulary."""
    terms = term_counts(df, [key], tokens)
    n = df.agg(F.count(F.lit(1))).scalar()
    vocab = vocabulary(terms, n, min_df, max_df, keep_n).select("term", "df")
    return lookup_by_weight(terms, vocab, ["term"], "df", hot_rows).filter(F.col("df").isNotNull())


def smooth_idf(n: Column, df: Column) -> Column:
    return F.ln((n + F.lit(1)) / (df + F.lit(1))) + F.lit(1.0)


def tfidf(df: DataFrame, key: str, tokens: Column, min_df: float = 1, max_df: float = 1.0,
          hot_rows: int = HOT_ROWS) -> DataFrame:
    """(key, term, weight) with smoothed idf + 1 and unit rows."""
    n = df.agg(F.count(F.lit(1))).scalar()
    counts = count_vectorize(df, key, tokens, min_df, max_df, None, hot_rows)
    w = counts.select(key, "term", (F.col("tf") * smooth_idf(n, F.col("df"))).alias("_w"))
    length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(key)))
    return w.select(key, "term", (F.col("_w") / length).alias("weight"))


def lowest_idf_terms(df: DataFrame, key: str, tokens: Column, n_terms: int = 30, min_df: float = 1,
                     max_df: float = 1.0) -> DataFrame:
    """The most widespread terms, bounded top-n."""
    n = df.agg(F.count(F.lit(1))).scalar()
    v = vocabulary(term_counts(df, [key], tokens), n, min_df, max_df)
    # More documents means lower idf, so the integer count decides and ties stay exact.
    top = v.orderBy(F.desc("df"), "term").limit(n_terms)
    return top.select("term", "df", smooth_idf(n, F.col("df")).alias("idf"))
