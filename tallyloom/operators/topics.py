"""Topic description and quality from labels, terms and probabilities."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions import vectors as V
from ..functions.cleaning import lookup, nice_title
from ..functions.scoring import focus_bucket
from ..functions.text import ngrams
from ..plans.ranges import dense_index, exact_quantiles, null_safe_join
from ..plans.skew import HOT_ROWS, lookup_by_weight
from ..session import cut_lineage
from .joins import outer_counts
from .similar import top_matches, unit_rows
from .textfeatures import term_counts
from .windows import top_k_per_group


# --- class-based TF-IDF --------------------------------------------------------
def class_terms(df: DataFrame, topic: str, tokens: Column, min_df: int = 1) -> DataFrame:
    """(topic, term, tf) summed on the map side; terms in fewer than min_df topics dropped."""
    words = df.filter(F.col(topic) >= 0) if isinstance(df.schema[topic].dataType, NumericType) else df
    tf = words.select(topic, F.explode(tokens).alias("term")).groupBy(topic, "term").agg(
        F.count(F.lit(1)).alias("tf"))
    if min_df > 1:
        tf = tf.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("term"))).filter(
            F.col("_n") >= min_df).drop("_n")
    return tf


def ctfidf(tf: DataFrame, topic: str) -> DataFrame:
    """Tf * ln(1 + mean words per topic / term total). A term has at most one row per
    topic, so the window over terms has no hot group."""
    mean_words = tf.agg((F.sum("tf") / F.count_distinct(topic)).alias("a")).scalar()
    total = F.sum("tf").over(Window.partitionBy("term"))
    return tf.withColumn("_f", total).select(
        topic, "term", "tf", (F.ln(F.lit(1.0) + mean_words / F.col("_f"))).alias("idf")
    ).withColumn("score", F.col("tf") * F.col("idf"))


def top_terms(scores: DataFrame, topic: str, n: int) -> DataFrame:
    """N best terms per topic, ties by term."""
    return top_k_per_group(scores, [topic], [F.desc(F.round("score", 9)), F.asc("term")], n)


def topic_words(top: DataFrame, topic: str, rank: str = "rank") -> DataFrame:
    """(topic, words): at most n words per topic, in rank order."""
    return top.groupBy(topic).agg(F.sort_array(F.collect_list(F.struct(rank, "term"))).alias("_w")).select(
        topic, F.transform("_w", lambda s: s["term"]).alias("words"))


def topic_signature(words: Column, n: int = 8) -> Column:
    """First n words as text."""
    return F.array_join(F.slice(words, 1, n), ", ")


def auto_label(topic: Column, words: Column, overrides: Mapping[int, str] | None = None) -> Column:
    """T16: "id: w1, w2, w3, w4", or the caller's name."""
    auto = F.concat(topic.cast("string"), F.lit(": "), topic_signature(words, 4))
    return F.coalesce(lookup(topic, overrides), auto) if overrides else auto


def topic_table(df: DataFrame, topic: str, words: DataFrame, n: int = 10,
                overrides: Mapping | None = None) -> DataFrame:
    """Size, share, keywords and label per topic, largest first."""
    sizes = df.groupBy(topic).agg(F.count(F.lit(1)).alias("count"))
    total = df.agg(F.count(F.lit(1))).scalar()
    t = sizes.join(words, topic, "left")
    return t.select(
        topic, "count", F.round(F.col("count") * 100.0 / total, 2).alias("pct"),
        topic_signature(F.col("words"), n).alias("keywords"),
        auto_label(F.col(topic), F.col("words"), overrides).alias("label"),
    ).orderBy(F.desc("count"), topic)


def topic_diversity(top: DataFrame, topic: str, n: int) -> DataFrame:
    """Distinct top words over topics times n."""
    return top.agg(
        (F.count_distinct("term").cast("double") / (F.count_distinct(topic) * n)).alias("diversity"))


def topic_overlap(a: DataFrame, b: DataFrame, a_id: str, b_id: str) -> DataFrame:
    """Best partner by Jaccard of the top-word sets; topics are paired through shared
    words, so only overlapping pairs exist. No shared word: NULL partner, 0."""
    na = a.groupBy(a_id).agg(F.count(F.lit(1)).alias("_na"))
    nb = b.groupBy(b_id).agg(F.count(F.lit(1)).alias("_nb"))
    shared = a.select(a_id, "term").join(b.select(b_id, "term"), "term").groupBy(a_id, b_id).agg(
        F.count(F.lit(1)).alias("shared"))
    j = shared.join(na, a_id).join(nb, b_id).withColumn(
        "jaccard", F.col("shared") / (F.col("_na") + F.col("_nb") - F.col("shared")))
    best = top_k_per_group(j, [a_id], [F.desc("jaccard"), F.asc(b_id)], 1, "_r").select(
        a_id, b_id, "shared", "jaccard")
    return na.select(a_id).join(best, a_id, "left").withColumns(
        {"shared": F.coalesce("shared", F.lit(0).cast("long")), "jaccard": F.coalesce("jaccard", F.lit(0.0))})


# --- merging topics ---------------------------------------------------------------
def reduce_topics(df: DataFrame, topic: str, tokens: Column, k: int, name: str = "topic_reduced") -> DataFrame:
    """T4: merge down to k topics and re-label the rows; other rows keep their value.

    In a round the smallest topics, as many as are too many but at most half of all, each join
    the most similar of the others by class-based TF-IDF (ties to the smaller id; the largest topic where none
    shares a word). A round's merges do not depend on each other; the next one weighs the merged topics' words
    anew. Partners are found by blocks (``similar.top_matches``), so no table of topic pairs is made and
    the number of topics has no limit; rounds grow with the logarithm of it.
    """
    real = F.col(topic) >= 0 if isinstance(df.schema[topic].dataType, NumericType) else F.col(topic).isNotNull()
    tf = cut_lineage(class_terms(df.filter(real), topic, tokens))
    ids = cut_lineage(tf.select("term").distinct().withColumn("_tid", F.monotonically_increasing_id()))
    owners = cut_lineage(df.filter(real).groupBy(topic).agg(F.count(F.lit(1)).alias("n")).withColumn("_owner", F.col(topic)))
    left = owners.count()
    while left > k:
        merged = min(left - k, left // 2)
        live = owners.groupBy("_owner").agg(F.sum("n").alias("n"))
        ranked = cut_lineage(dense_index(live.withColumn("_o", F.struct("n", "_owner")), "_o", "_r"))
        largest = ranked.orderBy(F.desc("n"), "_owner").first()["_owner"]
        words = tf.join(owners.select(topic, "_owner"), topic).groupBy("_owner", "term").agg(F.sum("tf").alias("tf"))
        weights = ctfidf(words, "_owner").join(ids, "term").select("_owner", "_tid", F.col("score").alias("_w"))
        rows = cut_lineage(unit_rows(weights, "_owner"))
        small = ranked.filter(F.col("_r") < merged).select("_owner")
        into = top_matches(rows.join(small, "_owner", "left_anti").withColumnRenamed("_owner", "_into"), "_into",
                           rows.join(small, "_owner"), "_owner", 1)
        moved = small.join(into, "_owner", "left").select(
            F.col("_owner").alias("_from"), F.coalesce("_into", F.lit(largest)).alias("_into"))
        owners = cut_lineage(owners.join(moved, F.col("_owner") == F.col("_from"), "left").select(
            topic, "n", F.coalesce("_into", "_owner").alias("_owner")))
        left -= merged
    to = owners.withColumnRenamed("_owner", "_to")
    return lookup_by_weight(df, to, [topic], "n").withColumn(name, F.coalesce("_to", topic)).drop("n", "_to")


# --- vectors ------------------------------------------------------------------------
def topic_centroids(df: DataFrame, topic: str, vec: str) -> DataFrame:
    """(topic, centroid, n); one running mean per topic and task."""
    v = array_to_vector(F.col(vec).cast("array<double>"))
    return df.filter(F.col(topic) >= 0).groupBy(topic).agg(
        Summarizer.mean(v).alias("_m"), F.count(F.lit(1)).alias("n")
    ).select(topic, vector_to_array("_m").alias("centroid"), "n")


def own_similarity(df: DataFrame, topic: str, vec: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Adds the cosine to the row's own centroid; large topics get theirs by broadcast."""
    cent = topic_centroids(df, topic, vec)
    rows = df.filter(F.col(topic) >= 0)
    return lookup_by_weight(rows, cent, [topic], "n", hot_rows).withColumn(
        "score", V.cosine(F.col(vec), F.col("centroid")))


def representative_docs(df: DataFrame, key: str, topic: str, vec: str, n: int = 5) -> DataFrame:
    """Nearest to the own centroid; a topic with fewer rows returns all of them."""
    s = own_similarity(df, topic, vec).select(key, topic, "score")
    return top_k_per_group(s, [topic], [F.desc(F.round("score", 9)), F.asc(key)], n)


def representative_by_prob(df: DataFrame, key: str, probs: str, text: str, n: int = 5,
                           chars: int = 300) -> DataFrame:
    """For every topic the rows with the largest probability, with rank and snippet."""
    from ..functions.cleaning import snippet
    long = df.select(key, F.posexplode(probs).alias("topic", "p"))
    top = top_k_per_group(long, ["topic"], [F.desc("p"), F.asc(key)], n)
    back = top.join(df.select(key, F.col(text).alias("_t")), key)
    return back.select("topic", "rank", key, F.round("p", 4).alias("score"), snippet(F.col("_t"), chars).alias("snippet"))


def cohesion_separation(df: DataFrame, topic: str, vec: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Mean cosine to the own centroid (mean over topics) and 1 - mean cosine between
    centroids. The pair mean comes from the length of the summed unit centroids, so no
    pairs are built. NULL below two topics."""
    sims = own_similarity(df, topic, vec, hot_rows).groupBy(topic).agg(F.avg("score").alias("s"))
    coh = sims.agg(F.when(F.count(F.lit(1)) >= 2, F.avg("s")).alias("cohesion"), F.count(F.lit(1)).alias("topics"))
    cent = topic_centroids(df, topic, vec)
    unit = cent.select(array_to_vector(
        F.transform("centroid", lambda x: x / V.norm(F.col("centroid")))).alias("u"))
    k = F.count(F.lit(1))
    tot = unit.agg(vector_to_array(Summarizer.sum(F.col("u"))).alias("s"), k.alias("k"))
    sep = tot.select(
        F.when(F.col("k") >= 2,
               1 - (V.dot(F.col("s"), F.col("s")) - F.col("k")) / (F.col("k") * (F.col("k") - 1))).alias("separation"))
    return coh.withColumn("separation", sep.scalar())


def silhouette(df: DataFrame, topic: str, vec: str) -> float | None:
    """Mean cosine silhouette in closed form (per-cluster sums, no pairs)."""
    rows = df.filter(F.col(topic) >= 0).select(
        array_to_vector(F.col(vec).cast("array<double>")).alias("features"),
        F.col(topic).cast("double").alias("prediction"))
    if len(rows.select("prediction").distinct().limit(2).collect()) < 2:
        return None
    return ClusteringEvaluator(distanceMeasure="cosine").evaluate(rows)


# --- probabilities ---------------------------------------------------------------------
def doc_concentration(df: DataFrame, probs: str, floor: float = 0.01) -> DataFrame:
    """Mean largest probability and mean number of topics at or above the floor."""
    return df.agg(
        F.avg(F.array_max(probs)).alias("doc_concentration"),
        F.avg(F.size(F.filter(probs, lambda p: p >= floor))).alias("doc_density"))


def topic_term_probs(tf: DataFrame, topic: str) -> DataFrame:
    """(topic, term, p): each topic's term distribution, aligned by term."""
    total = tf.groupBy(topic).agg(F.sum("tf").alias("_n"), F.count(F.lit(1)).alias("_rows"))
    j = lookup_by_weight(tf, total, [topic], "_rows")
    return j.select(topic, "term", (F.col("tf") / F.col("_n")).alias("p"))


def separation_jsd(phi: DataFrame, topic: str, eps: float = 1e-12) -> DataFrame:
    """Mean Jensen-Shannon divergence over topic pairs, natural log.

    Summed term by term: a term's row holds its at most K non-zero probabilities; pairs
    are folded inside the row and absent topics enter in closed form.
    """
    def half(p, m):
        return F.lit(0.5) * p * F.ln((p + F.lit(eps)) / (m + F.lit(eps)))

    def pair(p, q):
        m = F.lit(0.5) * (p + q)
        return half(p, m) + half(q, m)

    k = phi.agg(F.count_distinct(topic)).scalar()
    row = phi.groupBy("term").agg(F.sort_array(F.collect_list("p")).alias("ps")).withColumn("k", k)
    add = lambda acc, v: acc + v
    inner = F.aggregate(
        F.transform("ps", lambda p, i: F.aggregate(
            F.slice("ps", i + 2, F.size("ps")), F.lit(0.0), lambda acc, q: acc + pair(p, q))),
        F.lit(0.0), add)
    alone = F.aggregate("ps", F.lit(0.0), lambda acc, p: acc + half(p, F.lit(0.5) * p))
    s = row.select((inner + (F.col("k") - F.size("ps")) * alone).alias("s"), "k")
    return s.agg(F.try_divide(F.sum("s"), F.max("k") * (F.max("k") - 1) / 2).alias("topic_separation_jsd"))


def gram(df: DataFrame, vec: str) -> DataFrame:
    """(i, j, g) = sum of outer products; one small matrix per task, then summed."""
    def fold(batches):
        acc = None
        for pdf in batches:
            if len(pdf):
                m = np.vstack(pdf.iloc[:, 0].to_numpy())
                acc = m.T @ m if acc is None else acc + m.T @ m
        if acc is not None:
            i, j = np.indices(acc.shape)
            yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "g": acc.ravel()})
    parts = df.select(F.col(vec).cast("array<double>")).mapInPandas(fold, "i int, j int, g double")
    return parts.groupBy("i", "j").agg(F.sum("g").alias("g"))


def mv_r2(terms: DataFrame, theta: DataFrame, phi: DataFrame, key: str, k: int) -> DataFrame:
    """1 - SSE/SST of row-normalised counts against theta x phi.

    terms (key, term, p), theta (key, theta: array of k), phi (term, phi: array of k).
    SSE = |Y|^2 - 2<Y, theta phi> + <theta'theta, phi phi'>, so no documents x terms
    matrix exists: one pass over the non-zero terms and two k x k matrices.
    """
    n = theta.agg(F.count(F.lit(1))).scalar()
    j = terms.join(theta, key)
    per_term = j.groupBy("term").agg(
        F.sum("p").alias("sp"), F.sum(F.col("p") * F.col("p")).alias("sp2"),
        F.array(*[F.sum(F.col("p") * F.get("theta", F.lit(i))) for i in range(k)]).alias("a"))
    zero = F.array(*[F.lit(0.0)] * k)
    lin = per_term.join(phi, "term", "left").agg(
        F.sum("sp2").alias("y2"), F.sum(F.col("sp") * F.col("sp")).alias("s2"),
        F.sum(V.dot(F.col("a"), F.coalesce("phi", zero))).alias("cross"))
    quad = gram(theta, "theta").withColumnRenamed("g", "g1").join(
        gram(phi, "phi"), ["i", "j"]).agg(F.sum(F.col("g1") * F.col("g")).alias("quad"))
    both = lin.withColumns({"quad": quad.scalar(), "n": n})
    sse = F.col("y2") - 2 * F.col("cross") + F.col("quad")
    sst = F.col("y2") - F.col("s2") / F.col("n")
    return both.select(sse.alias("sse"), sst.alias("sst"), F.when(sst > 0, 1 - sse / sst).alias("mv_r2"))


def doc_ambiguity(df: DataFrame, key: str, probs: str, weak: float = 0.20, diffuse: float = 0.70) -> DataFrame:
    """Probability, normalised entropy and the three flags per row."""
    p, e = F.array_max(probs), V.entropy(F.col(probs))
    return df.select(
        key, V.argmax(F.col(probs)).alias("topic"), p.alias("prob"), e.alias("entropy"),
        (p < weak).alias("weak"), (e >= diffuse).alias("high_entropy"), ((p < weak) | (e >= diffuse)).alias("ambiguous"))


def ambiguity_counts(df: DataFrame) -> DataFrame:
    """Totals of the flags, as counts and percentages."""
    n = F.count(F.lit(1))
    out = [n.alias("total")]
    for c in ("weak", "high_entropy", "ambiguous"):
        out += [F.count_if(F.col(c)).alias(c), (F.count_if(F.col(c)) * 100.0 / n).alias(f"{c}_pct")]
    return df.agg(*out)


def topic_clarity(df: DataFrame, topic: str, prob: str, topics: DataFrame, low: float = 0.35) -> DataFrame:
    """Size, exact median probability and percentage below ``low``; empty topics stay."""
    base = df.groupBy(topic).agg(
        F.count(F.lit(1)).alias("doc_count"), (F.count_if(F.col(prob) < low) * 100.0 / F.count(F.lit(1))).alias("low_pct"))
    med = exact_quantiles(df, prob, {"median_prob": 0.5}, [topic])
    out = null_safe_join(null_safe_join(topics.select(topic), base, [topic], "left"), med, [topic], "left")
    return out.select(
        topic, F.coalesce("doc_count", F.lit(0).cast("long")).alias("doc_count"),
        F.round("median_prob", 3).alias("median_prob"), F.round("low_pct", 1).alias("low_pct"))


# --- names and group comparison ----------------------------------------------------------
def phrase_names(df: DataFrame, key: str, topic: str, tokens: str, fallback: DataFrame | None = None,
                 min_df: int = 2, max_df: float = 0.8, keep: int = 2) -> DataFrame:
    """Most frequent trigrams of a topic's rows, else bigrams, else its top terms.

    A phrase must occur in min_df rows and at most max_df of the topic's rows; ties go to
    the alphabetically later phrase.
    """
    per_doc = term_counts(df, [key, topic], ngrams(F.col(tokens), 2, 3))
    ph = per_doc.groupBy(topic, "term").agg(F.sum("tf").alias("cf"), F.count(F.lit(1)).alias("df"))
    sizes = df.groupBy(topic).agg(F.count(F.lit(1)).alias("_n"))
    ok = lookup_by_weight(ph, sizes.withColumn("_w", F.col("_n")), [topic], "_w").filter(
        (F.col("df") >= min_df) & (F.col("df") <= F.col("_n") * max_df))
    ok = ok.withColumn("n", F.size(F.split("term", " ")))
    top = top_k_per_group(ok, [topic], [F.desc("n"), F.desc("cf"), F.desc("term")], keep)
    best_n = F.max("n").over(Window.partitionBy(topic))
    top = top.withColumn("_best", best_n).filter(F.col("n") == F.col("_best"))
    names = top.select(topic, "rank", "term", nice_title(F.col("term")).alias("phrase"), "cf", "df")
    if fallback is None:
        return names
    rest = fallback.join(names.select(topic).distinct(), topic, "left_anti")
    lost = F.lit(None).cast("long")
    return names.unionByName(rest.select(
        topic, F.lit(1).alias("rank"), F.array_join(F.slice("words", 1, 3), " ").alias("term"),
        nice_title(F.array_join(F.slice("words", 1, 3), " ")).alias("phrase"), lost.alias("cf"), lost.alias("df")))


def topic_summary(sizes: DataFrame, words: DataFrame, reps: DataFrame, names: DataFrame, topic: str = "topic",
                  n_words: int = 15) -> DataFrame:
    """One row per topic with name, size, terms and two representative rows."""
    wide = reps.groupBy(topic).agg(*[
        F.max(F.when(F.col("rank") == r, F.col(c))).alias(f"rep{r}_{c}")
        for r in (1, 2) for c in ("doc_id", "score", "snippet")])
    out = words.join(sizes, topic, "left").join(wide, topic, "left").join(names, topic, "left")
    return out.select(
        topic, F.coalesce("topic_name", F.concat(F.lit("Topic "), F.col(topic))).alias("topic_name"),
        F.coalesce("count", F.lit(0).cast("long")).alias("doc_count"),
        topic_signature(F.col("words"), n_words).alias("top_terms"),
        *[f"rep{r}_{c}" for r in (1, 2) for c in ("doc_id", "score", "snippet")])


def group_topic_share(df: DataFrame, topic: str, flag: Column) -> DataFrame:
    """Share of the group's rows and of the other rows per topic."""
    tot = df.agg(F.struct(
        F.greatest(F.count_if(flag), F.lit(1)).alias("g"),
        F.greatest(F.count_if(~F.coalesce(flag, F.lit(False))), F.lit(1)).alias("r"),
        F.count(F.lit(1)).alias("n"))).scalar()
    return outer_counts(df, topic, flag).withColumns({
        "group_share": F.col("in_group") / tot["g"], "rest_share": F.col("in_rest") / tot["r"],
        "overall_share": F.col("total") / tot["n"]})


def topic_lift(shares: DataFrame) -> DataFrame:
    """Group share over overall share with its bucket."""
    lift = F.try_divide("group_share", "overall_share")
    return shares.withColumn("lift", lift).withColumn("focus", focus_bucket(F.col("lift")))
