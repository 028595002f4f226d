"""LDA topics."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import SparkContext, StorageLevel
from pyspark.ml.clustering import LDAModel
from pyspark.ml.feature import PCA, CountVectorizerModel, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from ..functions import vectors as V
from . import coherence as C
from . import variational as U
from .textfeatures import doc_freq
from .variational import LDA
from .windows import one_hot, spread_probs


def bag_of_words(df: DataFrame, key: str, tokens: str, min_df: float = 5, max_df: float = 0.9,
                 keep_n: int = 50_000) -> tuple[CountVectorizerModel, DataFrame]:
    """Vocabulary (the keep_n terms of highest document frequency, on the driver) and
    (key, tokens, features)."""
    docs = doc_freq(df, F.col(tokens))       # combined where the texts lie; no row per text and term crosses the network
    n = df.agg(F.count(F.lit(1))).scalar()
    limit = lambda x: n * F.lit(x) if isinstance(x, float) else F.lit(x)
    kept = docs.filter((F.col("docs") >= limit(min_df)) & (F.col("docs") <= limit(max_df))).orderBy(
        F.desc("docs"), "word").limit(keep_n).select("word").toArrow().column(0).to_pylist()
    cv = _vectorizer(kept, tokens)
    return cv, cv.transform(df)


def _vectorizer(terms: Sequence[str], tokens: str) -> CountVectorizerModel:
    """``from_vocabulary`` sends one message per term; here all go in one, unless a term holds the separator."""
    if not terms or any("\n" in t for t in terms):
        return CountVectorizerModel.from_vocabulary(terms, inputCol=tokens, outputCol="features")
    jvm = SparkContext._active_spark_context._jvm
    sent = jvm.java.util.regex.Pattern.compile("\n").split("\n".join(terms), -1)
    return CountVectorizerModel._create_from_java_class(
        "org.apache.spark.ml.feature.CountVectorizerModel", sent)._set(inputCol=tokens, outputCol="features")


def df_limits(min_df: float, max_df: float) -> dict[str, float]:
    """Document-frequency limits for CountVectorizer, which reads 1.0 as "one document";
    as a share it means no upper limit, so it is left out."""
    out = {"minDF": float(min_df)}
    if not (isinstance(max_df, float) and max_df == 1.0):
        out["maxDF"] = float(max_df)
    return out


def stable_order(df: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Fixed partitions and order per partition, so a seed gives the same fit."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, key).sortWithinPartitions(key)


def fit_lda(bow: DataFrame, key: str, k: int, passes: int = 6, sample: float = 0.5, seed: int = 42) -> LDAModel:
    """Online variational fit; passes over the data = iterations x sample. The document
    prior is learned, the term prior stays fixed.

    Each task of each iteration hands on a whole table of topics and terms, so rows lie in a task per core, whatever
    the number of shuffle partitions, and are kept there as blocks: iterations neither read nor sort them again."""
    terms = bow.select("features").first()
    rows = bow.select(key, "features")
    cores = bow.sparkSession.sparkContext.defaultParallelism
    parts = min(cores, int(bow.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = U.packed(stable_order(rows, key, parts)).persist(StorageLevel.MEMORY_AND_DISK)
    lda = LDA(k, max(1, round(passes / sample)), sample, seed, terms[0].size if terms else 0,
              {"featuresCol": "features", "topicDistributionCol": "_gamma"})
    try:
        return lda.fit(rows)
    finally:
        rows.unpersist()


def doc_topics(model: LDAModel, bow: DataFrame, key: str, names: dict[int, str] | None = None) -> DataFrame:
    """(key, gamma, lda_topic, lda_topic_prob, lda_topic_name). A row without a known term gets the learned prior."""
    from ..functions.cleaning import lookup
    g = U.shares(model, bow, key)
    t = V.argmax(F.col("gamma"))
    fallback = F.concat(F.lit("Topic "), F.col("lda_topic").cast("string"))
    out = g.withColumns({"lda_topic": t, "lda_topic_prob": F.array_max("gamma")})
    return out.withColumn(
        "lda_topic_name", F.coalesce(lookup(F.col("lda_topic"), names), fallback) if names else fallback)


def topic_words(model: LDAModel, vocab: Sequence[str], n: int = 15) -> DataFrame:
    """(topic, words, weights); weights are shares of the topic."""
    spark = model.describeTopics(1).sparkSession
    d = model.describeTopics(n)
    terms = spark.createDataFrame([(i, w) for i, w in enumerate(vocab)], "idx int, term string")
    long = d.select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "z"))
    j = long.select("topic", "rank", F.col("z.termIndices").alias("idx"), F.col("z.termWeights").alias("w")).join(terms, "idx")
    return j.groupBy("topic").agg(F.sort_array(F.collect_list(F.struct("rank", "term", "w"))).alias("l")).select(
        "topic", F.transform("l", lambda s: s["term"]).alias("words"), F.transform("l", lambda s: s["w"]).alias("weights"))


def topic_terms(assign: DataFrame, words: DataFrame) -> DataFrame:
    """Sizes and shares joined with keywords and "word:weight" text, largest first."""
    total = assign.agg(F.count(F.lit(1))).scalar()
    sizes = assign.groupBy(F.col("lda_topic").alias("topic")).agg(F.count(F.lit(1)).alias("count"))
    pair = F.zip_with("words", "weights", lambda w, p: F.concat(w, F.lit(":"), F.format_number(p, 3)))
    return sizes.join(words, "topic", "left").select(
        "topic", "count", F.round(F.col("count") * 100.0 / total, 2).alias("pct"),
        F.array_join("words", ", ").alias("keywords"), F.array_join(pair, "; ").alias("top_words_weighted"),
    ).orderBy(F.desc("count"), "topic")


def log_perplexity(model: LDAModel, bow: DataFrame) -> float:
    """Per-word bound, nearer 0 is better."""
    return U.bound_per_word(model, bow)


def word_lists(model: LDAModel, vocab: Sequence[str], n: int = 20) -> dict[int, list[str]]:
    """At most k x n words on the driver."""
    return {r["topic"]: [vocab[i] for i in r["termIndices"]] for r in model.describeTopics(n).collect()}


def lda_grid(bow: DataFrame, key: str, tokens: str, vocab: Sequence[str], ks: Sequence[int], passes: int = 6,
             seed: int = 42, topn: int = 20) -> DataFrame:
    """(k, coh_c_v, log_perplexity), best coherence first, smaller k on ties."""
    rows, src = [], bow.select(key, tokens, "features").persist()
    try:
        for k in ks:
            m = fit_lda(src, key, k, passes, seed=seed)
            cv = C.coherence_cv(src, key, F.col(tokens), word_lists(m, vocab, topn)).agg(F.avg("c_v")).first()[0]
            rows.append((k, cv, log_perplexity(m, src)))
    finally:
        src.unpersist()
    return bow.sparkSession.createDataFrame(rows, "k int, coh_c_v double, log_perplexity double").orderBy(
        F.desc("coh_c_v"), "k")


def project_2d(df: DataFrame, key: str, vec: str) -> DataFrame:
    """First two principal components of the centred vectors; the largest loading of
    each component is made positive, which fixes the sign."""
    src = df.select(key, array_to_vector(F.col(vec).cast("array<double>")).alias("_v"))
    scaled = StandardScaler(inputCol="_v", outputCol="_c", withMean=True, withStd=False).fit(src).transform(src)
    model = PCA(k=2, inputCol="_c", outputCol="_p").fit(scaled)
    pc = model.pc.toArray()
    sign = [1.0 if abs(pc[:, j].max()) >= abs(pc[:, j].min()) else -1.0 for j in (0, 1)]
    a = vector_to_array("_p")
    return model.transform(scaled).select(
        key, (F.get(a, F.lit(0)) * sign[0]).alias("x"), (F.get(a, F.lit(1)) * sign[1]).alias("y"))


MOST_TOPICS = 1024      # rows of a table whose products of all rows fit on the driver


def project_topics(weights: DataFrame, topic: str, term: str, weight: str) -> DataFrame:
    """(topic, x, y), the first two principal components of a topic-term table, one row per
    topic and term; a term that a topic lacks counts 0, so columns are aligned by term.

    There are few topics and many terms: components come from the topics' products with each other, centred on both
    sides, so no table of term pairs is made. Products are summed as matrices where the terms lie. The
    largest coordinate of an axis is made positive. At most 1,024 topics.
    """
    ids = [r[0] for r in weights.select(topic).distinct().limit(MOST_TOPICS + 1).collect()]
    if len(ids) > MOST_TOPICS:
        raise ValueError(f"more than {MOST_TOPICS} topics")
    ids.sort()
    spark = weights.sparkSession
    at = spark.createDataFrame([(t, i) for i, t in enumerate(ids)], StructType(
        [weights.schema[topic], StructField("_at", IntegerType())]))
    rows = weights.join(F.broadcast(at), topic).groupBy(term).agg(
        F.collect_list(F.struct("_at", F.col(weight).cast("double").alias("w"))).alias("r")).select("r._at", "r.w")

    def fold(batches):
        acc = np.zeros((len(ids), len(ids)))
        for b in batches:
            n = b.column(0).value_lengths().to_numpy(zero_copy_only=False)
            m = np.zeros((b.num_rows, len(ids)))
            np.add.at(m, (np.repeat(np.arange(b.num_rows), n), b.column(0).flatten().to_numpy()), b.column(1).flatten().to_numpy())
            acc += m.T @ m
        i, j = (x.ravel().astype(np.int32) for x in np.indices(acc.shape))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(acc.ravel())], names=["i", "j", "g"])

    g = np.zeros((len(ids), len(ids)))
    for r in rows.mapInArrow(fold, "i int, j int, g double").groupBy("i", "j").agg(F.sum("g").alias("g")).collect():
        g[r.i, r.j] = r.g
    centre = np.eye(len(ids)) - 1 / max(len(ids), 1)
    value, axis = np.linalg.eigh(centre @ g @ centre) if ids else (np.zeros(0), np.zeros((0, 0)))
    out = np.zeros((len(ids), 2))
    for k in range(min(2, len(ids))):
        x = axis[:, -1 - k] * np.sqrt(max(value[-1 - k], 0))
        out[:, k] = x * np.sign(x[np.abs(x).argmax()] or 1)
    return spark.createDataFrame([(t, *map(float, xy)) for t, xy in zip(ids, out, strict=True)], StructType(
        [weights.schema[topic], StructField("x", DoubleType()), StructField("y", DoubleType())]))


def topic_features(assign: DataFrame, key: str, k: int) -> DataFrame:
    """Id, one column per topic probability, one-hot of the dominant topic."""
    wide = spread_probs(assign.select(key, "gamma", "lda_topic"), "gamma", k)
    return one_hot(wide, "lda_topic", list(range(k)), "lda_dom_t", "_").drop("lda_topic")
