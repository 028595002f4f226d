"""Embedding and the sweep over numbers of topics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import IDF, PCA, HashingTF, Normalizer, RegexTokenizer, StopWordsRemover
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from . import topics as T


def embedding_pipeline(text: str = "text", features: int = 512, dims: int = 32,
                       stop: Sequence[str] = tuple(K.ENGLISH_STOP)) -> Pipeline:
    """Hashed TF-IDF, projected and scaled to unit length. ``features`` squared doubles
    reach the driver in the projection fit, so it stays small."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="_tok", pattern=r"[\p{L}\p{M}\p{Nd}_]{2,}", gaps=False),
        StopWordsRemover(inputCol="_tok", outputCol="_kept", stopWords=list(stop)),
        HashingTF(inputCol="_kept", outputCol="_tf", numFeatures=features),
        IDF(inputCol="_tf", outputCol="_idf"),
        PCA(inputCol="_idf", outputCol="_pca", k=dims),
        Normalizer(inputCol="_pca", outputCol="embedding_vector", p=2.0),
    ])


def embed_documents(df: DataFrame, text: str = "text", features: int = 512, dims: int = 32) -> DataFrame:
    """Adds ``embedding``; pass vectors of your own to the other operators instead if
    you have a better encoder."""
    stages = embedding_pipeline(text, features, dims).getStages()
    head = PipelineModel(stages[:3])        # nothing to fit
    counted = head.transform(df).select("_tf").persist(StorageLevel.MEMORY_AND_DISK)     # the fits read it, not the texts
    try:
        model = PipelineModel([head, *Pipeline(stages=stages[3:]).fit(counted).stages])
    finally:
        counted.unpersist()
    return model.transform(df).withColumn("embedding", vector_to_array("embedding_vector")).drop(
        "_tok", "_kept", "_tf", "_idf", "_pca", "embedding_vector")


def evaluate_variant(df: DataFrame, topic: str, vec: str, tag: str, tokens: Column | None = None) -> dict:
    """One row of quality measures for a labelling; with ``tokens``, also the share of distinct words
    among the ten best of each topic."""
    from .aggregates import topic_health
    h = topic_health(df, topic).first()
    c = T.cohesion_separation(df, topic, vec).first()
    s = T.silhouette(df, topic, vec)
    d = None
    if tokens is not None:
        d = T.topic_diversity(T.top_terms(T.ctfidf(T.class_terms(df, topic, tokens), topic), topic, 10), topic, 10).first()[0]
    r = lambda x: None if x is None else round(float(x), 4)
    return {"variant": tag, "topics": h["n_topics"], "outlier_rate": r(h["outlier_rate"]), "tiny_topic_share": r(h["tiny_topic_share"]),
            "diversity": r(d), "cohesion": r(c["cohesion"]), "separation": r(c["separation"]), "silhouette": r(s)}


def k_sweep(df: DataFrame, vec: str, ks: Sequence[int], seed: int = 42, tokens: Column | None = None) -> DataFrame:
    """One fit and one row of measures per k over a persisted input, its words cut once."""
    words = {} if tokens is None else {"_words": tokens}
    rows, src = [], df.select(vec, *[c.alias(n) for n, c in {
        "features": array_to_vector(F.col(vec).cast("array<double>")), **words}.items()]).persist()
    try:
        for k in ks:
            model = KMeans(k=k, seed=seed, distanceMeasure="cosine", predictionCol="_topic").fit(src)
            rows.append(evaluate_variant(model.transform(src), "_topic", vec, f"K={k}", F.col("_words") if words else None))
    finally:
        src.unpersist()
    return df.sparkSession.createDataFrame(
        rows, "variant string, topics long, outlier_rate double, tiny_topic_share double, diversity double, cohesion double, "
              "separation double, silhouette double")
