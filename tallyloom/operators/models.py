"""Text and numeric classifiers, proposal scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    IDF, CountVectorizer, CountVectorizerModel, ElementwiseProduct, NGram, Normalizer, RegexTokenizer, SQLTransformer, VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions.cleaning import lookup
from ..functions.scoring import proposal_band
from ..functions.text import fold_accents
from ..plans.ranges import exact_quantiles
from .lda import df_limits
from .linear import fit_logistic
from .metrics import class_weights


TASK_ROWS = 10_000      # training rows that one task holds at most
CORE_ROWS = 100         # and at least, while cores are idle


def fold_text(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("_folded", fold_accents(F.lower(F.coalesce(text, F.lit("")))))


def fit_text_classifier(df: DataFrame, text: str, label: str, binary: bool = False, min_df: float = 3,
                        max_df: float = 0.9, max_iter: int = 1000, same_rows: PipelineModel | None = None) -> PipelineModel:
    """M3, M4: words and bigrams, smoothed idf + 1, unit rows, balanced logistic regression
    with unit penalty. Every term inside the document-frequency limits is kept; vocabulary
    and coefficients live on the driver, as they must in any linear text model. ``max_iter``: passes over the rows.
    ``same_rows``: a model of another label of the same rows, whose terms and weights are taken."""
    rows = df.filter(F.col(label).isNotNull()).select(label, text)
    n = rows.count()
    # Rows are dealt out evenly, a hot text or label must not make a hot training task; a task per core, and
    # more of them where a task would hold too many rows.
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = max(-(-n // TASK_ROWS), min(cores, -(-n // CORE_ROWS)), 1)
    src = fold_text(rows.repartition(parts), text).select(label, "_folded").persist()
    weights = class_weights(src, label).select(label, F.col("weight").alias("class_weight"))    # a row per class
    if same_rows:
        head, weigh, unit = PipelineModel(same_rows.stages[:-3]), *same_rows.stages[-3:-1]
    else:
        head = Pipeline(stages=[
            RegexTokenizer(inputCol="_folded", outputCol="_uni", pattern=r"[\p{L}\p{M}\p{Nd}_]{2,}", gaps=False),
            NGram(n=2, inputCol="_uni", outputCol="_bi"),
            SQLTransformer(statement="SELECT *, concat(_uni, _bi) AS _terms FROM __THIS__"),
            CountVectorizer(inputCol="_terms", outputCol="_tf", vocabSize=2**31 - 1, **df_limits(min_df, max_df)),
        ]).fit(src)
    counted = head.transform(src).join(F.broadcast(weights), label).select(label, "class_weight", "_tf").persist()
    try:
        if not same_rows:
            idf = IDF(inputCol="_tf", outputCol="_idf").fit(counted)
            weigh = ElementwiseProduct(scalingVec=DenseVector(idf.idf.toArray() + 1.0), inputCol="_tf", outputCol="_tfidf")
            unit = Normalizer(inputCol="_tfidf", outputCol="features", p=2.0)
        model = fit_logistic(unit.transform(weigh.transform(counted)), label, "class_weight", "features",
                             1.0 / max(n, 1), binary, max_iter)
    finally:
        counted.unpersist()
        src.unpersist()
    return PipelineModel(head.stages + [weigh, unit, model])


def predict(model: PipelineModel, df: DataFrame, text: str | None = None, prefix: str = "m1") -> DataFrame:
    """M6: class, probability of that class in percent, class probabilities; one pass."""
    src = fold_text(df, text) if text else df
    out = model.transform(src)
    p = vector_to_array("probability")
    cls = F.col("prediction").cast("int")
    return out.select(*df.columns, cls.alias(f"{prefix}_class"), (F.get(p, cls) * 100).alias(f"{prefix}_confidence"),
                      p.alias(f"{prefix}_probs"))


def above_median(df: DataFrame, score: str, name: str = "label") -> DataFrame:
    """M5: 1 when the score is above the exact median."""
    med = exact_quantiles(df, score, {"m": 0.5}).scalar()
    return df.withColumn(name, (F.col(score) > med).cast("int"))


def numeric_features(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """M5: text coerced to numbers, anything else 0."""
    return df.withColumns({c: F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)) for c in columns})


def fit_numeric_classifier(df: DataFrame, columns: Sequence[str], label: str, max_iter: int = 1000) -> PipelineModel:
    """M5: scaled without centring, plain logistic regression. Equal rows are one weighted row, so a pass over
    few distinct values costs the same however many rows hold them."""
    src = df.select(*columns, label).groupBy(*columns, label).agg(F.count(F.lit(1)).cast("double").alias("_n")).persist()
    try:
        n, *means = src.agg(F.sum("_n"), *[F.sum(F.col(c) * F.col("_n")) / F.sum("_n") for c in columns]).first()
        n, means = n or 0, [m or 0.0 for m in means]
        off = src.agg(*[F.sum(F.col("_n") * (F.col(c) - F.lit(m)) ** 2) for c, m in zip(columns, means, strict=True)]).first()
        dev = [((o or 0.0) / max(n - 1, 1)) ** 0.5 for o in off]
        stages = [
            VectorAssembler(inputCols=list(columns), outputCol="_raw"),
            ElementwiseProduct(inputCol="_raw", outputCol="features", scalingVec=DenseVector(
                [1.0 / d if d else 0.0 for d in dev])),
            LogisticRegression(featuresCol="features", labelCol=label, weightCol="_n", standardization=False,
                               regParam=1.0 / max(n, 1), maxIter=max_iter, tol=1e-4),
        ]
        return Pipeline(stages=stages).fit(src)
    finally:
        src.unpersist()


def top_coefficients(model: PipelineModel, spark, n: int = 20) -> DataFrame:
    """The n largest and n smallest terms per class, from the fitted matrix."""
    terms = next(s for s in model.stages if isinstance(s, CountVectorizerModel)).vocabulary     # sent once, not per term
    lr = model.stages[-1]
    m = np.asarray(lr.coefficientMatrix.toArray())
    rows = []
    for c in range(m.shape[0]):
        order = np.argsort(-m[c], kind="stable")
        for side, idx in (("top", order[:n]), ("bottom", order[::-1][:n])):
            rows += [(c, side, i + 1, terms[j], float(m[c, j])) for i, j in enumerate(idx)]
    return spark.createDataFrame(rows, "class int, side string, rank int, term string, coefficient double")


# --- proposals ---------------------------------------------------------------------------
def novelty(impact: Column, complexity: Column, resourcing: Column) -> Column:
    """100 minus the largest confidence, a missing one counting as 0."""
    return F.lit(100.0) - F.greatest(impact, F.coalesce(complexity, F.lit(0.0)), resourcing)


def score_proposals(df: DataFrame, text: str, impact: PipelineModel, resourcing: PipelineModel,
                    complexity: PipelineModel, has_topic: str,
                    impact_names: Mapping[int, str] | None = None) -> DataFrame:
    """Three models over one frame; works on a stream as well. Complexity is only
    scored where a topic is given."""
    names = impact_names or K.IMPACT_CLASSES
    keep = df.columns
    s = predict(impact, df, text, "impact")
    s = predict(resourcing, s, text, "resourcing")
    s = predict(complexity, s, None, "complexity")
    pc = F.when(F.col(has_topic).isNotNull(), F.get(F.col("complexity_probs"), F.lit(1)) * 100)
    label = lookup(F.col("impact_class"), names)
    return s.select(
        *keep, label.alias("impact_label"), "impact_confidence", (label != "Neither").alias("high_impact_alert"),
        pc.alias("complexity_confidence"), proposal_band(pc).alias("complexity_label"),
        F.when(F.col("resourcing_class") == 1, "Contract").otherwise("In-House").alias("resourcing_label"),
        "resourcing_confidence",
        novelty(F.col("impact_confidence"), pc, F.col("resourcing_confidence")).alias("novelty"))


def with_cases(scored: DataFrame, key: Sequence[str], cases: DataFrame) -> DataFrame:
    """Scored proposals with their similar ``cases`` (``similar.as_list`` by a struct ``query`` of the
    key columns); a proposal that shares no term with any case has none."""
    flat = cases.select(*[F.col(f"query.{c}").alias(f"_{c}") for c in key], "cases")
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key]
    return scored.join(flat, on, "left").drop(*[f"_{c}" for c in key])
