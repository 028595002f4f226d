"""Array-vector helpers. Pairwise maths on two array columns stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0), lambda acc, v: acc + v,
    )


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v.cast("double"))


def to_probabilities(a: Column) -> Column:
    """Squared entries divided by their sum: a valid probability vector."""
    sq = F.transform(a, lambda x: x.cast("double") * x.cast("double"))
    s = F.aggregate(sq, F.lit(0.0), lambda acc, v: acc + v)
    return F.transform(sq, lambda v: F.try_divide(v, s))


def argmax(a: Column) -> Column:
    """First position (0-based) of the largest entry."""
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def entropy(gamma: Column, eps: float = 1e-12) -> Column:
    """Normalised to 0..1 by ln K."""
    s = F.aggregate(gamma, F.lit(0.0), lambda acc, p: acc + p * F.ln(p + F.lit(eps)))
    return F.try_divide(-s, F.ln(F.size(gamma).cast("double")))
