"""Score bands and complexity points."""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .cleaning import lookup


def complexity_band(score: Column) -> Column:
    """Q5: scores of at most 1 are read as fractions."""
    pct = F.when(score <= 1, score * 100).otherwise(score)
    return (
        F.when(pct.isNull(), "No model score available.")
        .when(pct < 40, "Low").when(pct < 70, "Medium").otherwise("High")
    )


def proposal_band(p: Column) -> Column:
    """Q6."""
    return (
        F.when(p.isNull(), "Insufficient Inputs")
        .when(p >= 66, "High Complexity").when(p >= 40, "Medium Complexity").otherwise("Low Complexity")
    )


# Letters that an ASCII letter matches when case does not count.
SAME_LETTER = {"\u017f": "s", "\u0131": "i", "\u0130": "i", "\u212a": "k"}
PLAIN = re.compile(r"(\\b)?([A-Za-z0-9 ]+)(\\b|\([^()]*\)\??)?")


def _hit(text: Column, pattern: str) -> Column:
    """Whether the pattern, case aside, occurs in a text without capitals. The words it begins with are looked for
    first: a byte search is many times faster than the pattern, which then decides only where they are."""
    known, exact = PLAIN.fullmatch(pattern), text.rlike("(?iU)" + pattern)
    if not known:
        return exact
    begun = text.contains(known[2].lower())
    return begun if not known[1] and (not known[3] or known[3].endswith(")?")) else begun & exact


def keyword_level(text: Column, patterns: Mapping[int, list[str]] | None = None) -> Column:
    """Highest level with a hit, searched unanchored."""
    patterns = patterns or K.LEVEL_PATTERNS

    def level(t):
        out = None
        for k in sorted(patterns, reverse=True):
            hit = reduce(or_, [_hit(t, p) for p in patterns[k]])
            out = F.when(hit, k) if out is None else out.when(hit, k)
        return out.otherwise(2)

    low = F.lower(text)
    for other, letter in SAME_LETTER.items():
        low = F.replace(low, F.lit(other), F.lit(letter))
    # As an element the lower-cased text is made once, not once per pattern.
    return F.get(F.transform(F.array(low), level), F.lit(0))


def complexity_score(topic_id: Column, text: Column, area: Column) -> Column:
    """Topic, narrative and area points (default 2 each) out of 15, as percent."""
    points = (
        F.coalesce(lookup(topic_id.cast("int"), K.TOPIC_COMPLEXITY), F.lit(2))
        + keyword_level(text)
        + F.coalesce(lookup(area, K.AREA_COMPLEXITY), F.lit(2))
    )
    return points / F.lit(15.0) * 100


def focus_bucket(lift: Column, high: float = 1.5, low: float = 0.75) -> Column:
    """NULL lift is "similar"."""
    return F.when(lift >= high, "more in group").when(lift <= low, "more in rest").otherwise("similar")
