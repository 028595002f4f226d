"""Text builders (X1-X4, X6, X9, X10, X12), all JVM side."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K
from .cleaning import strip

# fixed values: token patterns
WORD_PATTERN = r"[\p{L}\p{M}\p{Nd}_]{2,}"
LABEL_TOKEN = r"(?U)\b[a-z0-9][a-z0-9-]+\b"
METRIC_WORD = r"(?U)\b[a-zA-Z0-9-]+\b"
ALPHA_RUN = r"[\p{L}\p{M}_]+"
PUNCTUATION = ".,;:!?()[]{}\"'/"


def _canonical_folds() -> tuple[str, str]:
    """One-to-one accent folds, generated from the Unicode canonical decompositions."""
    src, dst = [], []
    for cp in range(0xC0, min(0x2000, sys.maxunicode)):
        ch = chr(cp)
        base = "".join(x for x in unicodedata.normalize("NFD", ch) if unicodedata.category(x) != "Mn")
        if base != ch and len(base) == 1:
            src.append(ch)
            dst.append(base)
    return "".join(src), "".join(dst)


_FOLD_FROM, _FOLD_TO = _canonical_folds()


def fold_accents(c: Column) -> Column:
    """Drop accents: composed letters by translate, loose marks by pattern."""
    return F.regexp_replace(F.translate(c, _FOLD_FROM, _FOLD_TO), r"\p{Mn}", "")


def concat_fields(cols: Sequence[Column], sep: str = " ") -> Column:
    """NULL counts as '' and keeps its separator."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(F.coalesce(c.cast("string"), F.lit("")))
    return F.concat(*parts)


def row_to_text(cols: Sequence[Column], skip_blank: bool = False, sep: str = " | ") -> Column:
    """NULL fields skipped; ``skip_blank`` also drops white space."""
    cast = [c.cast("string") for c in cols]
    if skip_blank:
        cast = [F.when(strip(c) != "", c) for c in cast]
    return F.concat_ws(sep, *cast)


def word_count(c: Column) -> Column:
    """White-space separated tokens."""
    return F.when(c.isNotNull(), F.regexp_count(c, F.lit(r"(?U)\S+")))


def light_preclean(c: Column, phrases: Sequence[str] = tuple(K.PRECLEAN_PHRASES)) -> Column:
    """Dashes first, then URLs, e-mails, case, stock phrases, spaces."""
    t = F.coalesce(c, F.lit(""))
    t = F.regexp_replace(t, r"[-–—]+", " ")
    t = F.regexp_replace(t, r"(?U)https?://\S+|www\.\S+", " ")
    t = F.regexp_replace(t, r"(?U)\b[\w\.-]+@[\w\.-]+\.\w+\b", " ")
    t = strip(F.regexp_replace(t, r"(?U)\s+", " "))
    t = F.lower(t)
    for p in phrases:
        t = F.regexp_replace(t, "(?iU)" + p, " ")
    return strip(F.regexp_replace(t, r"(?U)\s+", " "))


def label_tokens(c: Column) -> Column:
    """Distinct lower-case tokens of at least two characters."""
    return F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit(LABEL_TOKEN), 0))


def word_tokens(c: Column, stop: Sequence[str] = ()) -> Column:
    """Word runs of two characters or more, lower case, in order."""
    toks = F.regexp_extract_all(F.lower(c), F.lit(WORD_PATTERN), 0)
    return drop_words(toks, stop) if stop else toks


def drop_words(tokens: Column, stop: Sequence[str]) -> Column:
    listed = sorted(set(stop))
    return F.filter(tokens, lambda w: ~w.isin(*listed))


def simple_tokens(c: Column, stop: Sequence[str] = (), lo: int = 2, hi: int = 30) -> Column:
    """Lower case, accents folded, alphabetic runs of lo..hi characters."""
    runs = F.regexp_extract_all(fold_accents(F.lower(c)), F.lit(ALPHA_RUN), 0)
    toks = F.filter(runs, lambda w: F.length(w).between(lo, hi) & ~w.startswith("_"))
    return drop_words(toks, stop) if stop else toks


def ngrams(tokens: Column, lo: int, hi: int) -> Column:
    """All n-grams with lo <= n <= hi, in order of n then position.

    Longer grams extend shorter ones by zipping with the shifted tokens, which is
    linear; pass a column, not an expression, for long token lists.
    """
    grams, parts = tokens, []
    for n in range(1, hi + 1):
        if n > 1:
            left = F.greatest(F.size(tokens) - n + 1, F.lit(0))
            grams = F.zip_with(F.slice(grams, 1, left), F.slice(tokens, n, left),
                               lambda a, b: F.concat(a, F.lit(" "), b))
        if n >= lo:
            parts.append(grams)
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def text_metrics(c: Column) -> dict[str, Column]:
    """The seven audit measures, by name."""
    s = F.coalesce(c, F.lit(""))
    words = F.regexp_extract_all(s, F.lit(METRIC_WORD), 0)
    n = F.size(words)
    uniq = F.size(F.array_distinct(F.transform(words, F.lower)))
    chars = F.length(s)
    punct = chars - F.length(F.translate(s, PUNCTUATION, ""))
    boiler = s.rlike("(?iU)" + "|".join(K.BOILERPLATE_PHRASES))
    return {
        "word_count": n,
        "uniq_tokens": uniq,
        "lex_diversity": uniq / F.greatest(n, F.lit(1)),
        "char_len": chars,
        "punct_ratio": punct / F.greatest(chars, F.lit(1)),
        "digit_count": F.regexp_count(s, F.lit(r"\p{Nd}")),
        "has_boilerplate": boiler,
    }
