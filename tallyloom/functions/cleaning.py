"""Categorical and text cleaners (N1-N22) as Column -> Column builders.

Nothing here needs a UDF: each cleaner is one CASE / regexp expression, so it
stays inside whole-stage codegen and can be pushed around by Catalyst.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as K

HYBRID = "Hybrid (Contract + In-house)"


def strip(c: Column) -> Column:
    """Trim every kind of white space; SQL trim() removes blanks only."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def literal_map(mapping: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def lookup(c: Column, mapping: Mapping) -> Column:
    """Literal dictionary lookup, NULL on a miss."""
    return F.element_at(literal_map(mapping), c)


def _has(c: Column, *words: str) -> Column:
    out = c.contains(words[0])
    for w in words[1:]:
        out = out | c.contains(w)
    return out


def _blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def clean_categorical(c: Column) -> Column:
    """Blanks to Unknown, N/A to Not applicable, "yes - ..." to Yes."""
    s = strip(c)
    yes_no = r"(?iU)^(yes|no)\s*[-–][^\n]*$"
    return (
        F.when(s.isNull() | s.isin("", "Nan", "nan", "NA"), "Unknown")
        .when(s.isin("N/A", "n/a"), "Not applicable")
        .when(s.rlike(yes_no), F.initcap(F.lower(F.regexp_extract(s, yes_no, 1))))
        .otherwise(s)
    )


def clean_text(c: Column) -> Column:
    """Trim; blank and textual NaN become NULL."""
    s = strip(c)
    return F.when(~s.isin("", "Nan", "nan"), s)


def _impact_lower(c: Column) -> Column:
    s = F.lower(strip(c))
    return F.when(~s.isin("", "nan"), s)


def normalize_impact(c: Column, policy: str = "regex") -> Column:
    """The impact answer under one of five named policies."""
    low = _impact_lower(c)
    named = F.coalesce(lookup(low, K.IMPACT_LABELS), low)
    too_new = low.isin(*K.TOO_NEW_ANSWERS)
    if policy == "simple":
        return (
            F.when(c == "Safety-Impacting", "Safety-impacting")
            .when(c == "Rights-Impacting\n", "Rights-impacting")
            .otherwise(c)
        )
    if policy == "grouped":
        return F.coalesce(F.when(too_new, "Too new to assess").otherwise(named), F.lit("Unknown"))
    if policy == "unknown":
        return F.coalesce(F.when(too_new, "Unknown").otherwise(named), F.lit("Unknown"))
    if policy == "lower":
        return named
    if policy == "regex":
        s = strip(c)
        s = F.regexp_replace(s, r"(?U)\s*[–—-]\s*", "-")
        s = strip(F.regexp_replace(s, r"(?U)\s+", " "))
        low = F.lower(s)
        return (
            F.when(F.lower(strip(c)) == "nan", F.lit(None).cast("string"))
            .when(low.rlike(r"(?U)^rights[-\s]?impacting$"), "Rights-impacting")
            .when(low.rlike(r"(?U)^safety[-\s]?impacting$"), "Safety-impacting")
            .when(low == "both", "Both")
            .when(low == "neither", "Neither")
            .when(low.startswith("no, use case is too new") | _has(low, "reassessed", "case-by-case"), "Neither")
            .otherwise(s)
        )
    raise ValueError(f"unknown policy {policy!r}")


def impact_code(c: Column) -> Column:
    """0 neither, 1 rights, 2 safety, 3 both, else NULL."""
    s = F.lower(c)
    rights, safety = s.contains("right"), s.contains("safety")
    return (
        F.when(s.contains("both") | (rights & safety), 3)
        .when(s.contains("neither"), 0)
        .when(rights, 1)
        .when(safety, 2)
    )


def normalize_resourcing(c: Column) -> Column:
    """Any mention of a contract wins, even "no contract"."""
    s = F.lower(strip(c))
    house = _has(s, "in-house", "in house")
    return (
        F.when(_blank(c), "Unknown")
        .when(_has(s, "contract", "external"),
              F.when(house | _has(s, "combination", "both"), "Both").otherwise("External Contracting"))
        .when(house, "In-House")
        .when(s.contains("neither"), "Neither")
        .otherwise("Unknown")
    )


def dev_bucket(c: Column) -> Column:
    """Contract / In-house / Hybrid / Unknown."""
    s = F.lower(strip(c))
    outside = _has(s, "contract", "external")
    return (
        F.when(_blank(c) | s.contains("data not reported by submitter"), "Unknown")
        .when(_has(s, "both", "combination"), HYBRID)
        .when(_has(s, "no contract", "in-house", "in house", "inhouse"),
              F.when(outside, HYBRID).otherwise("In-house"))
        .when(outside, "Contract")
        .otherwise("Unknown")
    )


def dev_method_simple(c: Column) -> Column:
    """Like dev_bucket, but unmatched answers are kept as lower case."""
    s = F.lower(strip(c))
    s = F.regexp_replace(s, r"[^\n]*contract[^\n]*", "Contract")
    s = F.regexp_replace(s, r"[^\n]*in[- ]?house[^\n]*", "In-house")
    return F.when(s.isNull() | s.isin("", "nan"), "Unknown").otherwise(s)


def recode(c: Column, mapping: Mapping[str, str]) -> Column:
    """Literal replacement, everything else kept."""
    return F.coalesce(lookup(c, mapping), c)


def map_dev_type(c: Column) -> Column:
    """Contract, in-house or NULL."""
    s = F.lower(c)
    return F.when(s.contains("contract"), "contract").when(_has(s, "in-house", "in house"), "in-house")


def normalize_pii(c: Column) -> Column:
    """Yes / No / Unknown."""
    s = F.lower(strip(c))
    return F.when(s.isin("yes", "y", "true"), "Yes").when(s.isin("no", "n", "false"), "No").otherwise("Unknown")


def normalize_demographics(c: Column) -> Column:
    """Anything but an explicit "none" counts as Yes."""
    s = F.lower(strip(c))
    return F.when(_blank(c) | s.isin(*K.NO_DEMOGRAPHICS), "No").otherwise("Yes")


def clean_topic_area(c: Column, areas: Mapping[str, str] | None = None) -> Column:
    """First ";" part looked up in the area map; unknown and NULL are Other."""
    first = strip(F.split(F.lower(strip(c)), ";").getItem(0))
    return F.coalesce(lookup(first, areas or K.TOPIC_AREAS), F.lit("Other"))


def simplify_ato(c: Column) -> Column:
    """The "No" prefix is tested before "Not Applicable", so that is No too."""
    s = strip(c)
    return (
        F.when(c.isNull() | (c == "Unknown"), "Unknown")
        .when(s.isin("Yes", "Operated in an approved enclave", "Data.State-SBU"), "Yes")
        .when(s.startswith("No"), "No")
        .otherwise("Other")
    )


def simplify_independent_eval(c: Column) -> Column:
    """N14."""
    s = strip(c)
    return (
        F.when(c.isNull() | (c == "Unknown"), "Unknown")
        .when(s.isin("Yes", "True"), "Yes")
        .when(s == "Planned or in-progress", "Planned")
        .when(_has(F.lower(s), "not safety or rights-impacting", "does not apply"), "Not applicable")
        .when(s.contains("waived this minimum practice"), "Waived")
        .when(s == "Not Applicable", "Not applicable")
        .otherwise(s)
    )


def simplify_operational_testing(c: Column) -> Column:
    """N15."""
    s = strip(c)
    return (
        F.when(c.isNull() | (c == "Unknown"), "Unknown")
        .when(s == "Not Applicable", "Not applicable")
        .when(s.startswith("No testing"), "None")
        .when(s.startswith("Benchmark evaluation"), "Benchmark only")
        .when(s.startswith("Performance evaluation in operational environment") | (s == "Yes"), "Operational test")
        .when(s.startswith("Impact evaluation in operational environment"), "Impact evaluation")
        .when(s.contains("waived this minimum practice"), "Waived")
        .otherwise("Other")
    )


def simplify_monitoring(c: Column, none_prefix: str = "No monitoring protocols") -> Column:
    """Pass the longer "... have been established" prefix for the strict form."""
    s = strip(c)
    return (
        F.when(c.isNull() | (c == "Unknown"), "Unknown")
        .when((s == "Not Applicable") | F.lower(s).contains("not safety or rights-impacting"), "Not applicable")
        .when(s.startswith(none_prefix), "None")
        .when(s.startswith("Intermittent and Manually Updated"), "Manual")
        .when(s.startswith("Automated and Regularly Scheduled Updates"), "Automated")
        .when(s.startswith("Established Process of Machine Learning Operations"), "MLOps")
        .otherwise("Other")
    )


def title_case(c: Column) -> Column:
    """Upper case after every non-letter ("n/a" -> "N/A"), not only after blanks."""
    pieces = F.regexp_extract_all(F.lower(c), F.lit(r"\p{L}+|\P{L}+"), 0)
    return F.array_join(F.transform(pieces, lambda p: F.initcap(p)), "")


def title_unknown(c: Column, fixes: Mapping[str, str] | None = None, collapse: bool = False) -> Column:
    """Trimmed title case, blank to Unknown, then a fix-up map."""
    s = strip(c)
    if collapse:
        s = F.regexp_replace(s, r"(?U)\s+", " ")
    t = title_case(s)
    t = F.when(t.isNull() | t.isin("", "Nan"), "Unknown").otherwise(t)
    return recode(t, fixes) if fixes else t


def status_flag(stage: Column, retired: str = "Retired") -> Column:
    """NULL counts as Active."""
    return F.when(stage.eqNullSafe(retired), "Retired").otherwise("Active")


def contains_flag(c: Column, word: str) -> Column:
    """Case-insensitive contains, NULL is false."""
    return F.coalesce(F.lower(c).contains(word.lower()), F.lit(False))


def equals_flag(c: Column, value: str) -> Column:
    """N19, equality form."""
    return c.eqNullSafe(value)


def short_label(c: Column, max_len: int = 30) -> Column:
    """Whole words that fit plus "..."; each word costs its length plus one.

    A word costs at least two characters, so the first ``max_len`` words decide.
    """
    words = F.slice(F.split(strip(c), r"(?U)\s+"), 1, max_len)
    start = F.struct(F.lit(0).alias("used"), F.lit(0).alias("n"), F.lit(True).alias("open"))

    def take(acc, w):
        need = acc["used"] + F.length(w) + F.when(acc["n"] > 0, 1).otherwise(0)
        fits = acc["open"] & (need <= max_len)
        return F.struct(
            F.when(fits, acc["used"] + F.length(w) + 1).otherwise(acc["used"]).alias("used"),
            F.when(fits, acc["n"] + 1).otherwise(acc["n"]).alias("n"),
            fits.alias("open"),
        )

    n = F.aggregate(words, start, take)["n"]
    cut = F.when(n > 0, F.array_join(F.slice(words, 1, n), " ")).otherwise(F.substring(c, 1, max_len - 3))
    return F.when(F.length(c) > max_len, F.concat(cut, F.lit("..."))).otherwise(c)


def nice_title(c: Column, acronyms: Sequence[str] = tuple(K.KEEP_UPPER)) -> Column:
    """Listed acronyms in capitals, other words capitalised."""
    words = F.filter(F.split(strip(c), r"(?U)\s+"), lambda w: w != "")
    return F.array_join(
        F.transform(words, lambda w: F.when(F.upper(w).isin(*acronyms), F.upper(w)).otherwise(
            F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 2147483647))))),
        " ",
    )


def snippet(c: Column, n: int = 300) -> Column:
    """First n characters on one line."""
    return F.regexp_replace(F.substring(c, 1, n), "\n", " ")
