"""Truth tables for the row expressions."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.functions import cleaning as N
from tallyloom.functions import dates as D
from tallyloom.functions import scoring as S
from tallyloom.functions import text as X
from tallyloom.operators import textfeatures as TF


def run(spark, build, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("c")).alias("o")).collect()]


CASES = {
    "categorical": (N.clean_categorical,
                    [" Yes ", "YES – done", "no - later", "", "nan", "NA", "N/A", "n/a", None, "Maybe"],
                    ["Yes", "Yes", "No", "Unknown", "Unknown", "Unknown", "Not applicable", "Not applicable",
                     "Unknown", "Maybe"]),
    "text": (N.clean_text, [" a ", "", "nan", None, "\n"], ["a", None, None, None, None]),
    "simple": (lambda c: N.normalize_impact(c, "simple"), ["Rights-Impacting\n", "Safety-Impacting", "x", None],
               ["Rights-impacting", "Safety-impacting", "x", None]),
    "grouped": (lambda c: N.normalize_impact(c, "grouped"),
                ["Rights-Impacting\n", "Case-by-case assessment", "nan", None, "Other"],
                ["Rights-impacting", "Too new to assess", "Unknown", "Unknown", "other"]),
    "regex": (lambda c: N.normalize_impact(c, "regex"),
              ["rights – impacting", "Both", "No, use case is too new to say", "will be reassessed", "NaN", None, "Odd  one", ""],
              ["Rights-impacting", "Both", "Neither", "Neither", None, None, "Odd one", ""]),
    "lower": (lambda c: N.normalize_impact(c, "lower"), ["Both", "ODD", "", None], ["Both", "odd", None, None]),
    "code": (N.impact_code, ["Both", "rights and safety", "Neither", "Right", "Safety", "?", None],
             [3, 3, 0, 1, 2, None, None]),
    "resourcing": (N.normalize_resourcing,
                   ["Developed in-house", "contract", "both contract and in-house", "combination", "no contract",
                    "neither", "external", "inhouse", " ", None],
                   ["In-House", "External Contracting", "Both", "Unknown", "External Contracting", "Neither",
                    "External Contracting", "Unknown", "Unknown", "Unknown"]),
    "bucket": (N.dev_bucket, ["no contract", "inhouse", "combination", "external", "neither", None],
               [N.HYBRID, "In-house", N.HYBRID, "Contract", "Unknown", "Unknown"]),
    "method": (N.dev_method_simple, ["Contracts", "in house", "Else", None, ""],
               ["Contract", "In-house", "else", "Unknown", "Unknown"]),
    "pii": (N.normalize_pii, ["Yes", "y", "TRUE", "no", "N/A", "", None],
            ["Yes", "Yes", "Yes", "No", "Unknown", "Unknown", "Unknown"]),
    "demographics": (N.normalize_demographics, ["None", "N/A", "Age; Sex", " ", None], ["No", "No", "Yes", "No", "No"]),
    "area": (N.clean_topic_area,
             ["Law & Justice", "Mission-Enabling ", "Other; Mission-Enabling (internal agency support)",
              "NLP;Classification", "Unlisted", None],
             ["Law & Justice", "Mission-Enabling", "Other", "Natural Language Processing", "Other", "Other"]),
    "ato": (N.simplify_ato, ["Data.State-SBU", "Not Applicable", "x", None], ["Yes", "No", "Other", "Unknown"]),
    "monitor": (N.simplify_monitoring, ["No monitoring protocols yet", "Not Applicable", None],
                ["None", "Not applicable", "Unknown"]),
    "title": (lambda c: N.title_unknown(c, {"N/A": "Not applicable", "Na": "Unknown"}),
              ["n/a", "na", "data.state-sbu", "don't", None], ["Not applicable", "Unknown", "Data.State-Sbu", "Don'T", "Unknown"]),
    "label": (N.short_label, ["short", "word " * 10, "x" * 40, None],
              ["short", "word word word word word word...", "x" * 27 + "...", None]),
    "nice": (lambda c: N.nice_title(c), ["ai for foia requests", "LLM  tool"], ["AI For FOIA Requests", "LLM Tool"]),
    "snippet": (lambda c: N.snippet(c, 3), ["a\nbc", None], ["a b", None]),
    "level": (S.keyword_level,
              ["cloud storage", "order fulfillment", "weather forecasting", "forecast", "email form", "simulation", "", None],
              [5, 5, 4, 2, 1, 3, 2, 2]),
    "preclean": (X.light_preclean,
                 ["Use-case at https://a-b.gov/x e-mail a.b@c.gov", "Mission – enabling  intended   purpose", None],
                 ["at b.gov/x e mail", "", ""]),
    "words": (X.word_count, ["a  b c", "", None], [3, 0, None]),
    "simple tokens": (X.simple_tokens, ["Café ÉCOLE ét x1 _a"], [["cafe", "ecole", "et"]]),
    "ngrams": (lambda c: X.ngrams(X.word_tokens(c), 1, 3), ["ab cd ef", "ab", ""],
               [["ab", "cd", "ef", "ab cd", "cd ef", "ab cd ef"], ["ab"], []]),
    "lemma": (lambda c: F.array_join(TF.lemma_tokens(c, {"children": "child"}, ["the"]), " "),
              ["The children studies boxes cats glass running"], ["child study box cat glass runn"]),
}


@pytest.mark.parametrize("name", CASES)
def test_table(spark, name):
    build, values, want = CASES[name]
    assert run(spark, build, values) == want


def test_dates(spark):
    got = run(spark, lambda c: D.parse_us_date(c).cast("string"),
              ["7/1/2023", "07/01/2023", "13/1/2023", "2023-07-01", "7/1/23", "TBD", "", None])
    assert got == ["2023-07-01", "2023-07-01"] + [None] * 6


def test_bands(spark):
    assert run(spark, S.complexity_band, [0.5, 33.3, 40.0, 69.9, 70.0, None], "double") == [
        "Medium", "Low", "Medium", "Medium", "High", "No model score available."]
    assert run(spark, S.focus_bucket, [1.5, 0.75, 1.0, None], "double") == [
        "more in group", "more in rest", "similar", "similar"]
    assert run(spark, S.proposal_band, [66.0, 40.0, 1.0, None], "double") == [
        "High Complexity", "Medium Complexity", "Low Complexity", "Insufficient Inputs"]


def test_missing_topic_is_no_nan(spark):
    got = run(spark, lambda c: S.complexity_score(c, F.lit(None).cast("string"), F.lit("Other")), [1, 99, None], "int")
    assert got == [pytest.approx(9 / 15 * 100), pytest.approx(40.0), pytest.approx(40.0)]


def test_keyword_level_is_that_of_the_patterns(spark, capsys):
    """Words are searched before patterns, and the lower-cased text is made once, not once per level."""
    def plain(c):
        out = F.lit(2)
        for k in sorted(S.K.LEVEL_PATTERNS):
            out = F.when(F.lower(c).rlike("(?iU)" + "|".join(S.K.LEVEL_PATTERNS[k])), k).otherwise(out)
        return out

    values = ["a storage", "PLATFORM", "a form.", "reformed", "faqs", "my FAQ", "reports", "entity linkage", "entity x", "classifying",
              "classified", "\u017fimulation", "r\u0131sk model", "loo\u212aup", "R\u0130SK MODEL", "emails", "an email", None]
    df = spark.createDataFrame([(v,) for v in values], "c string").select(
        "c", S.keyword_level(F.col("c")).alias("got"), plain(F.col("c")).alias("want"))
    assert [r for r in df.collect() if r.got != r.want] == []
    own = {4: [r"colou?r", r"x|y"], 3: ["data sets?"]}
    got = run(spark, lambda c: S.keyword_level(c, own), ["Color", "COLOUR", "a y", "data set", "date"])
    assert got == [4, 4, 4, 3, 2]
    df.select(S.keyword_level(F.col("c")).alias("k")).explain()
    assert capsys.readouterr().out.count("lower(") == 1


texts = st.lists(st.one_of(st.none(), st.text(max_size=30)), min_size=1, max_size=60)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts)
def test_cleaners_are_stable(spark, values):
    """Cleaning twice changes nothing; closed vocabularies stay closed."""
    df = spark.createDataFrame([(v,) for v in values], "c string")
    c = F.col("c")
    once = {"a": N.clean_categorical(c), "b": N.clean_text(c), "d": X.light_preclean(c)}
    twice = {"a": N.clean_categorical, "b": N.clean_text, "d": X.light_preclean}
    first = df.select(*[v.alias(k) for k, v in once.items()])
    bad = first.filter(~(N.clean_text(F.col("b")).eqNullSafe(F.col("b"))) |
                       ~(twice["a"](F.col("a")).eqNullSafe(F.col("a"))))
    assert bad.count() == 0
    closed = df.select(N.normalize_resourcing(c).alias("r"), N.normalize_pii(c).alias("p"), S.keyword_level(c).alias("k"))
    assert closed.filter(
        ~F.col("r").isin("Unknown", "Both", "External Contracting", "In-House", "Neither")
        | ~F.col("p").isin("Yes", "No", "Unknown") | ~F.col("k").between(1, 5)).count() == 0
