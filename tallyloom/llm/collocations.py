"""Phrase collocations: one count of longest windows, and sums over their prefixes."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bpe import _groups
from .registry import query, table
from .util import join_hot, saved

MOST_WORDS = 500_000      # words that get a number and are broadcast
HOT_LEAST = 50_000        # a word as common as a quarter of a shuffle partition, and so often, is hot
BITS = 24                 # of a word's number
UPPER = bytes(range(65, 91))
# The bytes at which pieces end, and the tab that separates words like a space.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes.maketrans(UPPER + PIECE_ENDS + b"\t", UPPER.lower() + b"\n" * len(PIECE_ENDS) + b" ")


def words_of(text: bytes) -> list[list[bytes]]:
    """Words of the pieces of a text in UTF-8, A-Z lower-cased."""
    return [w for w in (p.split() for p in text.translate(_FOLD).split(b"\n")) if w]


def _source(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_text"))


def word_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, word, f), words counted a batch at a time before they move."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                count = found.setdefault(lang, Counter())
                for words in words_of(text):
                    count.update(words)
            for lang, count in found.items():
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(count), pa.string()), pa.array(list(count), pa.binary()).cast(pa.string()),
                    pa.array(list(count.values()), pa.int64())], names=["lang", "word", "f"])

    each = _source(docs, text_col, lang_col).mapInArrow(run, "lang string, word string, f long")
    return each.groupBy("lang", "word").agg(F.sum("f").alias("f"))


def numbered_words(counts: DataFrame, least: int, most: int) -> pd.DataFrame:
    """The words found ``least`` times or more, the commonest first, as many whole counts of them as fit in ``most``."""
    by_size = counts.filter(F.col("f") >= least).groupBy(F.length(F.bin("f")).alias("bits")).agg(
        F.count(F.lit(1)).alias("n")).orderBy(F.desc("bits")).collect()
    total, low = 0, 2**62
    for r in by_size:                # at most 64 rows
        total += r["n"]
        if total > most:
            break
        low = max(least, 2 ** (r["bits"] - 1))
    return counts.filter(F.col("f") >= low).orderBy(F.desc("f"), "lang", "word").toPandas()


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        return -1


def _lead(codes: np.ndarray, by: int) -> np.ndarray:
    out = np.full(codes.size, -1, codes.dtype)
    if by < codes.size:
        out[:codes.size - by] = codes[by:]
    return out


def numbered_windows(docs: DataFrame, words: pd.DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(w12, w34, n): the windows of four numbered words that start at each word, two numbers
    packed in each column. A window ends, padded with -1, at the end of its piece and before the first word
    without a number; those of one word are left out. Equal ones of a batch are merged."""
    known = docs.sparkSession.sparkContext.broadcast(
        (words["lang"].tolist(), [w.encode() for w in words["word"]]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, _Words] = {}
        for i, (lang, word) in enumerate(zip(*known.value, strict=True)):
            tables.setdefault(lang, _Words())[word] = i
        none = _Words()
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for x, y in _groups(texts, 16_000_000):
                codes: list[int] = []
                for lang, text in zip(langs[x:y], texts[x:y], strict=True):
                    number = tables.get(lang, none).__getitem__
                    for piece in words_of(text):
                        codes.extend(map(number, piece))
                        codes.append(-1)
                w = [np.array(codes, np.int64)]
                for by in (1, 2, 3):
                    w.append(np.where(w[-1] >= 0, _lead(w[0], by), -1))
                use = w[1] >= 0
                w12 = (w[0][use] << BITS) | w[1][use]
                w34 = ((w[2][use] + 1) << BITS) | (w[3][use] + 1)
                order = np.lexsort((w34, w12))
                w12, w34 = w12[order], w34[order]
                new = np.ones(w12.size, bool)
                new[1:] = (w12[1:] != w12[:-1]) | (w34[1:] != w34[:-1])
                first = np.flatnonzero(new)
                n = np.diff(np.append(first, w12.size)).astype(np.int32)
                for k in range(0, first.size, 100_000):
                    at = first[k:k + 100_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(w12[at]), pa.array(w34[at]), pa.array(n[k:k + 100_000])], names=["w12", "w34", "n"])

    return _source(docs, text_col, lang_col).mapInArrow(run, "w12 long, w34 long, n int")


def spelled_windows(docs: DataFrame, words: pd.DataFrame, hot: int, text_col: str, lang_col: str) -> DataFrame:
    """(lang, w12, w3, w4, n, plain, hot): the windows of four words that hold a word without a
    number, spelled out. ``plain`` counts the words before the first such word; ``hot`` is 0, or 1 if
    the first two words are hot, or 2 if the third is hot, too."""
    known = docs.sparkSession.sparkContext.broadcast((words["lang"].tolist(), [w.encode() for w in words["word"]]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, _Words] = {}
        for i, (lang, word) in enumerate(zip(*known.value, strict=True)):
            tables.setdefault(lang, _Words())[word] = i
        none = _Words()
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for x, y in _groups(texts, 1_000_000):
                found: Counter = Counter()
                for lang, text in zip(langs[x:y], texts[x:y], strict=True):
                    number = tables.get(lang, none).__getitem__
                    for piece in words_of(text):
                        codes = list(map(number, piece))
                        hots = [0 <= c < hot for c in codes] + [False]
                        for i in range(len(piece) - 1):
                            if -1 in codes[i:i + 4]:
                                found[lang, piece[i] + b" " + piece[i + 1], *piece[i + 2:i + 4],
                                      *[None] * (i + 4 - len(piece)), codes.index(-1, i) - i,
                                      hots[i] and hots[i + 1] and 1 + hots[i + 2]] += 1
                if found:
                    cols = list(zip(*found, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cols[0], pa.string()), *[pa.array(c, pa.binary()).cast(pa.string()) for c in cols[1:4]],
                         pa.array(list(found.values()), pa.int32()), pa.array(cols[4], pa.int32()), pa.array(map(int, cols[5]), pa.int32())],
                        names=["lang", "w12", "w3", "w4", "n", "plain", "hot"])

    return _source(docs, text_col, lang_col).mapInArrow(
        run, "lang string, w12 string, w3 string, w4 string, n int, plain int, hot int")


def _salt(hot: Column, three: list, four: list) -> Column:
    """0, or a positive number for windows to spread by three words, or a negative one by four."""
    number = lambda cols: F.xxhash64(*cols).bitwiseAND(2**62 - 1) + 1
    return F.when(hot == 1, number(three)).when(hot == 2, -number(four)).otherwise(0)


def prefix_sums(met: DataFrame, keys: list[str], least: int) -> DataFrame:
    """(keys, w3, w4, f, plain, size): all prefixes of two words or more found ``least`` times.

    ``met`` has the windows (keys for their first two words, w3, w4, null where padded, n, plain),
    dealt out by the keys and the salt ``_s``, so that windows with the same first words lie
    together. There they lose what follows a prefix too rare to be reported; what is left,
    little, is summed by ROLLUP. Under a salt above 0 only windows with the same three words lie
    together, below 0 only equal ones: those are cut by their third word, or not at all.
    """
    third = Window.partitionBy(*keys, "_s", "w3")
    second = Window.partitionBy(*keys, "_s")
    kept = met.withColumn("_f3", F.sum("n").over(third)).withColumn("_f2", F.sum("n").over(second)).filter(
        (F.col("_s") != 0) | (F.col("_f2") >= least)).withColumn("_go", (F.col("_s") < 0) | (F.col("_f3") >= least)).select(
        *keys, F.when(F.col("_go"), F.col("w3")).alias("w3"), F.when(F.col("_go"), F.col("w4")).alias("w4"), "n", "plain")
    sums = kept.rollup(*keys, "w3", "w4").agg(
        F.sum("n").alias("f"), F.min("plain").alias("plain"), F.grouping(keys[-1]).alias("_g2"),
        F.grouping("w3").alias("_g3"), F.grouping("w4").alias("_g4"))
    # A level counts where its last word is there; its padded rows are shorter windows.
    size = (F.when(F.col("_g3") == 1, 2).when((F.col("_g4") == 1) & F.col("w3").isNotNull(), 3)
            .when((F.col("_g4") == 0) & F.col("w4").isNotNull(), 4))
    return sums.filter(F.col("_g2") == 0).withColumn("size", size).filter(
        F.col("size").isNotNull() & (F.col("f") >= least)).select(*keys, "w3", "w4", "f", "plain", "size")


def _spelled(sums: DataFrame, words: pd.DataFrame) -> DataFrame:
    """Sums over packed windows with their words written out."""
    known = sums.sparkSession.sparkContext.broadcast((words["lang"].to_numpy(object), words["word"].to_numpy(object)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, word = known.value
        for batch in batches:
            w12 = batch.column("w12").to_numpy()
            ids = [w12 >> BITS, w12 & ((1 << BITS) - 1),
                   *(batch.column(c).fill_null(-1).to_numpy(zero_copy_only=False) for c in ("w3", "w4"))]
            size = batch.column("size").to_numpy()
            phrases = [" ".join(word[i] for i in row[:k]) for k, *row in zip(size, *ids, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang[ids[0]], pa.string()), pa.array(phrases, pa.string()), batch.column("size"), batch.column("f")],
                names=["lang", "phrase", "size", "f"])

    return sums.select("w12", "w3", "w4", "size", "f").mapInArrow(run, "lang string, phrase string, size int, f long")


def phrase_counts(docs: DataFrame, least: int = 30, text_col: str = "text", lang_col: str = "lang",
                  counts: DataFrame | None = None, most_words: int = MOST_WORDS) -> DataFrame:
    """(lang, phrase, size, f): every phrase of 1 to 4 words found at least ``least`` times in the
    texts of its language, words joined by spaces. ``counts``: their ``word_counts``, if at hand.

    Up to ``most_words`` words are numbered and broadcast; all that are frequent enough, if they
    fit. Windows are then a few bytes long, and end before the first rare word, which no such phrase
    can hold. Frequent words beyond that bound are spelled out in windows of their own, which count
    only prefixes that hold one of them; so each phrase is counted once, whatever the bound.
    """
    counts = saved(word_counts(docs, text_col, lang_col), "word-counts") if counts is None else counts
    common = counts.filter(F.col("f") >= least)
    words = numbered_words(counts, least, most_words)
    t = counts.agg(F.coalesce(F.sum("f"), F.lit(0)).alias("f"), F.count(F.when(F.col("f") >= least, 1)).alias("n")).first()
    # Numbers follow frequency, so hot words have the first ones.
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = int((words["f"] >= max(t["f"] / (4 * partitions), HOT_LEAST)).sum())
    mask = (1 << BITS) - 1
    is_hot = [F.shiftright("w12", BITS) < hot, F.col("w12").bitwiseAND(mask) < hot, F.shiftright("w34", BITS).between(1, hot)]
    code = lambda c: F.when(c > 0, c - 1)
    packed = numbered_windows(docs, words, text_col, lang_col).withColumn("_s", _salt(
        F.when(~(is_hot[0] & is_hot[1]), 0).when(is_hot[2], 2).otherwise(1), ["w12", F.shiftright("w34", BITS)], ["w12", "w34"])
    ).repartition("w12", "_s").select(
        "w12", code(F.shiftright("w34", BITS)).alias("w3"), code(F.col("w34").bitwiseAND(mask)).alias("w4"),
        "n", "_s", F.lit(0).alias("plain"))
    out = common.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("size"), "f").unionByName(
        _spelled(prefix_sums(packed, ["w12"], least), words))
    if len(words) < t["n"]:
        open_ = spelled_windows(docs, words, hot, text_col, lang_col).withColumn(
            "_s", _salt(F.col("hot"), ["w12", "w3"], ["w12", "w3", "w4"])).repartition("lang", "w12", "_s")
        sums = prefix_sums(open_, ["lang", "w12"], least).filter(F.col("plain") < F.col("size"))
        out = out.unionByName(sums.select("lang", F.concat_ws(" ", "w12", "w3", "w4").alias("phrase"), "size", "f"))
    return out


def _with_counts(cuts: DataFrame, phrases: DataFrame, part: str, name: str) -> DataFrame:
    """Adds the count of the phrase in column ``part``; common parts ("of the") are hot keys."""
    need = cuts.groupBy("lang", part).agg(F.count(F.lit(1)).alias("_w"))
    right = need.join(phrases.select("lang", F.col("phrase").alias(part), F.col("f").alias(name)), ["lang", part])
    return join_hot(cuts, right, ["lang", part], "_w").drop("_w")


def _words(first, size) -> Column:
    return F.array_join(F.slice("_words", first, size), " ")


def collocations(docs: DataFrame, least: int = 30, keep_share: int = 80, top: int = 2000,
                 text_col: str = "text", lang_col: str = "lang", most_words: int = MOST_WORDS) -> DataFrame:
    """The ``top`` phrases of 2 to 4 words of each language: lang, rank (from 1), phrase, a (its
    count), l and r (counts of its two parts at the cut that scores lowest, the earliest of
    equals), n (words of the language), score (2,000,000 a / (l + r), floored).

    A-Z are lower-cased; texts are split at ``.,;:!?`` and line ends into pieces and those at
    spaces and tabs into words; phrases lie within a piece, overlapping ones all count. Candidates are found ``least``
    times or more; those inside a longer one that is found in at least ``keep_share`` percent of
    their places are left out. Order: score, a, both descending, then phrase by its bytes.

    Each word starts one window of up to four words, padded at its piece's end. Only windows
    are counted; the counts of all shorter phrases are sums over their prefixes (ROLLUP). Equal
    windows merge before they move; windows under pairs of very common words are spread.

    Null language: ``und``; null or empty text: no words. Very long texts and repeated rows are
    counted whole. Other columns are ignored, and no table gives no rows.
    """
    counts = saved(word_counts(docs, text_col, lang_col), "word-counts", 2_000)
    phrases = saved(phrase_counts(docs, least, text_col, lang_col, counts, most_words), "phrases", 4_000)
    many = phrases.filter("size > 1").withColumn("_words", F.split("phrase", " "))
    cuts = many.select("lang", "phrase", "f", "_words", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("_k")).select(
        "lang", "phrase", "f", "_k", _words(F.lit(1), F.col("_k")).alias("_left"),
        _words(F.col("_k") + 1, F.col("size") - F.col("_k")).alias("_right"))
    met = cuts
    for part, name in (("_left", "l"), ("_right", "r")):
        met = saved(_with_counts(met, phrases, part, name), "phrase-cuts")
    exact = "CAST(f AS DECIMAL(20,0)) * 2000000 div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))"
    best = met.groupBy("lang", "phrase", "f").agg(F.min(F.struct(F.expr(exact).alias("score"), "_k", "l", "r")).alias("_b"))
    inner = many.filter("size > 2").select("lang", "f", "_words", "size", F.explode(
        F.sequence(F.lit(2), F.col("size") - 1)).alias("_m")).select("lang", "f", "_words", "_m", F.explode(
            F.sequence(F.lit(1), F.col("size") - F.col("_m") + 1)).alias("_i")).groupBy(
        "lang", _words(F.col("_i"), F.col("_m")).alias("phrase")).agg(F.max("f").alias("_longer"))
    big = lambda c, k: F.col(c).cast("decimal(20,0)") * k
    kept = saved(best.join(inner, ["lang", "phrase"], "left").filter(
        F.col("_longer").isNull() | (big("_longer", 100) < big("f", keep_share))).select(
        "lang", "phrase", F.col("f").alias("a"), "_b.l", "_b.r", "_b.score"), "phrases-kept")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = Window.partitionBy("lang", "_s").orderBy(*order)
    some = kept.withColumn("_s", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn(
        "_r", F.row_number().over(salted)).filter(F.col("_r") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    n = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(n, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


@query("op11_collocations", r"""
WITH p AS (SELECT doc_id, coalesce(lang, 'und') AS lang,
       unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[.,;:!?
-
]')) AS piece FROM documents),
q AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM p),
i AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM q),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
      FROM i, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM g WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, phrase, f AS a, k AS size, string_split(phrase, ' ') AS w FROM g WHERE k >= 2 AND f >= 30),
cut AS (SELECT lang, phrase, a, w, size, unnest(range(1, size)) AS k FROM c),
sc AS (SELECT cut.lang, cut.phrase, a, cut.k, x.f AS l, y.f AS r,
       CAST((CAST(a AS HUGEINT) * 2000000) // (x.f + y.f) AS BIGINT) AS score
       FROM cut JOIN g x ON x.lang = cut.lang AND x.k = cut.k AND x.phrase = array_to_string(w[1:cut.k], ' ')
       JOIN g y ON y.lang = cut.lang AND y.k = size - cut.k AND y.phrase = array_to_string(w[cut.k + 1:], ' ')),
b AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
m AS (SELECT lang, a, w, size, unnest(range(2, size)) AS m FROM c WHERE size > 2),
s AS (SELECT lang, a, w, m, unnest(range(1, size - m + 2)) AS i FROM m),
inside AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer FROM s GROUP BY ALL),
kept AS (SELECT b.* FROM b LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
       phrase, a, l, r, n, score FROM kept JOIN n USING (lang) QUALIFY rank <= 2000""")
def op11_collocations(spark, sf):
    """The 2,000 best phrases of every language, from all whole texts."""
    return collocations(table(spark, sf, "documents").select("text", "lang"))
