"""Benchmark decontamination: SimHash of item-sized windows, multi-index search, exact check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .registry import query, table
from .util import digest, join_hot, saved

SHINGLE = 5
BLOCKS, BLOCK_BITS = 4, 16
MOST_BROADCAST = 2_000_000       # index shingles sent to all executors at once


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _hashes(words: str) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _shingles(hashes: str, size: int) -> Column:
    """Hash of every run of ``size`` word hashes in the array column."""
    col = F.col(hashes)
    rolled = F.transform(hashes, lambda h, i: F.xxhash64(h, *[F.get(col, i + k) for k in range(1, size)]))
    return F.slice(rolled, 1, F.greatest(F.size(hashes) - (size - 1), F.lit(0)))


def _tagged(shingles: str) -> Column:
    """The k-th copy of a shingle becomes an element of its own, so sets count copies."""
    s = F.sort_array(F.col(shingles))
    return F.transform(s, lambda h, i: F.xxhash64(h, i + 1 - F.array_position(s, h)))


def _block(fp: str, k: int) -> Column:
    return F.shiftrightunsigned(F.col(fp), BLOCK_BITS * k).bitwiseAND((1 << BLOCK_BITS) - 1).cast("int")


def simhash(rows: DataFrame, key: str, shingles: str, carry: list[str]) -> DataFrame:
    """Adds ``fp``: 64 bits, each the majority of that bit over the row's shingles (copies
    count). ``key`` is unique. Two 32-bit counters share a long, so 32 sums do for 64 bits."""
    low = 0x0000000100000001
    parts = rows.select(key, *carry, F.explode(shingles).alias("_h")).groupBy(key, *carry).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(F.shiftrightunsigned("_h", b).bitwiseAND(F.lit(low))).alias(f"_s{b}") for b in range(32)])
    fp = F.lit(0).cast("long")
    for b in range(32):
        for half in (0, 32):
            n = F.shiftrightunsigned(f"_s{b}", half).bitwiseAND(F.lit(0xFFFFFFFF))
            fp = fp.bitwiseOR(F.when(2 * n > F.col("_n"), F.shiftleft(F.lit(1).cast("long"), b + half)).otherwise(F.lit(0).cast("long")))
    return parts.select(key, *carry, fp.alias("fp"))


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text: str = "text", similarity: float = 0.8,
               radius: int = 19, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """Pairs (document, item) of which a window is like the item: the id columns, ``start``
    (the window's first word, from 0), ``n_words``, ``similarity`` and ``distance``.

    Words are lower-cased runs of letters and digits; shingles are five words (all words of an
    item that has fewer). A window has as many words as the item, or is the whole document if
    that is shorter. Similarity is the weighted Jaccard of the shingles, their numbers of
    copies being the weights. Of each pair the most similar window is returned, the first of
    equals.

    A window as similar as asked shares all but a few shingles with its item, so it holds at
    least one of the item's rarest few; windows are laid, at every offset, around those only.
    Windows of equal words are fingerprinted once (64-bit SimHash). Fingerprints are cut into
    four 16-bit blocks; the index holds every value within radius // 4 bits of an item's
    block, so each fingerprint within ``radius`` of an item's is found through some block. What is
    found is then checked exactly. Radius 19 misses a window of similarity just 0.8 about
    once in 3,000; a better one hardly ever.

    Items are a query set: their rare shingles (a ninth of all) are broadcast in blocks of
    ``most_broadcast``, one pass over the documents per block. Texts are not shuffled. A window that very
    many documents share is looked up by broadcast.

    Null or empty texts and items have no words and match nothing. Equal items are found
    alike; rows with equal ids are one document; a null id is an id. Needs nothing of other
    columns.
    """
    spark = docs.sparkSession
    # --- items: shingles, the rare ones, fingerprints
    it = items.select(F.col(item_col).alias("item"), words_of(F.col(item_text)).alias("w")).filter(F.size("w") > 0)
    it = it.groupBy("item", digest(F.concat_ws(" ", "w")).alias("ikey")).agg(F.first("w").alias("w"))
    it = it.withColumn("ik", F.xxhash64(F.struct("item", "ikey"))).withColumn("h", _hashes("w"))
    sizes = sorted(r.k for r in it.select(F.least(F.size("w"), F.lit(SHINGLE)).alias("k")).distinct().collect())
    if not sizes:
        sizes = [SHINGLE]
    by_size = None
    for k in sizes:
        part = it.filter(F.least(F.size("w"), F.lit(SHINGLE)) == k).select(
            "item", "ik", F.size("w").alias("len"), F.lit(k).alias("k"), _shingles("h", k).alias("sh"))
        by_size = part if by_size is None else by_size.unionByName(part)
    it = saved(by_size, "items")
    each = it.select("item", "ik", "len", "k", F.size("sh").alias("n"), F.explode(F.array_distinct("sh")).alias("s"))
    df = each.groupBy("s").agg(F.count(F.lit(1)).alias("df"))
    # |W & I| >= 2 s / (1 + s) * |I| where W is no larger: missing at most so many, one more is enough.
    spare = F.floor(F.col("n") - F.ceil(F.col("n") * F.lit(similarity) - 1e-9)).cast("int") + 1
    rare = each.join(df, "s").groupBy("item", "ik", "len", "k", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "s"))).alias("o")).select(
        "item", "ik", "len", "k", F.explode(F.slice("o", 1, spare)).alias("o")).select(
        "item", "ik", "len", "k", F.col("o.s").alias("s"))
    rare = saved(rare, "rare-shingles")
    blocks = max(1, -(-rare.count() // most_broadcast))

    # --- documents: rare shingles hit, with the words around them
    d = docs.select(F.col(id_col).alias("doc"), words_of(F.col(text_col)).alias("w")).filter(F.size("w") > 0)
    hits = None
    for k in sizes:
        own = d.select("doc", "w", _hashes("w").alias("h")).select(
            "doc", "w", F.posexplode(_shingles("h", k)).alias("p", "s"))
        for b in range(blocks):
            index = rare.filter((F.col("k") == k) & (F.pmod(F.xxhash64("ik"), F.lit(blocks)) == b))
            part = own.join(F.broadcast(index), "s")
            first = F.greatest(F.lit(0), F.least(F.col("p") - (F.col("len") - k), F.size("w") - F.col("len")))
            last = F.greatest(F.lit(0), F.least(F.col("p"), F.size("w") - F.col("len")))
            part = part.withColumn("first", first).select(
                "doc", "item", "ik", "len", "k", "first", last.alias("last"),
                F.slice("w", F.col("first") + 1, last - F.col("first") + F.col("len")).alias("w"))
            hits = part if hits is None else hits.unionByName(part)
    hits = saved(hits, "hits")

    # --- windows: every offset around a hit; equal words are one window
    at = hits.select("doc", "item", "ik", "len", "k", "first", "w", F.explode(F.sequence("first", "last")).alias("start"))
    own = at.select("doc", "item", "ik", "k", "start", F.slice("w", F.col("start") - F.col("first") + 1, F.col("len")).alias("w"))
    own = saved(own.withColumn("wkey", digest(F.concat_ws(" ", F.col("k").cast("string"), "w"))), "windows")
    distinct = own.groupBy("wkey").agg(F.first("w").alias("w"), F.first("k").alias("k"), F.count(F.lit(1)).alias("weight"))
    distinct = distinct.select("wkey", "weight", "k", _hashes("w").alias("h"))
    sh = None
    for k in sizes:
        c = F.when(F.col("k") == k, _shingles("h", k))
        sh = c if sh is None else F.coalesce(sh, c)
    distinct = saved(distinct.select("wkey", "weight", "k", sh.alias("sh")), "shingled")
    # Saved, so that plans that use a fingerprint do not carry the tree of its 64 bits.
    fps = saved(simhash(distinct.filter(F.size("sh") > 0), "wkey", "sh", ["k"]), "window-prints")
    item_fps = saved(simhash(it, "ik", "sh", ["k"]), "item-prints")

    # --- multi-index search: a pair counts where its first near block is
    near = radius // BLOCKS
    masks = spark.range(1 << BLOCK_BITS).filter(F.bit_count("id") <= near).agg(F.collect_list(F.col("id").cast("int"))).scalar()
    index = item_fps.select("ik", "k", F.col("fp").alias("ifp"), F.posexplode(
        F.array(*[_block("fp", b) for b in range(BLOCKS)])).alias("b", "v")).withColumn("m", F.explode(masks)).select(
        "ik", "k", "ifp", "b", F.col("v").bitwiseXOR(F.col("m")).alias("v"))
    probe = fps.select("wkey", "k", "fp", F.posexplode(F.array(*[_block("fp", b) for b in range(BLOCKS)])).alias("b", "v"))
    xor = F.col("fp").bitwiseXOR(F.col("ifp"))
    first_near = F.lit(BLOCKS)
    for b in reversed(range(BLOCKS)):
        first_near = F.when(F.bit_count(F.shiftrightunsigned(xor, BLOCK_BITS * b).bitwiseAND((1 << BLOCK_BITS) - 1)) <= near, b).otherwise(first_near)
    # The index is 2,517 x 4 rows an item; a merge join keeps it off the driver.
    found = probe.join(index.hint("merge"), ["k", "b", "v"]).filter((F.bit_count(xor) <= radius) & (first_near == F.col("b"))).select(
        "wkey", "ik", F.bit_count(xor).alias("distance"))
    found = saved(found, "near-prints")

    # --- exact check of what was found
    ws = distinct.select("wkey", "weight", F.size("sh").alias("wn"), _tagged("sh").alias("wt"))
    its = it.select("ik", F.size("sh").alias("n"), _tagged("sh").alias("t"))
    both = F.size(F.array_intersect("wt", "t"))
    alike = found.join(ws, "wkey").join(its, "ik").select(
        "wkey", "ik", "weight", "distance", (both / (F.col("wn") + F.col("n") - both)).alias("similarity")).filter(
        F.col("similarity") >= similarity)

    # --- back to the documents; a pair's window was laid around a shared rare shingle, so it is in `own`
    alike = alike.groupBy("wkey").agg(F.max("weight").alias("weight"), F.collect_list(
        F.struct("ik", "distance", "similarity")).alias("m"))
    pairs = join_hot(own.select("doc", "item", "ik", "start", F.size("w").alias("n_words"), "wkey"), alike, ["wkey"], "weight")
    pairs = pairs.select("doc", "item", "ik", "start", "n_words", F.explode("m").alias("m")).filter("ik = m.ik")
    best = pairs.groupBy("doc", "item").agg(F.max(F.struct(
        F.col("m.similarity").alias("similarity"), (-F.col("start")).alias("start"), "n_words",
        F.col("m.distance").alias("distance"))).alias("b"))
    return best.select(F.col("doc").alias(id_col), F.col("item").alias(item_col), (-F.col("b.start")).alias("start"),
                       "b.n_words", "b.similarity", "b.distance")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """The rows of ``docs`` without those whose document holds a window like some item."""
    leaks = find_leaks(docs, items, id_col, **how).select(F.col(id_col).alias("_leak")).distinct()
    return docs.join(leaks, F.col(id_col).eqNullSafe(F.col("_leak")), "left_anti")


@query("op4_decontamination")
def op4_decontamination(spark, sf):
    """Every pair of a whole document and a benchmark item it holds."""
    return find_leaks(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"))
