"""Similarity join of documents on word shingles, by recursive splitting on chosen tokens."""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator, Sequence
from functools import reduce
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .registry import query, table
from .util import join_hot, saved

SHINGLE = 5
WIDTH = 64                       # tokens of an embedded set: (i, i-th minimum hash)
SMALL = 256                      # buckets up to this many sets are compared outright
DEPTH = 3                        # deeper buckets are compared outright, in tiles
TILE = 512
_MULT = np.random.default_rng(11).integers(1, 2**63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def normal_text(text: Column) -> Column:
    """Lower-cased words, one space between them."""
    return F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+", " "))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_set(normal: str) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of five words (of all words, if fewer)."""
    if not normal:
        return np.zeros(0, np.uint64)
    import xxhash
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, normal.encode("utf-8", "replace").split(b" ")), np.uint64)
    k = min(SHINGLE, h.size)
    s = h[:h.size - k + 1]
    for j in range(1, k):
        s = _mix(s * np.uint64(0x9E3779B97F4A7C15) + h[j:h.size - k + 1 + j])
    return np.unique(s)


def embedded(shingles: np.ndarray) -> np.ndarray:
    """The WIDTH minimum hashes of a set, as ints."""
    out = np.full(WIDTH, 2**64 - 1, np.uint64)
    for k in range(0, shingles.size, 8192):
        out = np.minimum(out, (_mix(shingles[None, k:k + 8192] * _MULT[:, None])).min(axis=1))
    return (out >> np.uint64(32)).astype(np.uint32).view(np.int32)


def runs_for(similarity: float, recall: float, depth: int = DEPTH) -> int:
    """Runs after which a pair of just this similarity has met with the wanted probability.
    A node passes a set on through one token, in a quarter of cases two: the pair lives on
    by a branching process."""
    lost, p = 0.0, similarity
    for _ in range(depth):
        q = (1 - p) + p * lost
        lost = 0.75 * q + 0.25 * q * q
    return max(1, ceil(log(1 - recall) / log(lost)))


def _overlaps(sets: Sequence[np.ndarray], columns: int = 4096) -> np.ndarray:
    """How many values each pair of sets shares; values of only one set take no part."""
    n = len(sets)
    row = np.repeat(np.arange(n), [s.size for s in sets])
    values, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.cumsum(count > 1) - 1
    several = count[inverse] > 1
    row, col = row[several], rank[inverse[several]]
    out = np.zeros((n, n), np.float32)
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    for a in range(0, int(col[-1]) + 1 if col.size else 0, columns):
        lo, hi = np.searchsorted(col, [a, a + columns])
        part = np.zeros((n, min(columns, int(col[hi - 1]) - a + 1) if hi > lo else 1), np.float32)
        part[row[lo:hi], col[lo:hi] - a] = 1
        out += part @ part.T
    return out


def compare_tile(path: int, across: bool, side: np.ndarray, sets: list[np.ndarray], leaves: list[np.ndarray],
                 similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of each set of a tile, and a label of its component within the tile (-1: none).

    A pair that shares several leaves counts in the one with the smallest number only.
    """
    n = len(sets)
    size = np.array([s.size for s in sets], np.float64)
    inter = _overlaps(sets)
    alike = inter >= similarity * (size[:, None] + size[None, :] - inter) - 1e-6
    np.fill_diagonal(alike, False)
    if across:
        alike &= side[:, None] != side[None, :]
    component = np.full(n, -1)
    if alike.any():
        # Components first: every link serves, also one that counts elsewhere.
        label = np.arange(n)
        while True:
            low = np.where(alike, label[None, :], n).min(axis=1)
            new = np.minimum(label, low)
            new = np.minimum(new, new[new])
            if (new == label).all():
                break
            label = new
        linked = alike.any(axis=1)
        component[linked] = label[linked]
        earlier = _overlaps([x[x < path] for x in leaves]) > 0
        alike &= ~earlier
    return alike.sum(axis=1), component


def _sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, id, normal) -> (key, id, sig)"""
    for b in batches:
        sig = [embedded(shingle_set(t.as_py())) for t in b.column(2)]
        flat = pa.array(np.concatenate(sig) if sig else np.zeros(0, np.int32), pa.int32())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sig) + 1, dtype=np.int32) * WIDTH), flat)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists], names=["key", "id", "sig"])


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, normal, leaves, tiles) -> a row for each tile with the set."""
    kind = pa.schema([("path", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("side", pa.int64()),
                      ("key", pa.binary()), ("leaves", pa.list_(pa.int64())), ("set", pa.binary())])
    for b in batches:
        for i in range(b.num_rows):
            raw = shingle_set(b.column(1)[i].as_py()).tobytes()
            key, leaves = b.column(0)[i].as_py(), b.column(2)[i].as_py()
            tiles = b.column(3)[i].as_py()
            step = max(1, 2_000_000 // (len(raw) + 1))
            for k in range(0, len(tiles), step):
                yield pa.RecordBatch.from_pylist(
                    [{**t, "key": key, "leaves": leaves, "set": raw} for t in tiles[k:k + step]], schema=kind)


def _compare(similarity: float):
    """Rows of tiles in order -> (key, links, hub): a hub is a component of one tile, so it
    has at most 2 x TILE members."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, rows = None, {}

        def close() -> list[tuple[bytes, int, bytes | None]]:
            keys = sorted(rows)
            if len(keys) < 2:
                return []
            got = [rows[k] for k in keys]
            links, label = compare_tile(tile[0], tile[1] != tile[2], np.array([r[0] for r in got]),
                                        [np.frombuffer(r[2], np.uint64) for r in got],
                                        [np.array(r[1], np.int64) for r in got], similarity)
            hub = hashlib.md5(repr(tile).encode()).digest()
            return [(k, int(n), hub + keys[c]) for k, n, c in zip(keys, links, label, strict=True) if c >= 0]

        def made(out: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.int64()),
                pa.array([r[2] for r in out], pa.binary())], names=["key", "links", "hub"])

        out: list = []
        for batch in batches:
            path, a, b, side = (batch.column(i).to_pylist() for i in range(4))
            for i in range(batch.num_rows):
                if (path[i], a[i], b[i]) != tile:
                    out += close()
                    tile, rows = (path[i], a[i], b[i]), {}
                    if len(out) > 10_000:
                        yield made(out)
                        out = []
                rows[batch.column(4)[i].as_py()] = (side[i], batch.column(5)[i].as_py(), batch.column(6)[i].as_py())
        out += close() if tile else []
        if out:
            yield made(out)

    return run


def components(members: DataFrame) -> DataFrame:
    """(key, component): keys that share a hub, directly or through others, and the smallest
    of them. Labels go to the hubs and back until nothing changes; each round is a table in
    the shared folder. Hubs must be small groups, so no join meets a hot key."""
    labels = saved(members.select("key", F.col("key").alias("component")).distinct(), "labels")
    while True:
        low = members.join(labels, "key").groupBy("hub").agg(F.min("component").alias("low"))
        new = members.join(low, "hub").groupBy("key").agg(F.min("low").alias("component"))
        new = saved(new.join(labels.withColumnRenamed("component", "old"), "key"), "labels")
        if not new.filter("component <> old").limit(1).count():
            return new.select("key", "component")
        labels = new.select("key", "component")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = 0.8,
                    recall: float = 0.99) -> DataFrame:
    """One row per row of ``docs``: the id, ``class_id``, ``n_links``, ``n_copies`` and
    ``text_key`` (MD5 of the words).

    Two different texts are linked if the Jaccard similarity of their sets of five-word
    shingles (lower-cased, split at white space; all words of shorter texts) is at least
    ``similarity``. Rows of equal words are copies; they are one text from here on.
    ``n_links`` is the number of other texts linked to the row's text, ``n_copies`` the number
    of rows with its words, ``class_id`` the smallest id of its connected component.

    Chosen-path join: sets are embedded as 64 tokens (i, i-th minimum hash). A run sends each
    set to a bucket for each token that its node samples, the same for all sets of a node:
    one, in a quarter of cases two. Buckets of at most 256 sets are compared outright; larger ones are
    split again, to depth 3, and what is still large is compared in tiles of 512 x 512, each
    a task's work, so neither a bucket nor a group of copies is ever one task. Runs are
    repeated until a pair of just ``similarity`` has met with probability ``recall``; closer
    pairs meet more surely. Whole shingle sets decide, never estimates, and pairs are never
    written: a tile gives counts and component labels. A pair that met in several
    buckets counts in one.

    Texts without words have no links: class_id is their own id (null if that is null),
    n_copies 1, text_key null. Rows with null ids take part; a class without any id has class_id null.
    Repeated rows are copies. Other columns are not needed.
    """
    base = docs.select(F.col(id_col).alias("id"), normal_text(F.col(text_col)).alias("normal"))
    full = base.filter("normal <> ''").select(F.unhex(F.md5("normal")).alias("key"), "id", "normal")
    id_type = docs.schema[id_col].dataType.simpleString()
    signed = saved(full.mapInArrow(_sets_of, f"key binary, id {id_type}, sig array<int>"), "sketches", 1000)
    texts = saved(signed.groupBy("key").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")), "texts")
    sigs = signed.join(texts.select("key", "id"), (signed.key == texts.key) & signed.id.eqNullSafe(texts.id)).select(
        signed.key, "sig").dropDuplicates(["key"])

    # --- split: level 0 samples the same tokens of every set in a run
    rng = random.Random(7)
    picks = [(r, c) for r in range(runs_for(similarity, recall)) for c in rng.sample(range(WIDTH), 2 if rng.random() < 0.25 else 1)]
    roots = F.array(*[F.xxhash64(F.lit(r), F.lit(c), F.get("sig", F.lit(c))) for r, c in picks])
    nodes = saved(sigs.select("key", "sig", F.explode(F.array_distinct(roots)).alias("path")).select("key", "path"), "nodes")
    leaves = []
    for depth in range(DEPTH):
        sizes = nodes.groupBy("path").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        shared = saved(join_hot(nodes, sizes, ["path"], "n"), "shared")
        last = depth == DEPTH - 1
        big = shared.filter(F.col("n") > SMALL)
        leaves.append(shared if last else shared.filter(F.col("n") <= SMALL))
        if last or not big.limit(1).count():
            break
        c = lambda k: F.pmod(F.xxhash64("path", F.lit(k)), F.lit(WIDTH)).cast("int")
        child = lambda k: F.xxhash64("path", c(k), F.get("sig", c(k)))
        kids = F.when(F.pmod(F.xxhash64("path", F.lit(3)), F.lit(4)) == 0, F.array(child(1), child(2))).otherwise(F.array(child(1)))
        nodes = saved(big.drop("n").join(sigs, "key").select(
            "key", F.explode(F.array_distinct(kids)).alias("path")), "nodes")
    leaf = reduce(DataFrame.unionByName, leaves)

    # --- tiles of each leaf, with the sets of those texts that have company
    blocks = F.ceil(F.col("n") / TILE)
    own = F.pmod(F.xxhash64("key", F.lit(5)), blocks)
    tiles = leaf.select("key", "path", own.alias("side"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("o")).select(
        "key", "path", F.struct("path", F.least("side", "o").alias("a"), F.greatest("side", "o").alias("b"), "side").alias("t"))
    plan = tiles.groupBy("key").agg(F.collect_set("path").alias("leaves"), F.collect_list("t").alias("tiles")).join(
        texts.select("key", F.col("id").alias("first")), "key")
    whole = full.join(plan.withColumnRenamed("key", "k"), (F.col("key") == F.col("k")) & F.col("id").eqNullSafe(F.col("first")))
    rows = whole.select("key", "normal", "leaves", "tiles").mapInArrow(
        _spread, "path long, a long, b long, side long, key binary, leaves array<long>, set binary")
    found = saved(rows.repartition("path", "a", "b").sortWithinPartitions("path", "a", "b").mapInArrow(
        _compare(similarity), "key binary, links long, hub binary"), "links", 1000)

    # --- classes
    classes = components(found).join(found.groupBy("key").agg(F.sum("links").alias("links")), "key")
    named = classes.join(texts, "key").select("key", "component", "links", "id")
    by_class = named.groupBy("component").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("w"))
    named = join_hot(named, by_class, ["component"], "w").select("key", "class_id", "links")
    per_text = texts.join(named, "key", "left").select(
        "key", "copies", F.when(F.col("links").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"))
    out = join_hot(signed.select("key", "id"), per_text, ["key"], "copies").select(
        F.col("id").alias(id_col), "class_id", "n_links", F.col("copies").alias("n_copies"), F.col("key").alias("text_key"))
    bare = base.filter("normal = ''").select(
        F.col("id").alias(id_col), F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.lit(1).cast("long").alias("n_copies"), F.lit(None).cast("binary").alias("text_key"))
    return out.unionByName(bare)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` of which nothing similar has a smaller id: one of each class.

    Of rows with that id and equal words one stays, also in a class without any id. Rows
    without words stay as they are.
    """
    near = near_duplicates(docs.select(id_col, text_col), id_col, text_col, **how).filter("text_key IS NOT NULL")
    row = lambda key: F.md5(F.concat_ws("|", F.coalesce(F.col(id_col).cast("string"), F.lit("none")), key))
    gone = (F.col(id_col) != F.col("class_id")) | (F.col(id_col).isNull() & F.col("class_id").isNotNull())
    acts = near.groupBy(row(F.hex("text_key")).alias("_row")).agg(
        F.max(F.coalesce(gone, F.lit(False))).alias("_gone"), F.count(F.lit(1)).alias("_rows")).filter("_gone OR _rows > 1")
    d = docs.withColumn("_row", row(F.upper(F.md5(normal_text(F.col(text_col)))))).join(acts, "_row", "left")
    d = d.filter("_gone IS NULL OR NOT _gone").withColumn(
        "_nth", F.row_number().over(Window.partitionBy("_row").orderBy(F.lit(1))))
    return d.filter("_rows IS NULL OR _nth = 1").select(*docs.columns)


@query("op7_chosen_path_join")
def op7_chosen_path_join(spark, sf):
    """Every whole document: its class, and how many different texts are similar to it."""
    return near_duplicates(table(spark, sf, "documents").select("doc_id", "text")).drop("text_key")
