import heapq
import random
import zlib
from collections import Counter, defaultdict

import pytest

from tallyloom.llm import shards as S
from tallyloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def longest_first(sizes, k):
    heap = [(0, i) for i in range(k)]
    for s in sorted(sizes, reverse=True):
        load, i = heap[0]
        heapq.heapreplace(heap, (load + s, i))
    return sorted(load for load, _ in heap)


def check(rows, texts, k):
    """Groups whole, slots gapless, sizes right; returns the loads."""
    where, slots, loads = {}, defaultdict(list), Counter({i: 0 for i in range(k)})
    for r, t in zip(rows, texts, strict=True):
        raw = (t or "").encode()
        assert (r["size"], r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
        assert where.setdefault(raw, r.shard) == r.shard
        slots[r.shard].append(r.slot)
        loads[r.shard] += r["size"]
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    return sorted(loads.values())


@pytest.mark.parametrize("seed", range(40))
def test_run_equals_one_by_one(seed):
    r = random.Random(seed)
    loads = [r.randint(0, 50) * r.choice([1, 1000]) for _ in range(r.randint(1, 9))]
    count, size = r.randint(1, 400), r.randint(1, 60)
    heap = [(x, i) for i, x in enumerate(loads)]
    heapq.heapify(heap)
    want = [0] * len(loads)
    for _ in range(count):
        x, i = heap[0]
        heapq.heapreplace(heap, (x + size, i))
        want[i] += 1
    end = [x + n * size for x, n in zip(loads, want, strict=True)]
    assert S.deal_run(loads, count, size) == want
    assert loads == end


ROWS = ([(i, "x" * (i * 37 % 900)) for i in range(300)] + [(500, None), (501, ""), (None, "null id"), (None, None)]
        + [(600 + i, "the same long text " * 40) for i in range(200)] + [(7, "ü" * 40_000)] * 2 + [(8, "z" * 300_000)])


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_loads_equal_a_plain_heap(spark, shards):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    rows = S.assign_shards(df, shards).collect()
    assert sorted((r.doc_id, r.text) for r in rows if r.doc_id is not None and r.text) == sorted(
        (i, t) for i, t in ROWS if i is not None and t)
    assert len(rows) == len(ROWS)
    sizes = Counter()
    for _, t in ROWS:
        sizes[t or ""] += len((t or "").encode()) + 1
    assert check(rows, [r.text for r in rows], shards) == longest_first(sizes.values(), shards)


def test_rounded_classes_stay_near(spark, monkeypatch):
    monkeypatch.setattr(S, "EXACT_BELOW", 16)
    monkeypatch.setattr(S, "LARGE_SHARE", 4)
    monkeypatch.setattr(S, "GROUP_ROWS", 50)          # several buckets for one class and shard
    r = random.Random(1)
    rows = [(i, f"{i}" + "y" * r.randint(4000, 9000)) for i in range(700)]
    got = S.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect()
    loads = check(got, [x.text for x in got], 8)
    assert loads[-1] - loads[0] < 0.02 * loads[0]


def test_groups_by_column_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame(
        [(i, f"t{i}", None if i % 5 == 0 else i % 5, 1, 2) for i in range(60)],
        "doc_id long, text string, key int, size int, _shard int")
    out = S.assign_shards(df, 4, group=["key"])
    assert out.columns == ["doc_id", "text", "key", "_shard", "size", "text_crc32", "shard", "slot"]
    rows = out.collect()
    assert len({(r.key, r.shard) for r in rows}) == 5 and {r._shard for r in rows} == {2}
    assert S.assign_shards(df.limit(0)).count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = QUERIES["op13_sharding"](spark, SMALL)
    assert dict(out.dtypes) == {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string",
                                "shard": "int", "slot": "bigint", "grown_shard": "int"}
    rows = {r.doc_id: r for r in out.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert rows.keys() == texts.keys() and {r.law for r in rows.values()} == {"bytes"}
    sizes = Counter()
    for t in texts.values():
        sizes[t or ""] += len((t or "").encode()) + 1
    got = check(list(rows.values()), [texts[i] for i in rows], 16)
    assert got == longest_first(sizes.values(), 16)
