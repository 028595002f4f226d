"""Each stage against the brute-force versions of its operator's tests."""

import hashlib

import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline as C
from tallyloom.llm import bpe

import test_decontam as decontam_tests
import test_lines as line_tests
import test_setjoin as join_tests

SF = "/root/testdata/sf0.001"


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def steps(spark):
    from tallyloom.llm.util import saved
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in C.STAGES:
        docs.append(saved(stage(spark, docs[-1], SF), "test-stage"))
    return docs


def test_columns(steps):
    assert all(d.columns == steps[0].columns for d in steps[:-1])


def test_quality(spark, steps):
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = dict(rows(steps[1]))
    assert left.items() <= dict(rows(steps[0])).items()
    good = [d for d, q in quality.items() if q == 1]
    assert sum(d in left for d in good) >= 0.95 * len(good)


def test_lines(steps):
    want = line_tests.brute(rows(steps[1]))
    assert sorted(rows(steps[2]), key=str) == sorted(((d, t) for d, t, _, _ in want), key=str)
    assert all(r.n_chars == len(r.text) for r in steps[2].collect())


def test_near(steps):
    before = rows(steps[2])
    want = [(d, t) for (d, t), r in zip(sorted(before, key=lambda x: str(x[0])), sorted(join_tests.brute(before), key=lambda x: str(x[0])))
            if r[1] == r[0]]
    assert sorted(rows(steps[3]), key=str) == sorted(want, key=str)


def test_benchmark(spark, steps):
    items = rows(spark.read.parquet(f"{SF}/benchmark.parquet").withColumnRenamed("item_id", "doc_id"))
    found = {d for d, _ in decontam_tests.brute(rows(steps[3]), items)}
    assert sorted(r[0] for r in rows(steps[4])) == sorted(d for d, _ in rows(steps[3]) if d not in found)


def test_tokens(steps):
    ranks = {t: i for i, t in enumerate(bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = dict(rows(steps[4]))
    got = steps[5].collect()
    assert {r.doc_id for r in got} == set(text) and len(got) == len(text) > 0
    for r in got:
        assert r.tokens == enc.encode_ordinary(text[r.doc_id])
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_run(spark, steps):
    assert sorted(r.doc_id for r in C.run(spark, SF).select("doc_id").collect()) == sorted(r.doc_id for r in steps[5].collect())
