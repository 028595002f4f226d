import hashlib

import public_tokenizers as P
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from tallyloom.llm import bpe
from tallyloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {t: i for i, t in enumerate(bpe.read_ranks(PATH))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_ranks(PATH), P.PATTERN)


def encoded(encoder, texts):
    ids, sizes = encoder.encode(texts)
    out, at = [], 0
    for n in sizes:
        out.append(ids[at:at + n].tolist())
        at += n
    return out


def test_hard_texts(encoder, reference):
    texts = ["", " ", "  \n\t x", "don't we'll", "a" * 5000, "ab" * 400, "\x1c\x1d\x85᠎　 z", "é" * 300,
             "😀😀 123456 ½ ٣", "<|endoftext|>", "​﻿", "x" * 257, "\n" * 3000 + "y", "0" * 999,
             "thethethe" * 200]
    assert encoded(encoder, texts) == [reference.encode_ordinary(t) for t in texts]


def test_every_white_space_is_split_alike(encoder, reference):
    texts = [f"a{chr(c)}b {chr(c)}" for c in [*range(0x3100), *range(0xFE00, 0x10000)]]
    assert encoded(encoder, texts) == [reference.encode_ordinary(t) for t in texts]


def test_long_and_matrix_merges_agree(encoder):
    m = encoder.merges
    for p in (b"thereisaninghere" * 9, "üöäß".encode() * 20, bytes(range(256)) * 1, b"aaaaaaab" * 30):
        piece = p[:256]
        assert m.merge_long(piece).tolist() == m.encode_pieces([piece])[0].tolist()


def test_query_equals_library(spark, reference):
    got = {r.doc_id: r for r in QUERIES["op10_byte_bpe"](spark, SMALL).collect()}
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = reference.encode_ordinary(r.text or "")
        g = got[r.doc_id]
        assert g.n_tokens == len(ids)
        assert g.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert g.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_nulls_repeats_and_extra_columns(spark, reference):
    df = spark.createDataFrame([(1, None, 5), (1, None, 5), (None, "", None), (2, "hi there", 7)],
                               "doc_id long, text string, ids int")
    out = bpe.encode(df, PATH, P.PATTERN, decoded=True)
    assert out.columns == ["doc_id", "text", "ids", "decoded"]
    rows = sorted(((r.doc_id or 0, r.ids, bytes(r.decoded)) for r in out.collect()), key=str)
    assert rows == [(0, [], b""), (1, [], b""), (1, [], b""), (2, reference.encode_ordinary("hi there"), b"hi there")]
    back = bpe.decode(out.select("ids"), PATH)
    assert sorted(bytes(r.decoded) for r in back.collect()) == [b"", b"", b"", b"hi there"]
    assert bpe.encode(df.limit(0), PATH, P.PATTERN).count() == 0


def test_cache_starts_afresh(encoder, reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 5)
    own = bpe.Encoder(bpe.read_ranks(PATH), P.PATTERN)
    texts = ["one two three four five six", "seven eight nine ten", "one seven"]
    for t in texts:
        assert encoded(own, [t]) == [reference.encode_ordinary(t)]
