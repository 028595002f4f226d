import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest

from tallyloom.llm import align as L
from tallyloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
A_PATH, B_PATH = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
TEXTS = [
    "Hello world, this is a test of  two   vocabularies.\n\nNew\tline", None, "", " ", "x", "  leading", "trailing  ",
    "naïve façade – ünïcödé 日本語 🎉 \x00 \x7f", "▁ is changed to a space", "<|endoftext|> and <s> </s> <0x0A> <unk>",
    "ﬁ ① Å é  　x", "a" * 5000, "word " * 4000, "12345 67890 3.14159 it's don't we'll", "\r\n\x0b\x0c", "the the the the",
    "Hello world, this is a test of  two   vocabularies.\n\nNew\tline",
]


@pytest.fixture(scope="module")
def both():
    with open(A_PATH, encoding="utf-8") as f, open(B_PATH, "rb") as g:
        return L.byte_vocabulary(f.read()), L.piece_vocabulary(g.read())


def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(A_PATH)
    t.encode_special_tokens = True
    return t, SentencePieceProcessor(model_file=B_PATH)


def brute(texts):
    """(a ids, b ids, groups, links) of each text, token by token."""
    t, p = libraries()
    letters = L.byte_letters()
    out = []
    for text in texts:
        empty = ([], [], [], [])
        if not text:
            out.append(empty)
            continue
        a = t.encode(" " + text, add_special_tokens=False).ids
        b = p.encode(text)
        ab = [bytes(letters[c] for c in t.id_to_token(i)) for i in a]
        bb = [bytes([int(p.id_to_piece(i)[3:5], 16)]) if p.is_byte(i) else p.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not b"".join(ab) == b"".join(bb) == (" " + text).encode():
            out.append(empty)
            continue
        span = lambda parts: [(sum(map(len, parts[:0])) + s, s + len(x)) for s, x in zip(np.cumsum([0] + [len(q) for q in parts]).tolist(), parts)]
        sa, sb = span(ab), span(bb)
        ends = sorted({e for _, e in sa} & {e for _, e in sb})
        groups, links, x, y, first = [], [], 0, 0, 0
        for e in ends:
            ga = [i for i in range(x, len(sa)) if sa[i][1] <= e] if len(sa) < 300 else None
            nx = x
            while nx < len(sa) and sa[nx][1] <= e:
                nx += 1
            ny = y
            while ny < len(sb) and sb[ny][1] <= e:
                ny += 1
            assert ga is None or len(ga) == nx - x
            groups.append((a[x:nx], b[y:ny]))
            links += [(i, j) for i in range(x, nx) for j in range(y, ny) if sa[i][0] < sb[j][1] and sb[j][0] < sa[i][1]]
            x, y = nx, ny
        out.append((a, b, groups, links))
    return out


def report(texts):
    aligned = brute(texts)
    docs, best = Counter(), defaultdict(int)
    for a, b, _, links in aligned:
        docs.update({(a[i], b[j]) for i, j in links})
    for (a, _), n in docs.items():
        best[a] = max(best[a], n)
    out = []
    for a, b, groups, links in aligned:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        n = [docs[a[i], b[j]] for i, j in links]
        out.append((len(a), len(b), len(groups), len(links), sum(docs[a[i], b[j]] == best[a[i]] for i, j in links), sum(n),
                    hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return out


@pytest.mark.parametrize("lane", [1, 7, 1024])
def test_lockstep_in_lanes_of_any_length(both, lane, monkeypatch):
    monkeypatch.setattr(L.lockstep, "__defaults__", (lane,))
    got = L.align_texts(*both, TEXTS)
    at = {c: 0 for c in L.ARRAYS}
    for k, (a, b, groups, links) in enumerate(brute(TEXTS)):
        row = {}
        for c in L.ARRAYS:
            values, sizes = got[c]
            row[c] = values[at[c]:at[c] + sizes[k]].tolist()
            at[c] += sizes[k]
        assert (row["a_ids"], row["b_ids"]) == (a, b)
        assert list(zip(row["link_a"], row["link_b"])) == links
        ends = np.cumsum([[len(x), len(y)] for x, y in groups], axis=0).reshape(-1, 2).tolist()
        assert list(map(list, zip(row["a_cuts"], row["b_cuts"]))) == ends


@pytest.mark.parametrize("most", [1, 1_000_000])
def test_report_against_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(L, "HOT_PAIRS", most)           # 1: no pair is broadcast
    df = spark.createDataFrame([(i // 2, t, 5) for i, t in enumerate(TEXTS)], "doc_id long, text string, n_a int").repartition(3)
    out = L.alignment_report(df, A_PATH, B_PATH, keep=["doc_id", "n_a", "text"])
    assert out.columns == ["doc_id", "text", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = Counter(tuple(r) for r in out.collect())
    assert got == Counter((i // 2, t, *w) for i, (t, w) in enumerate(zip(TEXTS, report(TEXTS))))
    assert L.alignment_report(df.limit(0), A_PATH, B_PATH).count() == 0


def test_general_output_keeps_columns(spark):
    df = spark.createDataFrame([(1, "a tokenizer"), (None, None)], "`odd name` long, text string").selectExpr("*", "1 AS a_ids")
    out = L.align(df, A_PATH, B_PATH)
    assert out.columns == ["odd name", "text", *L.ARRAYS]
    rows = {r["odd name"]: r for r in out.collect()}
    assert rows[None].a_ids == [] and rows[1].a_cuts[-1] == len(rows[1].a_ids)


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    want = dict(zip(docs, report(docs.values())))
    out = QUERIES["op12_alignment"](spark, SMALL)
    got = {r[0]: tuple(r)[1:] for r in out.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()}
    assert got == want
