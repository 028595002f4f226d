import base64
import gzip
import hashlib

import duckdb
import pytest

from tallyloom.llm import warc
from tallyloom.llm.queries import QUERIES, SQL
from tallyloom.llm.util import shared_folder

SMALL = "/root/testdata/sf0.001"
COLS = "page_id, payload_bytes, payload_digest, record_type, refers_to, n_requests"


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{SMALL}/pages.parquet'")
    want = con.execute(f"select {COLS} from ({SQL['op1_warc_transactions']}) order by 1").fetchall()
    got = QUERIES["op1_warc_transactions"](spark, SMALL).select(*COLS.split(", ")).orderBy("page_id").collect()
    assert [tuple(r) for r in got] == want and len(want) > 0


def captures(spark, rows, schema="page_id long, url string, html string", **how):
    folder = shared_folder(spark, "warc-test")
    warc.write_captures(spark.createDataFrame(rows, schema), folder, **how)
    return warc.assemble(warc.read_records(spark, folder))


def rows_of(df):
    return sorted(((r.metadata.fields.get("page_id"), r.response.record_type, r.response.payload_bytes,
                    r.original and r.original.fields["page_id"], bytes(r.response.payload or b"").decode())
                   for r in df.collect()), key=str)


def test_hard_pages(spark):
    tricky = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n\nüñ\n"
    big = "é" * 200_000
    rows = [(5, "http://a b\r\nX: y", tricky), (3, None, tricky), (4, "u", None), (7, "u", ""), (9, "u", big),
            (9, "u", big), (None, "u", "solo"), (11, "u", "twice"), (12, "u", "twice"), (12, "u", "twice")]
    got = rows_of(captures(spark, rows))
    n = len(tricky.encode())
    assert got == sorted([
        ("3", "response", n, None, tricky), ("5", "revisit", n, "3", ""), ("4", "response", 0, None, ""),
        ("7", "revisit", 0, "4", ""), ("9", "response", 400_000, None, big), ("9", "response", 400_000, None, big),
        (None, "response", 4, None, "solo"), ("11", "response", 5, None, "twice"), ("12", "revisit", 5, "11", ""),
        ("12", "revisit", 5, "11", "")], key=str)


def test_smaller_payloads_are_responses(spark):
    got = rows_of(captures(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], min_bytes=5))
    assert [(r[0], r[1], r[3]) for r in got] == [
        ("1", "response", None), ("2", "response", None), ("3", "response", None), ("4", "revisit", "3")]


def test_binary_payloads_and_empty_table(spark):
    raw = bytes(range(256)) * 3
    df = captures(spark, [(1, "u", bytearray(raw))], "page_id long, url string, html binary")
    r = df.first()
    assert bytes(r.response.payload) == raw and r.response.digest_ok
    assert r.response.payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
    assert captures(spark, []).count() == 0


def record(kind, rid, *extra, block=b""):
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: {rid}", *extra, f"Content-Length: {len(block)}"]
    return b"WARC/1.0\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def test_foreign_archives(spark, tmp_path):
    """Either direction of concurrent-to, a hop, several targets, gzip members, orphans."""
    recs = [
        record("warcinfo", "<w>"), record("response", "<r1>", "WARC-Concurrent-To: <q1>", block=b"body"),
        record("request", "<q1>"), record("metadata", "<m1>", "WARC-Concurrent-To: <q1>"),
        record("response", "<r2>"), record("request", "<q2>", "WARC-Concurrent-To: <r2>", "WARC-Concurrent-To: <r3>"),
        record("request", "<q0>", "warc-concurrent-to: <r2>"), record("response", "<r3>"),
        record("request", "<lost>", "WARC-Concurrent-To: <nowhere>"), record("response", "<alone>"),
    ]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in recs[:5]))
    (tmp_path / "b.warc").write_bytes(b"".join(recs[5:]))
    got = {r.record_id: (r.request and r.request.record_id, r.n_requests, r.metadata and r.metadata.record_id)
           for r in warc.assemble(warc.read_records(spark, str(tmp_path))).collect()}
    assert got == {"<r1>": ("<q1>", 1, "<m1>"), "<r2>": ("<q0>", 2, None), "<r3>": ("<q2>", 1, None),
                   "<alone>": (None, 0, None)}


def test_damaged_archives_raise(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(record("response", "<r>", block=b"12345")[:-8])
    with pytest.raises(Exception, match="cut off"):
        warc.read_records(spark, str(tmp_path)).collect()
