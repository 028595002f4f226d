import base64
import bz2
import gzip
import hashlib
import lzma
import re
import urllib.parse
import zlib

from tallyloom.llm.queries import QUERIES
from tallyloom.llm.secrets import scan, scan_text

SMALL = "/root/testdata/sf0.01"
KEY = "AKIA" + "Q7" * 8


def brute(text):
    """The plain patterns, written as they are stated."""
    out = []
    for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"""
                         r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    out += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [s for _, _, s in sorted(out)]


def spans(text):
    return [(k, a, b, v) for k, a, b, _, v in scan_text(text)[0]]


def test_plain_matches_as_stated():
    texts = ["secret=token:abcdefgh", "SECRET = 'abcdef' password:short", "to\u212Aen=abcdefg paſſword=abcdefg",
             "AKIAAKIA" + "A" * 8, "AKIA" + "Z" * 15, KEY + "é", "0" * 23 + " " + "f" * 24 + "g", "é😀 token= abc/def+=",
             "api_key\"  :  \"k.e-y_1\" apikey=123456", ""]
    for t in texts:
        got = [f"{k}:{a}:{b}" for k, a, b, d, _ in scan_text(t)[0] if d == 0]
        assert got == brute(t), t


def test_layers_and_their_spans():
    inner = f"password = hunter2hunter2"
    b64 = base64.b64encode(inner.encode()).decode()
    assert spans(f"é {b64} z") == [("assign", 2, 2 + len(b64.rstrip("=")), "base64")]
    packed = base64.b64encode(gzip.compress(inner.encode())).decode()
    assert spans(f"x {packed}") == [("assign", 2, 2 + len(packed), "base64>compressed")]
    for pack in (zlib.compress, bz2.compress, lambda b: gzip.compress(zlib.compress(b))):
        run = base64.b64encode(pack(inner.encode())).decode()
        assert ("assign", 2, 2 + len(run)) in [s[:3] for s in spans(f"x {run}")]
    url = urllib.parse.quote("token=abcdefg", safe="").replace("t", "%74", 1)
    assert spans("a " + url) == [("assign", 2, 2 + len(url), "url")]
    twice = urllib.parse.quote(urllib.parse.quote('token="äbcdefgh'.replace("ä", "a")))
    assert spans(twice)[-1][0] == "assign" and "url>url" in spans(twice)[-1][3]
    assert spans("password: " + "".join(f"\\u{ord(c):04x}" for c in "abcdef")) == [("assign", 0, 46, "unicode")]
    assert spans("&#112;assword=&#x61;bcdef") == [("assign", 0, 25, "unicode")]
    deep = base64.b64encode(urllib.parse.quote(KEY[:10] + "%" + "51" + KEY[11:]).encode()).decode()
    assert any(k == "access" for k, *_ in spans(deep))


def test_payloads_that_are_not_clean_utf8():
    inner = b"password = hunter2hunter2"
    b64 = lambda raw: base64.b64encode(raw).decode()
    for raw in (gzip.compress(b"\x1b[31mred\x1b[0m " + inner), gzip.compress("é ".encode("latin-1") + inner),
                gzip.compress(b"\x00\xff\xfe\x01\x80" * 40 + inner), zlib.compress(inner.decode().encode("utf-16")),
                gzip.compress(b"nothing here") + gzip.compress(inner), bz2.compress(b"nothing") + bz2.compress(inner),
                lzma.compress(b"nothing") + lzma.compress(inner), gzip.compress(gzip.compress(b"a") + gzip.compress(inner))):
        run = b64(raw)
        assert ("assign", 2, 2 + len(run.rstrip("="))) in [(k, a, min(b, 2 + len(run.rstrip("=")))) for k, a, b, _ in spans(f"x {run}")]
    for raw in (inner.decode().encode("utf-16"), inner.decode().encode("utf-16-le"), inner.decode().encode("utf-16-be"),
                "größe=1; ".encode("latin-1") + inner, b"log \x1b[31m" + inner,
                "é".encode("latin-1") + inner, b"\xfe\xed\xfe\xed\x00\x00\x00\x02\x80\x91" + inner):
        assert any(k == "assign" and v == "base64" for k, _, _, v in spans(f"x {b64(raw)}")), raw
    assert not scan_text("x " + b64(gzip.compress(b"a" * 600) + gzip.compress(b"b" * 600)), most=1000)[1]


def test_cycles_and_bombs_end():
    assert spans("%25" * 50) == []
    nest = "secret=abcdefgh"
    for _ in range(6):
        nest = base64.b64encode(nest.encode()).decode()
    assert any(k == "assign" and v.count("base64") == 6 for k, _, _, v in spans(nest))
    bomb = base64.b64encode(zlib.compress(b"a " * 5_000)).decode()
    found, whole = scan_text(f"token=abcdef {bomb}", most=1000)
    assert ("assign", 0, 12) in [f[:3] for f in found] and not whole


def test_query(spark):
    rows = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = QUERIES["op6_secret_scan"](spark, SMALL).collect()
    assert len(got) == len(rows)
    some = 0
    for r in got:
        want = brute(rows[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(w.startswith(k) for w in want) for k in ("assign", "access", "hex")]
        assert set(want) <= set(r.spans.split(",")) | {""} - {""}
        some += len(want)
    assert some > 0


def test_rows(spark):
    df = spark.createDataFrame([(1, None, 3), (None, "", 4), (2, "token=abcdefg", 5), (2, "token=abcdefg", 5),
                                (3, "x" * 200_000 + " " + KEY, 6)], "doc_id long, text string, found int")
    out = scan(df)
    assert out.columns == ["doc_id", "text", "found", "unwrapped"]
    got = sorted((r.doc_id or 0, [(f.kind, f.start, f.end) for f in r.found]) for r in out.collect())
    assert got == [(0, []), (1, []), (2, [("assign", 0, 13)]), (2, [("assign", 0, 13)]),
                   (3, [("access", 200_001, 200_021)])]
    assert scan(df.limit(0)).count() == 0
