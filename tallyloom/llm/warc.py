"""WARC: captures written as archives, read back, and assembled from their records."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import query, table
from .util import join_hot, saved, shared_folder

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed value: base32
RECORDS = """record_id string, record_type string, target_uri string, date string,
  concurrent_to array<string>, refers_to string, content_type string, block_bytes long, http_status int,
  http_headers map<string,string>, fields map<string,string>, payload_bytes long, payload_digest string,
  digest_ok boolean, payload binary"""
SMALL_PAGE = 256 * 1024         # bytes; larger payloads are archived apart, few to a file


def base32(hex_digest: Column) -> Column:
    """Upper-case base32 of 40 hex digits: each 5 of them are 4 letters."""
    letters = []
    for k in range(8):
        n = F.conv(F.substring(hex_digest, 5 * k + 1, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            letters.append(F.substring(F.lit(ALPHABET), F.shiftright(n, shift).bitwiseAND(31) + 1, F.lit(1)))
    return F.concat(*letters)


def _urn(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *parts))
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"),
                    F.substring(h, 13, 4), F.lit("-"), F.substring(h, 17, 4), F.lit("-"), F.substring(h, 21, 12),
                    F.lit(">"))


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """One record without its last newline, which the text writer adds. Null headers are left out."""
    lines = [F.coalesce(F.concat(F.lit(f"{k}: "), v, F.lit("\r\n")), F.lit("")) for k, v in headers]
    return F.concat(F.lit("WARC/1.1\r\n"), *lines, F.lit("Content-Length: "),
                    F.octet_length(block).cast("string"), F.lit("\r\n\r\n"), block, F.lit("\r\n\r"))


def _one_line(value: Column) -> Column:
    for raw, coded in (("\r", "%0D"), ("\n", "%0A"), ("\t", "%09"), (" ", "%20")):
        value = F.replace(value, F.lit(raw), F.lit(coded))
    return value


def write_captures(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Writes a response or revisit, a request and a metadata record for every row.

    Of rows with equal payloads of at least ``min_bytes`` bytes, those with the smallest id
    are responses and the others revisits of it, without a body; smaller payloads are always
    responses. Request and metadata name their response in WARC-Concurrent-To; the metadata
    record holds the id. Archives are gzip files below ``folder/small`` (up to 1,000 pages of
    at most 256 KiB each) and, if there are larger ones, ``folder/large`` (up to 16 pages
    each), so no file outgrows a task.

    Null payload: empty. Null URL: ``about:blank``; white space in URLs is percent-coded.
    Null id: the metadata has no id line; such rows lose to any id, and among equal payloads
    without any id all are responses. Repeated rows give repeated records. Payloads are shuffled once,
    by digest, and those of very frequent payloads not at all.
    """
    p = pages.select(
        F.col(id_col).alias("id"), _one_line(F.coalesce(F.col(url_col), F.lit("about:blank"))).alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("body"),
    ).select("*", F.sha1("body").alias("digest"), F.octet_length("body").cast("long").alias("size"))
    keys = saved(p.select("id", "digest", "size"), "payload-digests")
    repeated = (
        keys.filter(F.col("size") >= min_bytes).groupBy("digest")
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("w")).filter("w > 1")
    )
    any_large = keys.filter(F.col("size") > SMALL_PAGE).limit(1).count() > 0
    p = join_hot(p, repeated, ["digest"], "w", how="left")
    revisit = (F.col("size") >= min_bytes) & F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    own = _urn(F.lit("capture"), text("id"), F.col("digest"), F.col("url"))
    # A response that is revisited is named by id and digest alone, as its revisits know no more.
    named = _urn(F.lit("first"), text("first"), F.col("digest"))
    p = p.withColumn("revisit", F.coalesce(revisit, F.lit(False))).withColumn(
        "rid", F.when(F.col("first").isNotNull() & ~F.col("revisit"), named).otherwise(own))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("size").cast("string"), F.lit("\r\n\r\n"))
    ask = F.concat(F.lit("GET "), F.col("url"), F.lit(" HTTP/1.1\r\n\r\n"))
    base = [("WARC-Target-URI", F.col("url")), ("WARC-Date", F.lit(date))]
    kind = F.when(F.col("revisit"), "revisit").otherwise("response")
    main = _record([
        ("WARC-Type", kind), ("WARC-Record-ID", F.col("rid")), *base,
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("digest")))),
        ("WARC-Profile", F.when(F.col("revisit"), F.lit(
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        ("WARC-Refers-To", F.when(F.col("revisit"), named)),
        ("Content-Type", F.lit("application/http;msgtype=response")),
    ], F.concat(http, F.when(F.col("revisit"), F.lit("")).otherwise(F.col("body").cast("string"))))
    request = _record([
        ("WARC-Type", F.lit("request")), ("WARC-Record-ID", _urn(F.lit("request"), F.col("rid"))), *base,
        ("WARC-Concurrent-To", F.col("rid")), ("Content-Type", F.lit("application/http;msgtype=request"))], ask)
    note = F.coalesce(F.concat(F.lit("page_id: "), F.col("id").cast("string"), F.lit("\r\n")), F.lit(""))
    metadata = _record([
        ("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _urn(F.lit("metadata"), F.col("rid"))), *base,
        ("WARC-Concurrent-To", F.col("rid")), ("Content-Type", F.lit("application/warc-fields"))], note)
    # The three records of a page stand together, so the writer's row limit counts pages.
    records = p.select("size", F.concat(request, F.lit("\n"), main, F.lit("\n"), metadata).alias("value"))
    parts = [("small", F.col("size") <= SMALL_PAGE, 1000)] + [("large", F.col("size") > SMALL_PAGE, 16)] * any_large
    for part, rows, most in parts:
        (records.filter(rows).select("value").write.option("compression", "gzip")
         .option("maxRecordsPerFile", most).text(f"{folder}/{part}"))


def _headers(raw: bytes) -> list[tuple[str, str]]:
    out: list[tuple[str, str]] = []
    for line in raw.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif ":" in line:
            k, v = line.split(":", 1)
            out.append((k.strip().lower(), v.strip()))
    return out


def _parse(data: bytes) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    at = 0
    while at < len(data):
        if data[at:at + 5] != b"WARC/":
            if not data[at:].strip(b"\r\n"):
                return
            raise ValueError(f"no record begins at byte {at}")
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            raise ValueError(f"the header at byte {at} does not end")
        head = _headers(data[data.find(b"\r\n", at) + 2:end])
        size = int(dict(head)["content-length"])
        if end + 4 + size > len(data):
            raise ValueError(f"the record at byte {at} is cut off")
        yield head, data[end + 4:end + 4 + size]
        at = end + 4 + size
        at += 4 if data[at:at + 4] == b"\r\n\r\n" else 0


def _row(head: list[tuple[str, str]], block: bytes, payload: bool) -> dict:
    h = dict(head)
    kind, content = h.get("warc-type", ""), h.get("content-type", "")
    row = {
        "record_id": h.get("warc-record-id"), "record_type": kind, "target_uri": h.get("warc-target-uri"),
        "date": h.get("warc-date"), "concurrent_to": [v for k, v in head if k == "warc-concurrent-to"],
        "refers_to": h.get("warc-refers-to"), "content_type": content, "block_bytes": len(block),
        "http_status": None, "http_headers": None, "fields": None, "digest_ok": None,
    }
    body = block
    if content.replace(" ", "").lower().startswith("application/http"):
        top, _, body = block.partition(b"\r\n\r\n")
        first, _, rest = top.partition(b"\r\n")
        row["http_headers"] = list(dict(_headers(rest)).items())
        word = first.split(b" ")
        row["http_status"] = int(word[1]) if first.startswith(b"HTTP/") and len(word) > 1 and word[1].isdigit() else None
    elif content.startswith("application/warc-fields"):
        row["fields"] = list(dict(_headers(block)).items())
    declared = h.get("warc-payload-digest", "").rpartition(":")[2] or None
    if kind == "revisit":  # the body is in the record that this one refers to
        size = dict(row["http_headers"] or []).get("content-length", "")
        row |= {"payload_bytes": int(size) if size.isdigit() else None, "payload_digest": declared, "payload": None}
    else:
        found = base64.b32encode(hashlib.sha1(body).digest()).decode()
        row |= {"payload_bytes": len(body), "payload_digest": found, "payload": body if payload else None,
                "digest_ok": None if declared is None else declared == found}
    return row


def read_records(spark: SparkSession, *folders: str, payload: bool = True) -> DataFrame:
    """One row per record of all archives below the folders, plain or gzip (members one after another).

    Files are read whole, one to a task at a time, and parsed by Content-Length; payloads may
    hold anything. Damaged archives raise. ``payload=False`` leaves the bytes out (size and
    digest are still those of the bytes read). A revisit's size and digest are those it states.
    """
    from pyspark.sql.types import StructType
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(folders)).select("content")
    schema = StructType.fromDDL(RECORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        for batch in batches:
            for i in range(batch.num_rows):
                data = batch.column(0)[i].as_py()
                if data[:2] == b"\x1f\x8b":
                    parts, rest = [], data
                    while rest[:2] == b"\x1f\x8b":
                        z = zlib.decompressobj(31)
                        parts.append(z.decompress(rest) + z.flush())
                        if not z.eof:
                            raise ValueError("a gzip member is cut off")
                        rest = z.unused_data
                    data = b"".join(parts)
                rows, size = [], 0
                for head, block in _parse(data):
                    rows.append(_row(head, block, payload))
                    size += len(block)
                    if size > 8_000_000 or len(rows) >= 5000:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return files.mapInArrow(run, schema)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``record_id``, ``response`` (a response or revisit),
    ``request``, ``metadata`` (the first by record id, null if there is none), their numbers
    ``n_requests`` and ``n_metadata``, and ``original``, the first metadata of the response
    that a revisit refers to.

    Records belong together if one names the other in WARC-Concurrent-To, in either
    direction, or through one record between them (metadata of a request). Auxiliary records are reduced
    to one per capture before they meet it, with map-side combining, so a response that very
    many records name is no hot key. Records without an id stand alone; a response repeated
    under one id gives as many rows. Requests and metadata whose response is nowhere give no
    capture. ``records`` is read several times: hand over a table.
    """
    fields = [c for c in records.columns if c != "payload"]
    main = records.filter(F.col("record_type").isin("response", "revisit"))
    aux = records.filter(F.col("record_type").isin("request", "metadata")).select(
        F.col("record_id").alias("aid"), F.col("record_type").alias("kind"), "concurrent_to",
        F.struct(*fields).alias("rec"))
    direct = aux.select("aid", "kind", "rec", F.explode(F.array_distinct("concurrent_to")).alias("cid"))
    back = main.select(F.col("record_id").alias("cid"), F.explode(F.array_distinct("concurrent_to")).alias("aid"))
    back = aux.drop("concurrent_to").join(back, "aid").select("aid", "kind", "rec", "cid")
    between = direct.unionByName(back).select(F.col("aid").alias("mid"), F.col("cid").alias("far"))
    hop = direct.join(between, F.col("cid") == F.col("mid")).select("aid", "kind", "rec", F.col("far").alias("cid"))
    own = (
        direct.unionByName(back).unionByName(hop).groupBy("cid", "aid", "kind").agg(F.first("rec").alias("rec"))
        .groupBy("cid").agg(*[x for k in ("request", "metadata") for x in (
            F.min_by(F.when(F.col("kind") == k, F.col("rec")), F.when(F.col("kind") == k, F.col("aid"))).alias(k),
            F.count(F.when(F.col("kind") == k, 1)).alias("n_requests" if k == "request" else "n_metadata"))])
    )
    captures = main.select("record_id", "refers_to", F.struct(*records.columns).alias("response")).join(
        own, F.col("record_id") == F.col("cid"), "left").drop("cid")
    revisited = main.filter("record_type = 'revisit'").groupBy("refers_to").agg(F.count(F.lit(1)).alias("w"))
    origin = revisited.join(own, F.col("refers_to") == F.col("cid")).select(
        "refers_to", "w", F.col("metadata").alias("original"))
    out = join_hot(captures, origin, ["refers_to"], "w", how="left")
    return out.select("record_id", "response", "request", "metadata",
                      *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("n_requests", "n_metadata")],
                      "original")


_BITS = "[" + ", ".join(f"'{i:04b}'" for i in range(16)) + "]"


@query("op1_warc_transactions", f"""
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
                  sha1(coalesce(html, '')) AS h FROM pages),
b AS (SELECT *, array_to_string(list_transform(range(1, 41),
        lambda i: {_BITS}[position(substr(h, i, 1) IN '0123456789abcdef')]), '') AS bits FROM p),
d AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr('{ALPHABET}',
        CAST(list_sum(list_transform(range(0, 5), lambda j: CAST(substr(bits, 5 * i + j + 1, 1) AS INTEGER)
        * CAST(pow(2, 4 - j) AS INTEGER))) AS INTEGER) + 1, 1)), '') AS payload_digest FROM b),
f AS (SELECT payload_digest, min(page_id) AS first FROM d GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to, CAST(1 AS BIGINT) AS n_requests
FROM d JOIN f USING (payload_digest)""")
def op1_warc_transactions(spark, sf):
    """All pages archived, read back and assembled into captures."""
    folder = shared_folder(spark, "warc")
    write_captures(table(spark, sf, "pages"), folder)
    records = saved(read_records(spark, folder, payload=False).drop("payload"), "records")
    c = assemble(records)
    return c.select(
        F.col("metadata.fields")["page_id"].cast("long").alias("page_id"),
        "response.payload_bytes", "response.payload_digest", "response.record_type",
        F.col("original.fields")["page_id"].cast("long").alias("refers_to"), "n_requests",
    )
