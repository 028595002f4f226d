"""Secret scans: patterns over a text and over every layer that can be decoded from it."""

from __future__ import annotations

import base64
import binascii
import bz2
import lzma
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import query, table

# The kinds in their order, and what each must look like.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
WORDS = ("passw", "secret", "token", "api")

URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})"
                    r"|&#[xX]([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
CONTROL = re.compile(r"[\x00-\x08\x0e-\x1f\x7f-\x9f]")
MOST_CHARS = 1 << 26             # decoded characters of one document; see scan()
SPAN = "array<struct<kind:string,start:long,end:long,depth:int,via:string>>"


def matches(text: str) -> Iterator[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each kind that are long enough."""
    low = text.lower()
    if any(w in low for w in WORDS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 6:
                yield "assign", m.start(), m.end()
    # A run is matched whole or not at all, so its least length may stand in the pattern.
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            yield "access", m.start(), m.end()
    for m in HEX.finditer(text):
        yield "hex", m.start(), m.end()


class Layer:
    """A text and, for each of its characters, the span of the document it comes from."""

    def __init__(self, text: str, start: np.ndarray, end: np.ndarray, depth: int, via: str):
        self.text, self.start, self.end, self.depth, self.via = text, start, end, depth, via

    def child(self, text: str, lo: np.ndarray, hi: np.ndarray, via: str) -> Layer:
        """``lo``, ``hi``: for each new character, the span of this layer it was made from."""
        return Layer(text, self.start[lo], self.end[hi - 1], self.depth + 1, f"{self.via}>{via}" if self.via else via)


def _utf8(raw: bytes) -> list[tuple[str, int, int]]:
    """Characters with their byte spans; a byte that is no part of one stands for U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        size = 1 if raw[at] < 0x80 else 2 if raw[at] >> 5 == 6 else 3 if raw[at] >> 4 == 14 else 4
        try:
            out.append((raw[at:at + size].decode(), at, at + size))
            at += size
        except UnicodeDecodeError:
            out.append(("\ufffd", at, at + 1))
            at += 1
    return [x for x in out if len(x[0]) == 1]


def _unescape(layer: Layer, pattern: re.Pattern, decode, via: str) -> Layer | None:
    """The whole layer with every escape replaced where it stands."""
    texts, lo, hi, at = [], [], [], 0
    for m in pattern.finditer(layer.text):
        new = decode(m)
        if new is None:
            continue
        texts.append(layer.text[at:m.start()])
        lo.append(np.arange(at, m.start()))
        hi.append(np.arange(at + 1, m.start() + 1))
        texts.append("".join(c for c, _, _ in new))
        lo.append(np.array([m.start() + a for _, a, _ in new], np.int64))
        hi.append(np.array([m.start() + b for _, _, b in new], np.int64))
        at = m.end()
    if not texts:
        return None
    n = len(layer.text)
    texts.append(layer.text[at:])
    lo.append(np.arange(at, n))
    hi.append(np.arange(at + 1, n + 1))
    return layer.child("".join(texts), np.concatenate(lo), np.concatenate(hi), via)


def _url(m: re.Match) -> list[tuple[str, int, int]]:
    raw = binascii.unhexlify(m.group().replace("%", ""))
    return [(c, 3 * a, 3 * b) for c, a, b in _utf8(raw)]


def _escape(m: re.Match) -> list[tuple[str, int, int]] | None:
    point = int(m.group(6)) if m.group(6) else int(next(g for g in m.groups()[:5] if g), 16)
    if point > 0x10FFFF or 0xD800 <= point < 0xE000:
        return None
    return [(chr(point), 0, m.end() - m.start())]


def _readable(raw: bytes) -> str | None:
    try:
        text = raw.decode()
    except UnicodeDecodeError:
        return None
    return text if text and not CONTROL.search(text) else None


def _decoder(raw: bytes):
    if raw[:2] == b"\x1f\x8b" or raw[:1] == b"\x78" and len(raw) > 1 and (raw[0] << 8 | raw[1]) % 31 == 0:
        return zlib.decompressobj(47)
    if raw[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if raw[:6] == b"\xfd7zXZ\0":
        return lzma.LZMADecompressor(memlimit=1 << 28)
    return None


def _unpack(raw: bytes, most: int) -> bytes | None:
    """What gzip, zlib, bzip2 or xz streams hold, one member after another up to the first bytes
    that are none; None if the first is none; raises beyond ``most`` bytes."""
    parts, size = [], 0
    while (z := _decoder(raw)) is not None:
        try:
            # One byte beyond shows that there is more.
            out = z.decompress(raw, most - size + 1)
        except (zlib.error, OSError, lzma.LZMAError, EOFError):
            break
        size += len(out)
        if size > most:
            raise OverflowError
        if not z.eof:
            break
        parts.append(out)
        raw = z.unused_data.lstrip(b"\0")  # members may be padded
    return b"".join(parts) if parts else None


def _wide(raw: bytes) -> str | None:
    """UTF-16 text by its mark or, without one, by the NULs that stand in most of its high or low bytes."""
    if len(raw) < 4:
        return None
    head = raw[:4096]
    even, odd = head[::2].count(0) / len(head[::2]), head[1::2].count(0) / len(head[1::2])
    if raw[:2] == b"\xff\xfe" or odd > 0.6 and even < 0.2:
        return raw.decode("utf-16-le", "replace").removeprefix("\ufeff")
    if raw[:2] == b"\xfe\xff" or even > 0.6 and odd < 0.2:
        return raw.decode("utf-16-be", "replace").removeprefix("\ufeff")
    return None


def _mostly_text(raw: bytes) -> str | None:
    """Bytes of which at least half are those of text; others are replaced."""
    text = raw.decode("utf-8", "replace")
    bad = text.count("\ufffd") + len(CONTROL.findall(text))
    return text if text and bad * 2 <= len(text) else None


def _base64(layer: Layer, most: int) -> Iterator[Layer]:
    for m in BASE64.finditer(layer.text):
        run = m.group().rstrip("=")
        if len(run) % 4 == 1:
            continue
        raw = base64.b64decode(run.replace("-", "+").replace("_", "/") + "=" * (-len(run) % 4))
        via, text = "base64", None
        if raw and raw[0] < 0x80 or raw[:1] >= b"\xc2":
            text = _readable(raw)
        if text is not None:
            spans = _utf8(raw)
            lo = np.array([m.start() + a * 8 // 6 for _, a, _ in spans], np.int64)
            hi = np.array([m.start() + min(-(-b * 8 // 6), len(run)) for _, _, b in spans], np.int64)
            yield layer.child(text, lo, hi, via)
            continue
        whole = lambda t, v: layer.child(t, np.full(len(t), m.start()), np.full(len(t), m.end()), v)
        inner = _unpack(raw, most)
        if inner is None:
            text = _wide(raw) or _mostly_text(raw)
            if text:
                yield whole(text, via)
        while inner is not None:  # perhaps compressed more than once
            via += ">compressed"
            last, inner = inner, _unpack(inner, most)
            if inner is None and last:
                yield whole(_wide(last) or last.decode("utf-8", "replace"), via)


def scan_text(text: str, most: int = MOST_CHARS) -> tuple[list[tuple[str, int, int, int, str]], bool]:
    """All spans (kind, start, end, depth, via), and whether everything could be unwrapped.

    A worklist starts with the text itself. Each layer is matched, then unwrapped in every
    way that applies; a layer already seen for the same span of the document is not
    unwrapped again, so texts that decode to themselves or to each other end.
    """
    n = len(text)
    work = deque([Layer(text, np.arange(n), np.arange(1, n + 1), 0, "")])
    found: dict[tuple[str, int, int], tuple[int, str]] = {}
    seen: set[tuple[str, int, int]] = set()
    total, whole = 0, True
    while work:
        layer = work.popleft()
        if not layer.text:
            continue
        mark = (layer.text, int(layer.start[0]), int(layer.end[-1]))
        if mark in seen:
            continue
        seen.add(mark)
        if layer.depth:
            total += len(layer.text)
            if total > most:
                whole = False
                break
        for kind, a, b in matches(layer.text):
            found.setdefault((kind, int(layer.start[a]), int(layer.end[b - 1])), (layer.depth, layer.via))
        if "%" in layer.text:
            work.extend(x for x in (_unescape(layer, URL, _url, "url"),) if x)
        if "\\" in layer.text or "&#" in layer.text:
            work.extend(x for x in (_unescape(layer, ESCAPE, _escape, "unicode"),) if x)
        try:
            work.extend(_base64(layer, most))
        except OverflowError:
            whole = False
    order = {k: i for i, k in enumerate(KINDS)}
    spans = sorted(((k, a, b, d, v) for (k, a, b), (d, v) in found.items()), key=lambda s: (s[1], order[s[0]], s[2]))
    return spans, whole


def scan(docs: DataFrame, text_col: str = "text", most: int = MOST_CHARS) -> DataFrame:
    """Adds ``found`` and ``unwrapped``; rows stay where they are, nothing is shuffled.

    ``found`` lists the spans of the document by start, then kind, then end, each once: in
    code points, end exclusive, with the depth of the layer that showed it (0: the text as it
    stands) and how that layer was reached. A layer is the text with all URL or all Unicode
    escapes replaced, or what a base64 run holds, directly or compressed; layers are
    unwrapped again until nothing new appears. Spans in a layer are carried back to the
    characters they were made from; in a layer that was compressed, is UTF-16 or has invalid bytes
    replaced that is its whole run. Everything that decompresses is scanned, all members of it; bytes
    that base64 holds directly are scanned if at least half are text.

    ``unwrapped`` is false only if a document decodes to more than ``most`` characters in all
    (a decompression bomb): layers found before that count, and all matches in the text
    itself always do. Null or empty text: no spans. Columns named ``found`` or ``unwrapped``
    are replaced, others pass through.
    """
    keep = [c for c in docs.columns if c not in ("found", "unwrapped")]
    src = docs.select(*keep, F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("_text"))
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                   ("depth", pa.int32()), ("via", pa.string())]))
        names = ("kind", "start", "end", "depth", "via")
        for batch in batches:
            texts = batch.column(len(keep))
            done = [scan_text(texts[i].as_py().decode("utf-8", "replace"), most) for i in range(batch.num_rows)]
            spans = pa.array([[dict(zip(names, s, strict=True)) for s in x] for x, _ in done], kind)
            cols = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*cols, spans, pa.array([w for _, w in done], pa.bool_())],
                                             names=[*keep, "found", "unwrapped"])

    return src.mapInArrow(run, f"{schema}, found {SPAN}, unwrapped boolean")


@query("op6_secret_scan")
def op6_secret_scan(spark, sf):
    """Every whole text: counts and digest of the plain matches, and all spans."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = scan(docs).drop("text")
    line = lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))
    plain = found.withColumn("plain", F.filter("found", lambda s: s.depth == 0))
    count = lambda k: F.size(F.filter("plain", lambda s: s.kind == k)).cast("long").alias(f"n_{k}")
    return plain.select(
        "doc_id", *[count(k) for k in KINDS],
        F.sha2(F.array_join(F.transform("plain", line), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("found", line), ",").alias("spans"), "unwrapped",
    )
