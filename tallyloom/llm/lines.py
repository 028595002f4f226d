"""Line dedup: lines that many documents share stay in one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import query, table
from .util import SPACES, ascii_lower, digest, join_hot, saved


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """Drops shared lines; adds ``n_lines`` (before) and ``n_dropped``, replaces the text.

    A line's key is the line stripped of ASCII white space at both ends, A-Z lower-cased.
    Keys of at least ``min_chars`` code points found in at least ``min_docs`` documents lose
    all their lines except in the smallest id that holds them (there, all of them stay).

    Lines are exploded with their positions and hashed once, into a table of keys, ids and
    positions in the shared folder; from it they are counted per distinct document. A key that many documents share is looked up
    by broadcast (at most 10,000 such keys, whatever the data). What moves with its text is
    each document once, to meet the positions it loses.

    Null or empty text is one empty line. Rows with the same id are one document when
    documents are counted; each row is cut by itself, so repeated rows stay repeated. Rows
    without an id count as one more document, which comes last. Other columns pass through;
    an input column named ``n_lines`` or ``n_dropped`` is replaced.
    """
    keep = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    d = docs.select(
        F.struct(*[F.col(c) for c in keep if c != text_col]).alias("_row"), F.col(id_col).alias("_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
    ).withColumn("_own", digest(F.col("_text")))
    lines = d.select("_id", "_own", F.posexplode(F.split("_text", "\n")).alias("_pos", "_line")).select(
        "_id", "_own", "_pos", ascii_lower(F.btrim("_line", F.lit(SPACES))).alias("_key"))
    found = saved(lines.filter(F.length("_key") >= min_chars).select(
        digest(F.col("_key")).alias("_h"), "_id", "_own", "_pos"), "line-keys")
    shared = (
        found.groupBy("_h", "_id").agg(F.count(F.lit(1)).alias("_w"))
        .groupBy("_h").agg(F.count(F.lit(1)).alias("_n"), F.sum("_w").alias("_w"), F.min("_id").alias("_first"))
        .filter(F.col("_n") >= min_docs)
    )
    lost = (
        join_hot(found, shared, ["_h"], "_w")
        .filter(~F.col("_id").eqNullSafe(F.col("_first")))
        .groupBy(F.col("_id").alias("_lid"), F.col("_own").alias("_lown"))
        .agg(F.collect_set("_pos").alias("_lost"))
    )
    out = d.join(lost, F.col("_id").eqNullSafe(F.col("_lid")) & (F.col("_own") == F.col("_lown")), "left").select(
        "_row", "_text", "_lost", F.split("_text", "\n").alias("_parts"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_parts") - 1), F.col("_lost"))
    text = F.when(F.col("_lost").isNull(), F.col("_text")).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(F.col("_parts"), i)), "\n"))
    return out.select(
        *[(text if c == text_col else F.col(f"_row.`{c}`")).alias(c) for c in keep],
        F.size("_parts").cast("long").alias("n_lines"),
        F.coalesce(F.size("_lost"), F.lit(0)).cast("long").alias("n_dropped"),
    )


_STRIP = "trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


@query("op9_line_dedup", f"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT doc_id, pos, line,
             translate({_STRIP}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key
      HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.first AS gone FROM k LEFT JOIN s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id""")
def op9_line_dedup(spark, sf):
    """Every whole text, split at newlines; digest of what stays."""
    out = dedup_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
