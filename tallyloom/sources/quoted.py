"""CSV with line breaks in quoted fields, one large file read by many tasks."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import cut_lineage

WHOLE, HEAD, TAIL, MIDDLE = range(4)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, line): physical lines, and the byte range of the file that they were read from. A range is
    read in order by one task."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range: whether it holds an odd number of quotes, and a file's first record if it ends in its first range."""
    def out(row: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([row[0]], pa.string()), pa.array([row[1]], pa.int64()), pa.array([row[2] % 2], pa.int32()),
             pa.array([row[4]], pa.string())], names=["file", "block", "odd", "header"])

    row: list = []                    # file, range, quotes, lines of the first record, that record
    for batch in batches:
        for file, block, line in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if row[:2] != [file, block]:
                if row:
                    yield out(row)
                row = [file, block, 0, [], None]
            row[2] += line.count('"')
            if block == 0 and row[4] is None:
                row[3].append(line)
                if row[2] % 2 == 0:
                    row[4] = "\n".join(row[3])
    if row:
        yield out(row)


def survey(lines: DataFrame) -> DataFrame:
    """(file, block, open, header): whether a range begins inside quotes, that is, after an odd number of them, and
    the file's first record beside its first range. One row per range leaves a task; they are added up in order per file."""
    seen = cut_lineage(lines.mapInArrow(_survey, "file string, block long, odd int, header string"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return seen.select("file", "block", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("open"), "header")


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joins the lines of each record. Lines before a range's first record, and a record its last line
    leaves open, are given as the pieces they are. ``first`` marks what begins a file."""
    at, held, inside, head, new = None, [], False, False, False

    def out(rows: list) -> pa.RecordBatch:
        types = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.bool_())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
            names=["file", "block", "kind", "record", "first"])

    for batch in batches:
        rows = []
        for file, block, is_open, line in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if (file, block) != at:
                if held:
                    rows.append((*at, MIDDLE if head else TAIL, "\n".join(held), new))
                at, held, inside, head, new = (file, block), [], is_open, is_open, block == 0
            held.append(line)
            if line.count('"') % 2:
                inside = not inside
            if not inside:
                rows.append((file, block, HEAD if head else WHOLE, "\n".join(held), new))
                held, head, new = [], False, False
        if rows:
            yield out(rows)
    if held:
        yield out([(*at, MIDDLE if head else TAIL, "\n".join(held), new)])


def records(lines: DataFrame, ranges: DataFrame) -> DataFrame:
    """(record, first): all records of quoted CSV files as text; ``first`` marks a file's header.

    Every task starts at the first record that begins in its range. Only records that cross the end of
    a range are put together from pieces, of which a range has two at most; no other text is shuffled.
    """
    # A row per byte range (some 128 MB) of the input.
    marked = lines.join(F.broadcast(ranges.select("file", "block", "open")), ["file", "block"]).select("file", "block", "open", "line")
    found = marked.mapInArrow(_assemble, "file string, block long, kind int, record string, first boolean")
    # A range's first piece ends a record, its last one begins one.
    tail = F.col("kind") == TAIL
    order = Window.partitionBy("file").orderBy("block", tail)
    joined = found.filter(F.col("kind") != WHOLE).withColumn("_r", F.sum(tail.cast("int")).over(order)).groupBy("file", "_r").agg(
        F.sort_array(F.collect_list(F.struct("block", tail.alias("tail"), "record"))).alias("p"), F.max("first").alias("first")).select(
        F.array_join(F.transform("p", lambda x: x["record"]), "\n").alias("record"), "first")
    every = found.filter(F.col("kind") == WHOLE).select("record", "first").unionByName(joined)
    return every.select(F.regexp_replace("record", "\r$", "").alias("record"), "first").filter(F.col("record") != "")


def read_quoted(spark: SparkSession, path: str) -> DataFrame:
    """All columns, as strings, of CSV files in which quoted fields may hold line breaks, under the names in
    the header, which every file must have alike. Quotes in a quoted field are doubled.

    A file is read by as many tasks as it has ranges (``spark.sql.files.maxPartitionBytes``). The first pass counts
    the quotes of each range, so that the second knows for each whether it begins inside quotes.
    """
    lines = _lines(spark, path)
    ranges = cut_lineage(survey(lines))
    rows = records(lines, ranges)
    first = ranges.filter(F.col("block") == 0)
    # Files whose header does not end in their first range are rare: those are looked up among the records.
    heads = first.select("header") if not first.filter("header IS NULL").limit(1).count() else rows.filter("first").select("record")
    names = [r[0] for r in heads.toDF("h").select(F.regexp_replace("h", "\r$", "").alias("h")).distinct().limit(2).collect()]
    if len(names) > 1:
        raise ValueError("the files' headers differ")
    header = next(csv.reader(io.StringIO(names[0].lstrip("\ufeff"), newline=""))) if names else []
    if not header:
        return spark.createDataFrame([], StructType([]))
    schema = StructType([StructField(c, StringType()) for c in header])
    spelled = ", ".join(f"`{c.replace('`', '``')}` string" for c in header)
    row = F.from_csv("record", F.lit(spelled), {"quote": '"', "escape": '"', "multiLine": "true"})
    out = rows.filter(~F.col("first")).select(row.alias("_c"))
    return out.select(*[F.col("_c").getField(f.name).alias(f.name) for f in schema])
