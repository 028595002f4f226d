"""Shared folders, joins on hot keys and text keys used by several operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space, and the letters that ASCII lower-casing changes.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; a local folder only where the session is local."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        base = tempfile.mkdtemp(prefix="tallyloom-llm-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def saved(df: DataFrame, name: str, arrow_rows: int | None = None) -> DataFrame:
    """Writes the rows once to the shared folder and reads them back; later uses cost a scan.

    ``arrow_rows`` bounds the rows of a batch that goes to Python while they are written:
    texts of a few thousand characters make batches of Spark's default 10,000 rows large.
    """
    spark, path = df.sparkSession, shared_folder(df.sparkSession, name)
    before = spark.conf.get(ARROW_ROWS)
    if arrow_rows:
        spark.conf.set(ARROW_ROWS, min(int(before), arrow_rows) if int(before) > 0 else arrow_rows)
    try:
        df.write.parquet(path)
    finally:
        if arrow_rows:
            spark.conf.set(ARROW_ROWS, before)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def is_blank(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES)) == ""


def digest(text: Column) -> Column:
    """16 bytes: at 10**12 keys the chance of any clash is about 10**-15."""
    return F.unhex(F.md5(text))


def join_hot(left: DataFrame, right: DataFrame, keys: Sequence[str], weight: str,
                   most: int = 10_000, how: str = "inner") -> DataFrame:
    """Inner (or left) join on ``keys`` of which a few may hold most of ``left``.

    ``right`` has one row per key and in ``weight`` the number of left rows with it. Keys
    with at least sum(weight) / ``most`` rows (and over 1,000) go by broadcast; there can be at most ``most``
    of them, whatever the data. The others meet in a shuffled join in which no key is hot.
    ``left`` is evaluated twice: hand over something that ends in a shuffle or a table.
    """
    keys = list(keys)
    total = right.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("t")).scalar()
    right = right.withColumn("_hot", (F.col(weight) * most >= total) & (F.col(weight) > 1000))
    hot, cold = right.filter("_hot").drop("_hot"), right.filter("NOT _hot").drop("_hot")
    first = left.join(F.broadcast(hot), keys)
    rest = left.join(F.broadcast(hot.select(keys)), keys, "left_anti").join(cold, keys, how)
    return first.unionByName(rest)
