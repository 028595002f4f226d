"""The training-text pipeline: its stages in order, each written before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import bpe, decontam, lines, perplexity, setjoin
from tallyloom.llm.util import saved

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the n-gram classifier, trained on the trusted ones among them, keeps."""
    return perplexity.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).select(COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that several documents share stay in the first of them; n_chars counts anew."""
    return lines.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar ones."""
    return setjoin.one_of_each(docs).select(COLUMNS)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window like a benchmark item."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(COLUMNS)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, and digests of them and of the bytes they decode to."""
    import public_tokenizers

    done = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
                      decoded=True, keep=["doc_id", "lang", "source"])
    return bpe.with_digests(done.withColumn("tokens", F.col("ids")))


STAGES = [("quality classifier", quality_stage), ("line dedup", line_stage), ("chosen-path join", near_stage),
          ("benchmark decontamination", benchmark_stage), ("byte-level BPE", encode_stage)]
ORACLE_SQL = None  # the first and third stage are not expressible; tests/llm/test_pipeline.py checks the rows


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved(docs, "stage-" + name.replace(" ", "-"))
    return docs
