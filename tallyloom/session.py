"""Session defaults and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Only planner switches; sizes (executors, partitions, memory) belong to the
# cluster that submits the job.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "tallyloom", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def _checkpoint_ready(spark: SparkSession) -> None:
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="tallyloom-ckpt-")
    sc.setCheckpointDir(shared)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder the cluster names; survives lost executors."""
    _checkpoint_ready(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """The rows as a table beside the checkpoints. For rounds that join their own results: a checkpoint
    keeps the planner's size of the plan it cuts, joins multiply sizes, so the number gets twice as
    many digits or more in each round and soon costs minutes to multiply. A table has its files' size."""
    spark = df.sparkSession
    _checkpoint_ready(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
