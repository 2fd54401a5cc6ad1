"""Spark session settings shared by the command line, the tests and the bench."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution does the run-time sizing: it coalesces small shuffle partitions, splits
# skewed join partitions (also where that costs one more shuffle) and turns a sort-merge join
# into a broadcast join only after the finished shuffle has shown the side to be small. The
# broadcast threshold stays at Spark's default: file sizes understate what a table takes in memory.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.enabled": "false",
    # Recording the Python call site of every Column takes longer than planning the query.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "jobtide", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the engine's settings; ``master`` stays unset under spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate files that the driver and all executors see.

    It is the one spark.checkpoint.dir names. Only a local session may go without.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir: executors of a local cluster have folders of their own")
    return tempfile.mkdtemp(prefix="jobtide-")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: what several steps read is computed once, whatever executor is lost."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
