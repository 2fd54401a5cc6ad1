"""Helpers of the corpus operators: row keys, tables in the shared folder, ranks and components."""

from __future__ import annotations

import gc
import sys
import tempfile
import types
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of the word rule [^\x20\x09-\x0D]+; bytes.split() cuts at exactly these bytes.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see: spark.checkpoint.dir, or a new one in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="jobtide-"))
    return context.getCheckpointDir().rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write and reread as Parquet in the shared folder: cuts the lineage, survives lost executors."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished steps now, not when the driver next runs short of heap."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def worker_state() -> dict:
    """A dictionary that outlives the task in a Python worker that Spark uses again; for caches alone."""
    return sys.modules.setdefault("_jobtide_worker_state", types.ModuleType("_jobtide_worker_state")).__dict__


def row_key(doc_id: str, text: str) -> Column:
    """A text key of one document row, never null; rows alike in id and text share it."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("null")),
                       F.hex(F.xxhash64(F.col(text))), F.length(whole).cast("string"))


def row_hash(doc_id: str, text: str) -> tuple[Column, Column]:
    """The key of a document row as two 64-bit hashes, for tables with many rows of one document."""
    return F.xxhash64(doc_id, text), F.xxhash64(text, F.lit("row"), doc_id)


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b): one row (node, root) per linked node, root the smallest.

    Alternates large-star and small-star steps, each an aggregate and a join on the node; no
    neighbour list is built, so a node with a third of all links is only a skewed join. Every
    step is a written table; the loop ends when a round leaves the links as they were.
    """
    spark = links.sparkSession

    def state(edges: DataFrame):
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = saved(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct(), "links")
    seen = state(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = saved(large.where("a <> b").distinct(), "large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))))
        edges = saved(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .where("a <> b").distinct(), "small")
        now = state(edges)
        if now == seen:
            break
        seen = now
    release(spark)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
