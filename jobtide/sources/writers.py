"""Tables and exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def table_path(root: str, layer: str, name: str) -> str:
    return f"{root}/{layer}/{name}"


def save(df: DataFrame, root: str, layer: str, name: str,
         partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a layer table and return a scan of it, which also cuts the lineage."""
    path = table_path(root, layer, name)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def save_bucketed(df: DataFrame, path: str, by: Sequence[str], buckets: int, name: str) -> DataFrame:
    """Write a catalog table in sorted buckets of ``by`` and return it.

    Tables with equal buckets join and group on ``by`` without a shuffle, however often that is done. A bucket is one
    task: choose as many that it fits one, and count or deduplicate per key first where a key may repeat without bound.
    Rows are dealt to the buckets before the write, so a bucket is one file.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    (df.repartition(buckets, *by).write.mode("overwrite").bucketBy(buckets, *by).sortBy(*by)
     .option("path", path).saveAsTable(name))
    return spark.table(name)


def export_csv(df: DataFrame, path: str, order: Sequence[Column] = ()) -> None:
    """CSV parts with a header each; sorted parts follow one another in name order."""
    (df.orderBy(*order) if order else df).write.mode("overwrite").csv(path, header=True)
