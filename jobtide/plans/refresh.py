"""Tables that grow by batches: only what a batch touches is read and written again.

Both kinds are folders of partitions that Spark replaces one by one (dynamic partition overwrite) when a job commits;
all others keep their files, and a job that fails leaves the table as it was.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from jobtide.operators.windows import latest_per_key
from jobtide.session import written

BUCKET = "_bucket"


def scan(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """The table at a path, or None where there is none yet."""
    reader = spark.read.schema(schema) if schema else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Write the partitions that df has rows of; others stay as they are. A partition is few files."""
    (df.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path))


# --- partitions built from all batches -----------------------------------------------------


def in_partitions(rows: Sequence[Row], by: Sequence[str]) -> Column:
    """A condition on the partition columns that a scan can prune by: the partitions of the given rows."""
    *outer, last = by
    groups = defaultdict(list)
    for row in rows:
        groups[tuple(row[c] for c in outer)].append(row[last])
    conditions = []
    for values, lasts in groups.items():
        known = [v for v in lasts if v is not None]
        found = F.col(last).isin(known) if known else F.lit(False)
        found = found | F.col(last).isNull() if len(known) < len(lasts) else found
        conditions.append(reduce(lambda a, b: a & b, [
            found, *[F.col(c).isNull() if v is None else F.col(c) == v for c, v in zip(outer, values)]]))
    return reduce(lambda a, b: a | b, conditions)


def refresh(arrived: DataFrame, path: str, by: Sequence[str], batch: str,
            build: Callable[[DataFrame], DataFrame]) -> list[Row]:
    """Bring the table at ``path`` up to all rows that have arrived; returns the partitions written.

    ``arrived`` has the partition columns ``by`` and the ``batch`` a row came with; ``build`` makes a partition's rows
    of all its arrived rows, and at least one. ``<path>_seen`` records which batches a partition has seen. Partitions
    with a batch they have not seen are built anew. The record is written last: a run that fails in between builds the
    same partitions again. Batches are added, never changed; the list of partitions is what passes the driver.
    """
    spark = arrived.sparkSession
    pairs = arrived.select(*by, F.col(batch).cast("string").alias("__batch")).distinct()
    seen = scan(spark, f"{path}_seen", ddl(pairs))
    if seen is not None:
        same = reduce(lambda a, b: a & b, [pairs[c].eqNullSafe(seen[c]) for c in pairs.columns])
        pairs = pairs.join(seen, same, "left_anti")
    news = written(pairs, "news")
    touched = news.select(*by).distinct().collect()
    if touched:
        replace_partitions(build(arrived.where(in_partitions(touched, by))), path, by)
        news.write.mode("append").parquet(f"{path}_seen")
    return touched


def rebuild(source: DataFrame, path: str, by: Sequence[str], touched: Sequence[Row],
            build: Callable[[DataFrame], DataFrame]) -> None:
    """Build the partitions of a table that follows another one, for those of its partitions that were written."""
    if touched:
        replace_partitions(build(source.where(in_partitions(touched, by))), path, by)


def ddl(df: DataFrame | StructType) -> str:
    fields = df.fields if isinstance(df, StructType) else df.schema.fields
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)


def refreshed(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table at ``path`` with the columns and types of ``like``."""
    return spark.read.schema(ddl(like)).parquet(path).select(*like.columns)


# --- one row per key over all batches --------------------------------------------------------


def merge_first(batch: DataFrame, path: str, key: str, order: Sequence[Column], buckets: int = 256,
                number: int = 0) -> list[int]:
    """Merge a batch into the table at ``path`` that has one row per key, the first in order; returns its buckets.

    Keys are dealt to buckets by hash, and only buckets that the batch has keys of are read and written. Choose as
    many that a bucket is a file of usual size; a batch of n keys then touches n files at most, however long the
    history. Rows without a key all stay, below the batch's ``number``. Merging a batch again changes nothing. The
    numbers of the touched buckets are what passes the driver.
    """
    spark = batch.sparkSession
    dealt = batch.withColumn(BUCKET, F.when(F.col(key).isNull(), -1 - number).otherwise(
        F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets))).cast("int"))
    dealt = written(dealt, "batch")
    keyed = dealt.where(F.col(BUCKET) >= 0)
    touched = sorted(r[0] for r in keyed.select(BUCKET).distinct().collect())
    state = scan(spark, path, ddl(dealt)) if touched else None
    if state is not None:
        keyed = state.where(F.col(BUCKET).isin(touched)).unionByName(keyed)
    # Written beside the table first: it is read until the merged rows are complete.
    merged = written(latest_per_key(keyed, [BUCKET, key], order).unionByName(dealt.where(F.col(BUCKET) < 0)), "merged")
    replace_partitions(merged, path, [BUCKET])
    return touched


def merged_rows(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame | None:
    """The rows of a table that :func:`merge_first` keeps, or None where there is none yet."""
    table = scan(spark, path, f"{ddl(schema)}, {BUCKET} int" if schema else None)
    return None if table is None else table.drop(BUCKET)
