"""Daily posting files to raw parquet, each file once.

The daily batches accumulate in one folder. A file stream with the available-now trigger picks
up only the files that arrived since the last run, remembers them in its checkpoint, and stops.
A batch of the stream is a folder of its own, named by its number and overwritten if the batch
has to run again, so a failed attempt leaves nothing behind that a scan would read.
All fields of a payload are landed, those that nobody listed as text. Beside the batches, a table
of the newest row of each id is kept up to date by bucket, so repeats across days cost as much as
the day's batch, not as the whole history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from jobtide.plans.postings import newest_first
from jobtide.plans.refresh import merge_first, scan
from jobtide.sources.readers import LIVE_FIELDS, dedup_batch, found_type, tag_batch

# adzuna_<query>_<location>_<date>.json
_NAMED = r"([^/]*?)_([^_/]*)_(\d{8})\.json$"
_INNER = ["_file", "_changed", "_place"]


def _paths(kind: str) -> list[tuple[str, ...]]:
    """The paths of all leaves of a found STRUCT type."""
    def leaves(struct: StructType, before: tuple[str, ...]) -> list[tuple[str, ...]]:
        found = []
        for f in struct.fields:
            here = (*before, f.name)
            found += leaves(f.dataType, here) if isinstance(f.dataType, StructType) and f.dataType.fields else [here]
        return found

    return leaves(DataType.fromDDL(kind), ())


def _field(path: tuple[str, ...], kind: str) -> Column:
    """A field of the variant ``v``; other types than the wanted one are NULL, but all are text."""
    quoted = [f"['{n}']" if "'" not in n else f'["{n}"]' for n in path]
    return F.try_variant_get("v", "$" + "".join(quoted), kind).alias(".".join(path))


def posting_fields(rows: DataFrame) -> DataFrame:
    """Variants ``v``, an object each, to the listed fields with their types and all others that any row has, as text."""
    kind = found_type(rows.withColumn("json", F.to_json("v")), "json")
    listed = {tuple(name.split(".")): t for name, t in LIVE_FIELDS.items()}
    others = [p for p in (_paths(kind) if kind else []) if p not in listed and not any("'" in n and '"' in n for n in p)]
    rest = [c for c in rows.columns if c != "v"]
    return rows.select(*[_field(p, t) for p, t in listed.items()], *[_field(p, "string") for p in others], *rest)


def split_batch(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(postings, rejects) of files with ``value``, their text, ``_file`` and ``_changed``.

    A file that is no JSON object or list of objects is rejected whole. Files without search marks get those of their
    name, and as fetch time the one they were changed at. Within a file the first row of an id counts; rows without an
    id all stay.
    """
    objects = lambda kind: F.try_variant_get("doc", "$", kind)
    read = batch.withColumn("doc", F.try_parse_json("value")).withColumn(
        "rows", F.coalesce(objects("array<map<string, variant>>"), F.when(
            objects("map<string, variant>").isNotNull(), F.array(objects("map<string, variant>")))))
    whole = F.col("rows").isNotNull() & ~F.exists("rows", lambda r: r.isNull())
    rejects = read.where(~F.coalesce(whole, F.lit(False))).select(F.col("_file").alias("file"), F.col("value").alias("text"))
    each = F.coalesce(F.try_variant_get("doc", "$", "array<variant>"), F.array("doc"))
    rows = read.where(whole).select("_file", "_changed", F.posexplode(each).alias("_place", "v"))
    rows = posting_fields(rows)
    name = F.element_at(F.split("_file", "/"), -1)
    part = lambda n: F.regexp_extract(name, _NAMED, n)
    known = lambda c: F.when(c != "", c)
    query = F.regexp_replace(F.regexp_replace(part(1), "^adzuna_", ""), "[_-]", " ")
    tagged = tag_batch(rows, known(query), F.coalesce(known(part(2)), F.lit("all")),
                       F.date_format("_changed", "yyyy-MM-dd'T'HH:mm:ss"), only_missing=True)
    return dedup_batch(tagged, "id", ["_place"], within=["_file"]).drop(*_INNER), rejects


def land_live_postings(spark: SparkSession, inbox: str, out: str, checkpoint: str, files_per_trigger: int = 1000,
                       latest: str | None = None, buckets: int = 256) -> None:
    """Land all new JSON files of ``inbox`` as ``out/batch-<n>`` and return when done.

    Unreadable files go to ``out/rejects/batch-<n>`` with their text. ``latest`` is where the newest row of each id
    is kept, with the listed fields.
    """
    stream = (
        spark.readStream.option("wholetext", True)
        .option("maxFilesPerTrigger", files_per_trigger)
        .text(inbox)
        .select("value", F.col("_metadata.file_path").alias("_file"),
                F.col("_metadata.file_modification_time").alias("_changed"))
    )

    if latest and scan(spark, latest) is None:  # batches that were landed without it
        fields = ", ".join(f"`{name}` {kind}" for name, kind in LIVE_FIELDS.items())
        earlier = scan(spark, f"{out}/batch-*", fields)
        if earlier is not None:
            merge_first(earlier, latest, "id", newest_first(), buckets, 1 << 30)

    def land(batch: DataFrame, number: int) -> None:
        postings, rejects = split_batch(batch)
        path = f"{out}/batch-{number:06d}"
        postings.write.mode("overwrite").parquet(path)
        if not rejects.isEmpty():
            rejects.write.mode("overwrite").parquet(f"{out}/rejects/batch-{number:06d}")
        if latest:
            landed = spark.read.parquet(path).select(*[f"`{c}`" for c in LIVE_FIELDS])
            merge_first(landed, latest, "id", newest_first(), buckets, number)

    (stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
