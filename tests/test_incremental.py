"""Tables that grow by batches: equal to a full build, and nothing untouched is read or written."""

from __future__ import annotations

import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from jobtide.operators import windows
from jobtide.plans import marts, refresh
from jobtide.sources import writers

ROWS = "source string, month string, batch string, id int, v int"


def files(path):
    return {os.path.join(folder, f) for folder, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def sums(rows):
    return rows.groupBy("source", "month").agg(F.sum("v").alias("v"), F.count("*").alias("n"))


@pytest.fixture
def arrived(spark):
    draw = random.Random(2)
    rows = [(draw.choice(["a", "b", None]), draw.choice(["2024-01", "2024-02", None]), "1", i, i) for i in range(200)]
    rows += [("a", "2024-02", "2", 900, 7), ("c", "2024-01", "2", 901, 8), (None, None, "3", 902, 9)]
    return spark.createDataFrame(rows, ROWS)


def test_refresh_equals_a_full_build_and_leaves_the_rest(spark, arrived, tmp_path):
    path, by = f"{tmp_path}/t", ["source", "month"]
    first = refresh.refresh(arrived.where("batch = '1'"), path, by, "batch", sums)
    assert len(first) == 9
    old = files(path)
    second = refresh.refresh(arrived, path, by, "batch", sums)
    assert {tuple(r) for r in second} == {("a", "2024-02"), ("c", "2024-01"), (None, None)}
    kept = {f for f in files(path) if "source=b" in f or "month=2024-01" in f and "source=c" not in f}
    assert kept and kept <= old
    got = refresh.refreshed(spark, path, sums(arrived))
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, sums(arrived).collect()))
    now = files(path)
    assert refresh.refresh(arrived, path, by, "batch", sums) == [] and files(path) == now


def test_refresh_after_a_failure_repeats_the_partitions(spark, arrived, tmp_path):
    path, by = f"{tmp_path}/t", ["source", "month"]
    refresh.refresh(arrived.where("batch = '1'"), path, by, "batch", sums)

    def fails(rows):
        return sums(rows.withColumn("v", F.raise_error(F.lit("stopped")).cast("int")))

    with pytest.raises(Exception, match="stopped"):
        refresh.refresh(arrived, path, by, "batch", fails)
    before = refresh.refreshed(spark, path, sums(arrived)).collect()
    assert Counter(map(tuple, before)) == Counter(map(tuple, sums(arrived.where("batch = '1'")).collect()))
    assert len(refresh.refresh(arrived, path, by, "batch", sums)) == 3
    assert refresh.refreshed(spark, path, sums(arrived)).count() == sums(arrived).count()


def test_scans_are_pruned_to_the_partitions(spark, arrived, tmp_path):
    arrived.write.partitionBy("source", "month").parquet(f"{tmp_path}/in")
    rows = spark.read.schema(ROWS).parquet(f"{tmp_path}/in")
    some = [r for r in rows.select("source", "month").distinct().collect() if r.source == "a" or r.month is None]
    plan = rows.where(refresh.in_partitions(some, ["source", "month"]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "DataFilters: []" in text
    assert plan.count() == rows.where("source = 'a' OR month IS NULL").count()


def test_history_equals_one_dedup(spark, tmp_path):
    draw = random.Random(3)
    rows = [(None if i % 50 == 0 else f"k{draw.randrange(80)}", i, draw.randrange(1000)) for i in range(600)]
    order = windows.latest_first("t", "v")
    df = spark.createDataFrame(rows, "k string, v int, t int")
    path = f"{tmp_path}/h"
    for number in range(3):
        refresh.merge_first(df.where(F.col("v") % 3 == number), path, "k", order, 8, number)
    refresh.merge_first(df.where(F.col("v") % 3 == 1), path, "k", order, 8, 1)
    want = windows.latest_per_key(df.where("k IS NOT NULL"), "k", order).unionByName(df.where("k IS NULL"))
    assert Counter(map(tuple, refresh.merged_rows(spark, path).select(*df.columns).collect())) == Counter(map(tuple, want.collect()))


def test_history_reads_and_writes_touched_buckets_only(spark, tmp_path):
    path, order = f"{tmp_path}/h", windows.latest_first("t")
    base = spark.range(0, 5000).selectExpr("concat('k', id) AS k", "id AS t")
    assert refresh.merge_first(base, path, "k", order, 64) == list(range(64))
    old = files(path)
    touched = refresh.merge_first(base.limit(3).withColumn("t", F.lit(9000).cast("bigint")), path, "k", order, 64, 1)
    assert 1 <= len(touched) <= 3
    changed = {f for f in old ^ files(path)}
    assert {int(f.split("_bucket=")[1].split("/")[0]) for f in changed} == set(touched)
    assert refresh.merged_rows(spark, path).where("t = 9000").count() == 3
    assert refresh.merge_first(base.limit(0), path, "k", order, 64, 2) == []
    assert refresh.merged_rows(spark, path).count() == 5000


def test_stored_buckets_join_without_a_shuffle(spark, tmp_path):
    by = ["posting_id", "data_source"]
    postings = spark.range(0, 3000).selectExpr(
        "concat('p', id % 700) AS posting_id", "concat('s', id % 2) AS data_source",
        "if(id % 3 = 0, '15-1252.00', null) AS onet_soc_code", "'exact_match' AS soc_match_type",
        "timestampadd(DAY, id % 90, TIMESTAMP_NTZ '2024-01-01 00:00:00') AS posted_at")
    skills = spark.range(0, 2000).selectExpr(
        "concat('p', id % 900) AS posting_id", "concat('skill', id % 40) AS skill_name", "concat('s', id % 2) AS data_source").distinct()
    plain = marts.posting_skill_joined(skills, postings)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        counts = writers.save_bucketed(marts.posting_counts(postings), f"{tmp_path}/c", by, 8, "test_counts")
        named = writers.save_bucketed(skills, f"{tmp_path}/s", by, 8, "test_skills")
        joined = marts.skill_mentions(named, counts)
        text = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text and "SortMergeJoin" in text
        grouped = joined.groupBy("posting_id", "data_source").count() if "data_source" in joined.columns else joined
        assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString()
        assert Counter(map(tuple, joined.collect())) == Counter(map(tuple, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE IF EXISTS test_counts")
        spark.sql("DROP TABLE IF EXISTS test_skills")
