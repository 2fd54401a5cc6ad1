"""One key holds a third of all rows: results stay whole and no task gathers the group."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobtide.operators import groups, joins, windows
from jobtide.plans import marts, quality
from jobtide.sources import writers

ROWS = 60000


@pytest.fixture(scope="module")
def postings(spark):
    """A third of the rows is one source, one company and one posting id."""
    hot = F.col("id") % 3 == 0
    n = F.col("id").cast("string")
    return spark.range(0, ROWS, 1, 8).select(
        F.when(hot, "p0").otherwise(F.concat(F.lit("p"), n)).alias("posting_id"),
        F.when(hot, "adzuna").otherwise("kaggle_linkedin").alias("data_source"),
        F.when(hot, "hot").otherwise(F.concat(F.lit("c"), (F.col("id") % 900).cast("string")))
        .alias("company_name"),
        F.lit(False).alias("is_snapshot"),
        F.expr("timestampadd(DAY, id % 200, TIMESTAMP_NTZ '2024-01-01 00:00:00')").alias("posted_at"),
        F.when(F.col("id") % 5 > 0, (F.col("id") * 7919 % 400000 + 15000).cast("int"))
        .alias("annual_salary_estimate"),
        (F.col("id") % 4 == 0).alias("is_remote"),
        F.when(hot, "15-1252.00").otherwise(F.concat(F.lit("11-"), (F.col("id") % 7).cast("string")))
        .alias("onet_soc_code"),
        F.lit("exact_match").alias("soc_match_type"),
    )


def test_snapshot(postings):
    rows = postings.select("data_source", "company_name", "annual_salary_estimate", "is_remote").collect()
    got = {r.data_source: r for r in marts.market_snapshot(postings).collect()}
    by_source = defaultdict(list)
    for r in rows:
        by_source[r.data_source].append(r)
    assert set(got) == set(by_source)
    for source, members in by_source.items():
        pay = [r.annual_salary_estimate for r in members if r.annual_salary_estimate is not None]
        assert got[source].total_postings == len(members)
        assert got[source].unique_companies == len({r.company_name for r in members})
        assert got[source].postings_with_salary == len(pay)
        for column, q in (("salary_p25", 25), ("median_salary", 50), ("salary_p75", 75)):
            assert got[source][column] == int(np.floor(np.percentile(pay, q) + 0.5))


def test_repeated_posting_meets_the_join_once(spark, postings):
    """20,000 rows of one posting times its skills: counted, not multiplied out."""
    skills = spark.createDataFrame(
        [("p0", s, "adzuna") for s in ("sql", "python", "go")] + [("p1", "sql", "kaggle_linkedin")],
        "posting_id string, skill_name string, data_source string")
    joined = marts.posting_skill_joined(skills, postings)
    mentions = Counter()
    for r in joined.collect():
        mentions[r.skill_name] += r.n
    assert mentions == {"sql": 20001, "python": 20000, "go": 20000}
    # A month has one row per skill of the hot posting, however often it is repeated.
    assert joined.count() == 3 * 7 + 1


def test_hot_key_is_cut_before_the_shuffle(postings):
    order = windows.latest_first("posted_at", "posting_id", "annual_salary_estimate")
    newest = windows.latest_per_key(postings, "data_source", order)
    rows = {r.data_source: r for r in newest.collect()}
    best = max((r.posted_at, r.posting_id, r.annual_salary_estimate or 0)
               for r in postings.where("data_source = 'adzuna'").collect())
    assert (rows["adzuna"].posted_at, rows["adzuna"].posting_id) == best[:2]


def test_modes_and_uniques(postings):
    modes = groups.mode_per_group(postings, "data_source", "company_name", "m").collect()
    assert {r.data_source: r.m for r in modes}["adzuna"] == "hot"
    # The hot occupation has one posting id only, so it does not qualify; the others do.
    roles = groups.qualified(postings, "onet_soc_code", "posting_id", 10, "n").collect()
    assert {r.onet_soc_code for r in roles} == {f"11-{i}" for i in range(7)}


@pytest.mark.parametrize("steps", [1, 12])
@pytest.mark.parametrize("ranges", [1, 7, 40])
def test_lag_of_a_hot_series(spark, ranges, steps):
    """Half of all rows are one series: cut into ranges, each row still finds the one before it."""
    series = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 3 > 0, F.concat(F.lit("s"), (F.col("id") % 400).cast("string")))
    rows = spark.range(0, 6000, 1, 8).select(series.alias("k"), (F.col("id") * 7919 % 6007).alias("t"), (F.col("id") % 97).alias("v"))
    got = windows.with_prev(rows, "k", "t", {"before": "v"}, steps, ranges).collect()
    by_key = defaultdict(list)
    for r in rows.collect():
        by_key[r.k].append((r.t, r.v))
    want = Counter()
    for k, members in by_key.items():
        members.sort()
        want.update((k, t, v, members[i - steps][1] if i >= steps else None) for i, (t, v) in enumerate(members))
    assert Counter(tuple(r) for r in got) == want
    places = windows.in_order(rows, ["k"], "t", ranges).groupBy(F.shiftright("__place", 33)).count().collect()
    assert max(r["count"] for r in places) <= 3 * 6000 / ranges


def test_lag_over_ranges_shorter_than_its_steps(spark):
    rows = spark.range(0, 30).selectExpr("'a' AS k", "id AS t", "id AS v")
    got = windows.with_prev(rows, "k", "t", {"before": "v"}, 12, 10).collect()
    assert {(r.t, r.before) for r in got} == {(i, i - 12 if i >= 12 else None) for i in range(30)}
    assert windows.with_prev(rows.limit(0), "k", "t", {"before": "v"}, 12, 10).count() == 0


def test_compare_sets_of_a_hot_key(spark):
    """A third of each side is one key: all its pairs, and the rows of one side alone, with null keys unmatched."""
    left = spark.range(0, 900).selectExpr("if(id % 3 = 0, 'hot', if(id = 1, null, concat('l', id))) AS k", "id AS a")
    right = spark.range(0, 90).selectExpr("if(id % 3 = 0, 'hot', if(id < 50, concat('l', id), null)) AS k", "id AS b")
    got = Counter(map(tuple, joins.compare_sets(left, right, "k", "in_left", "in_right").collect()))
    full = left.withColumn("in_left", F.lit(True)).join(right.withColumn("in_right", F.lit(True)), "k", "full").na.fill(
        False, ["in_left", "in_right"])
    assert got == Counter(map(tuple, full.select("k", "a", "in_left", "b", "in_right").collect()))
    plan = joins.compare_sets(left, right, "k", "in_left", "in_right")._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan


def test_bitmaps_add_up(spark):
    rows = spark.range(0, 90000).selectExpr(
        "if(id % 3 = 0, 's0', concat('s', id % 5)) AS s", "id % 12 AS m", "if(id % 17 = 0, null, id * 7919 % 70001) AS c")
    ids = groups.dense_ids(rows, "c", parts=5)
    numbers = [r.id for r in ids.collect()]
    assert sorted(numbers) == list(range(len(numbers))) and max(numbers) > 2 * 32768
    by_month = groups.distinct_bitmaps(rows, ["s", "m"], "c", ids)
    got = {(r.s, r.m): r.n for r in groups.bitmap_counts(by_month, ["s", "m"], "n").collect()}
    want = {(r.s, r.m): r.n for r in rows.groupBy("s", "m").agg(F.countDistinct("c").alias("n")).collect()}
    assert got == want
    by_source = groups.merge_bitmaps(by_month, "s")
    assert {r.s: r.n for r in groups.bitmap_counts(by_source, "s", "n").collect()} == {
        r.s: r.n for r in rows.groupBy("s").agg(F.countDistinct("c").alias("n")).collect()}


def test_rare_values_are_not_counted(spark, monkeypatch):
    """60,000 rows of which most have a name of their own: only buckets with frequent names are counted by value."""
    name = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, F.concat(F.lit("n"), (F.col("id") % 7).cast("string")))
    rows = spark.range(0, ROWS, 1, 8).select(
        F.when(F.col("id") % 4 > 0, "k").alias("key"), F.coalesce(name, F.col("id").cast("string")).alias("name"))
    kept, plain = [], groups.written

    def seen(df, what):
        table = plain(df, what)
        kept.append((what, table.count()))
        return table

    monkeypatch.setattr(groups, "written", seen)
    got = {tuple(r) for r in groups.frequent_values(rows, "key", "name", 5).collect()}
    counted = rows.groupBy("key", "name").count().collect()
    want = set()
    for key in (None, "k"):
        best = sorted(((-r["count"], r["name"]) for r in counted if r.key == key))[:5]
        want |= {(key, v, -n, i + 1) for i, (n, v) in enumerate(best)}
    assert got == want
    assert dict(kept)["counted"] < len(counted) / 100
    few = rows.where("name in ('hot', 'n1')")
    assert {tuple(r)[:2] for r in groups.frequent_values(few, "key", "name", 5).collect()} == {
        (k, v) for k, v in {(r.key, r.name) for r in few.collect()}}


def test_checks_are_counted_by_the_write(spark, tmp_path):
    df = spark.createDataFrame([(1, " x", -2.0, "a"), (None, "y", 3.0, "b"), (1, None, None, "zz")], "id int, t string, v double, s string")
    checks = quality.Checks(not_null=("id", "t"), unique=("id",), positive_value=("v",), text_trimmed=("t",), accepted_values={"s": ["a", "b"]})
    watched, metrics = quality.observed(df, checks)
    table = writers.save(watched, str(tmp_path), "gold", "t")
    got = quality.report_of_writes(spark, {"t": metrics}, {"t": table}, {"t": checks})
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, quality.quality_report({"t": df}, {"t": checks}).collect()))
    empty, none = quality.observed(df.limit(0), checks)
    saved = writers.save(empty, str(tmp_path), "gold", "e")
    assert {r.failures for r in quality.report_of_writes(spark, {"e": none}, {"e": saved}, {"e": checks}).collect()} == {0}
    assert quality.observed(df, quality.Checks(unique=("id",)))[1] is None
