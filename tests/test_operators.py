"""DataFrame operators on small tables, also with keys that are NULL or hot."""

from __future__ import annotations

import datetime as dt
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobtide.operators import groups, joins, reshape, windows
from jobtide.plans.reports import leading_role_skills


def test_exact_percentiles_against_numpy(spark):
    """Hot group, tiny groups, negative numbers, ties, the ends of INT, NULL keys and values."""
    rng = random.Random(7)
    data = [("hot", rng.randint(-200000, 900000)) for _ in range(4000)]
    data += [("ties", 70000)] * 300 + [("ties", 70001)] * 301
    data += [("one", 5), ("two", 1), ("two", 4), ("empty", None), (None, 3), (None, 8), (None, None)]
    data += [("ends", -2**31), ("ends", 2**31 - 1), ("ends", 0)]
    data += [("edge", v) for v in (65535, 65536, 65537, -1, -65536, -65537)]
    df = spark.createDataFrame(data, "k string, v int")
    probabilities = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99, "p100": 1.0}
    got = {r["k"]: r for r in groups.exact_percentiles(df, "k", "v", probabilities).collect()}
    by_key: dict = {}
    for k, v in data:
        if v is not None:
            by_key.setdefault(k, []).append(v)
    assert set(got) == set(by_key)
    for k, vs in by_key.items():
        for name, p in probabilities.items():
            assert got[k][name] == pytest.approx(np.percentile(vs, 100 * p)), (k, name)


def test_exact_percentiles_bounds_every_window(spark):
    df = spark.range(100).selectExpr("id % 2 AS k", "cast(id AS int) AS v")
    plan = groups.exact_percentiles(df, "k", "v", {"m": 0.5})._jdf.queryExecution().executedPlan().toString()
    windows_by_key = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows_by_key) == 3  # two over the histogram, one over a bucket


def test_null_keys_match_each_other(rows, result):
    a = rows([("x", None, 1), (None, 2, 2)], "k string, j int, v int")
    b = rows([("x", None, 10), (None, 2, 20), ("x", 3, 30)], "k string, j int, w int")
    assert result(joins.join_null_safe(a, b, ["k", "j"]), "v", "w") == [(1, 10), (2, 20)]


def test_compare_sets_flags(rows, result):
    a = rows([("k", "a", 1), ("k", "b", 2), ("k", "b", 3)], "k string, s string, x int")
    b = rows([("k", "b", 7), ("k", "c", 8)], "k string, s string, y int")
    got = joins.compare_sets(a, b, ["k", "s"], "in_a", "in_b")
    assert result(got, "s", "x", "y", "in_a", "in_b") == [
        ("a", 1, None, True, False), ("b", 2, 7, True, True), ("b", 3, 7, True, True),
        ("c", None, 8, False, True)]


def test_prefer_source_keeps_repeats_of_both(rows, result):
    a = rows([(1, "a"), (1, "a")], "k int, s string")
    b = rows([(1, "b"), (2, "b"), (2, "b")], "k int, s string")
    assert result(joins.prefer_source(a, b, "k")) == [(1, "a"), (1, "a"), (2, "b"), (2, "b")]


PLACES = [("Austin", "Travis County", "Texas"), ("Union", "Union County", "Iowa"),
          ("Union", "Union County", "Ohio"), ("Austin", "Travis County", "Texas")]


def test_geo_match_fans_out_over_states(rows, result):
    places = rows(PLACES, "city string, county string, state_full string")
    df = rows([(1, "austin", "TEXAS"), (2, "union", "union county"), (3, "nowhere", "x"), (4, "us", None)],
              "id int, a string, b string")
    got = joins.geo_match(df, places, "a", "b")
    assert result(got, "id", "state_by_state", "state_by_county") == [
        (1, "Texas", None), (2, None, "Iowa"), (2, None, "Ohio"), (3, None, None), (4, None, None)]
    once = joins.geo_match(df, places, "a", "b", one_match=True)
    assert result(once, "id", "state_by_county") == [(1, None), (2, "Iowa"), (3, None), (4, None)]


def test_dedup_keeps_every_row_without_key(rows, result):
    df = rows([("a", 2), ("a", 1), (None, 3), (None, 3)], "id string, t int")
    got = reshape.dedup_keep_null(df, "id", windows.earliest_first("t"))
    assert result(got) == [(None, 3), (None, 3), ("a", 1)]


def test_latest_puts_null_last(rows, result):
    df = rows([("a", None, 1), ("a", 5, 2), ("b", None, 3)], "k string, t int, v int")
    assert result(windows.latest_per_key(df, "k", windows.latest_first("t", "v")), "k", "v") == [
        ("a", 2), ("b", 3)]


def test_first_rows_are_limited_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS t")
    plan = windows.latest_per_key(df, "k", windows.latest_first("t"))._jdf.queryExecution().toString()
    assert "WindowGroupLimit [k" in plan and "Partial" in plan


def test_prev_is_by_row_and_calendar_is_by_month(rows, result):
    months = [("s", dt.datetime(2023, m, 1), float(m)) for m in (1, 4, 7, 10)]
    months += [("s", dt.datetime(2024, m, 1), 10.0 + m) for m in (1, 4)]
    df = rows(months, "k string, m timestamp_ntz, v double")
    by_row = {r["m"]: r["v_4m_ago"] for r in windows.yoy(df, "k", "m", "v", 4).collect()}
    assert by_row[dt.datetime(2024, 1, 1)] == 1.0
    calendar = {r["m"]: r["v_12m_ago"] for r in windows.yoy_calendar(df, "k", "m", "v").collect()}
    assert calendar[dt.datetime(2024, 4, 1)] == 4.0 and calendar[dt.datetime(2023, 4, 1)] is None


def test_value_ranks_break_ties_by_name(rows, result):
    df = rows([("k", "b"), ("k", "a"), ("k", "c"), ("k", "c"), ("k", " "), ("k", None)], "k string, v string")
    assert result(groups.mode_per_group(df, "k", "v", "m")) == [("k", "c")]
    assert result(groups.agg_top_names(df, "k", "v", 2, "best")) == [("k", "c, a")]


def test_pivots(rows, result):
    ratings = rows([("a", "IM", 1.0), ("a", "IM", 3.0), ("a", "LV", 2.0), ("b", "IM", 1.0), ("c", "XX", 1.0)],
                   "k string, s string, v double")
    assert result(groups.rating_pivot(ratings, "k", "s", "v", {"IM": "i", "LV": "l"})) == [("a", 3.0, 2.0)]
    shares = rows([("a", 1, 5.0), ("a", 1, 6.0), ("b", 99, 1.0)], "k string, c int, v double")
    assert result(groups.category_pivot(shares, "k", "c", "v", {1: "one", 2: "two"})) == [
        ("a", 11.0, 0.0), ("b", 0.0, 0.0)]


def test_distinct_aggregates(rows, result):
    df = rows([("a", "z"), ("a", "x"), ("a", "z"), ("a", None), ("b", None)], "k string, v string")
    assert result(groups.agg_sorted_distinct(df, "k", F.col("v"), "s")) == [("a", "x, z")]
    assert groups.agg_distinct_list(df, "k", F.col("v"), "s").first()["s"] == ["x", "z"]


def test_explode_csv_keeps_empty_items(rows, result):
    df = rows([(1, "a,,b"), (2, ""), (3, None)], "id int, t string")
    assert result(reshape.explode_csv(df, "t", "x")) == [(1, ""), (1, "a"), (1, "b"), (2, "")]


def test_to_long_is_one_scan(spark):
    df = spark.range(3).selectExpr("id", "id AS a", "id AS b")
    long = reshape.to_long(df, ["id"], ["a", "b"], "s", "v")
    assert long.count() == 6
    assert long._jdf.queryExecution().executedPlan().toString().count("Range") == 1


def test_calendar_includes_both_ends(spark):
    bounds = spark.createDataFrame([(dt.date(2023, 12, 31), dt.date(2024, 1, 2))], "a date, b date")
    got = reshape.calendar(bounds, "a", "b").orderBy("full_date").collect()
    assert [r["date_key"] for r in got] == [20231231, 20240101, 20240102]
    assert [r["is_weekend"] for r in got] == [True, False, False]
    assert [r["quarter"] for r in got] == [4, 1, 1]


def test_monthly_and_series_functions(rows, result):
    df = rows([(dt.date(2024, 1, 5), "s", 1.0), (dt.date(2024, 1, 9), "s", 3.0), (None, "s", 9.0)],
              "d date, s string, v double")
    assert result(groups.monthly(df, "d", "s", "v", F.avg)) == [(dt.datetime(2024, 1, 1), "s", 2.0)]


def test_top_groups_report(rows, result):
    roles = rows([("a", 5), ("b", 9), ("c", 9)], "onet_soc_code string, total_postings long")
    skills = rows([(k, k.upper(), "s", r, 4, 0.5, None, None) for k in "abc" for r in (1, 6)],
                  "onet_soc_code string, occupation_title string, skill_name string, skill_rank int, "
                  "mention_count long, pct_of_postings double, onet_importance_value double, "
                  "onet_level_value double")
    assert result(leading_role_skills(skills, roles, largest=2), "occupation_title", "skill_rank") == [
        ("B", 1), ("C", 1)]


def test_dictionary_and_lookup(rows, result):
    words = rows([("k8s", "kubernetes")], "raw string, word string")
    df = rows([("k8s",), ("sql",), (None,)], "s string")
    assert result(joins.apply_dictionary(df, words, "s", "raw", "word")) == [
        (None,), ("kubernetes",), ("sql",)]
    names = rows([("a", "Alpha")], "id string, name string")
    ids = rows([("a",), ("b",)], "id string")
    assert result(joins.lookup_or_self(ids, names, "id", "name")) == [("a", "Alpha"), ("b", "b")]


def test_median_of_ties_is_exact(spark):
    values = [1, 1, 2, 2, 2, 9]
    df = spark.createDataFrame([("k", v) for v in values], "k string, v int")
    assert groups.exact_percentiles(df, "k", "v", {"m": 0.5}).first()["m"] == statistics.median(values)


@pytest.mark.parametrize("kind,values", [
    ("double", [1.5, 2.7, 9.9, -3.25, 0.0, 1e300, -1e300, 2.7]),
    ("bigint", [2**40, -2**40, 3, 2**62, 2**33 + 1, 2**33]),
    ("float", [0.5, 0.25, -8.0]),
    ("decimal(20,3)", [1, 2, 10]),
])
def test_percentiles_keep_the_type(spark, kind, values):
    df = spark.createDataFrame([(i,) for i in range(len(values))], "i int").selectExpr(
        f"cast(element_at(array({', '.join(f'cast({v!r} AS {kind})' for v in values)}), i + 1) AS {kind}) AS v", "'k' AS k")
    got = groups.exact_percentiles(df, "k", "v", {"p25": 0.25, "p50": 0.5, "p90": 0.9}).first()
    for name, p in (("p25", 25), ("p50", 50), ("p90", 90)):
        assert got[name] == pytest.approx(np.percentile(np.array(values, float), p))


def test_percentiles_rank_nan_last_and_take_numbers_only(spark):
    df = spark.createDataFrame([("k", 1.0), ("k", float("nan")), ("k", 2.0)], "k string, v double")
    got = groups.exact_percentiles(df, "k", "v", {"low": 0.0, "mid": 0.5, "top": 1.0}).first()
    assert (got["low"], got["mid"]) == (1.0, 2.0) and np.isnan(got["top"])
    with pytest.raises(TypeError):
        groups.exact_percentiles(df, "v", "k", {"m": 0.5})


def test_snapshot_copies_no_row_for_its_distinct_counts(spark):
    from jobtide.plans import marts
    df = spark.createDataFrame([], "data_source string, is_snapshot boolean, company_name string, annual_salary_estimate int,"
                                   " is_remote boolean, posted_at timestamp_ntz, soc_match_type string")
    plan = marts.market_snapshot(df)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_start_settings_leave_the_session_alone():
    from jobtide.plans.pipeline import start_settings
    assert start_settings(None) == {}
    assert list(start_settings("40000").values()) == ["40000"]


def test_percentiles_of_wide_numbers_search_no_splitters(spark):
    """Buckets are ranges of the sorted values: no list of bounds per group is joined to each row and searched."""
    df = spark.range(0, 6000, 1, 4).selectExpr("id % 3 AS k", "pow(10D, id % 300) * if(id % 2 = 0, 1, -1) AS d", "id * 3000000000 AS b")
    for value in ("d", "b"):
        found = groups.exact_percentiles(df, "k", value, {"p25": 0.25, "p50": 0.5, "p99": 0.99})
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "percentile_approx" not in plan and "lambda" not in plan
        got = {r["k"]: r for r in found.collect()}
        for k in range(3):
            values = [r[0] for r in df.where(F.col("k") == k).select(value).collect()]
            for name, p in (("p25", 25), ("p50", 50), ("p99", 99)):
                assert got[k][name] == pytest.approx(np.percentile(values, p)), (k, value, name)


def test_percentiles_of_wide_numbers_with_null_keys_and_odd_values(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [(None, 1.5), (None, 2.5), ("a", 0.0), ("a", -0.0), ("a", None), ("b", nan), ("b", 1.0), ("b", float("-inf")), ("c", None)],
        "k string, v double")
    got = {r["k"]: r["m"] for r in groups.exact_percentiles(df, ["k"], "v", {"m": 0.5}).collect()}
    assert got == {None: 2.0, "a": 0.0, "b": 1.0}
    assert groups.exact_percentiles(df.where("k = 'a'"), [], "v", {"m": 1.0}).first()["m"] == 0.0
