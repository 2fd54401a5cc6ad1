"""The whole run on made-up feeds, with marts worked out by hand."""

from __future__ import annotations

import csv
import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from feeds import DEV, SCI, write_raw
from jobtide.fixed_values import NOISE_NAMES
from jobtide.plans import facts, postings
from jobtide.plans.pipeline import MARTS, run
from jobtide.plans.quality import TABLE_CHECKS

AS_OF = dt.date(2026, 4, 10)


@pytest.fixture(scope="module")
def run_dir(tmp_path_factory):
    return str(tmp_path_factory.mktemp("run"))


@pytest.fixture(scope="module")
def tables(spark, run_dir):
    return run(spark, write_raw(spark, f"{run_dir}/raw"), f"{run_dir}/out", AS_OF, export=True)


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_all_tables_are_built(tables):
    assert set(TABLE_CHECKS) <= set(tables)
    assert len(TABLE_CHECKS) == 26


def test_dimensions(tables):
    assert set(by(tables["dim_occupations"], "onet_soc_code")) == {DEV, SCI}
    for name, skill in (("dim_skills", "Python"), ("dim_knowledge", "Math"), ("dim_work_activities", "Analyse")):
        assert [tuple(r) for r in tables[name].collect()] == [(DEV, "2.A", skill, 4.5, 5.0)]
    tools = tables["dim_technology_skills"].collect()
    assert len(tools) == 4
    assert {(r.technology_name, r.is_hot_technology, r.is_in_demand) for r in tools} == {
        ("Python", True, False), ("Excel", False, None), ("R", True, True)}
    education = tables["dim_education_requirements"].first()
    assert (education.pct_bachelors_degree, education.pct_masters_degree,
            education.pct_post_doctoral_training) == (65.0, 20.0, 0.0)
    metros = by(tables["dim_metros"], "cbsa_fips")
    assert metros["12420"].metro_name == "Austin Metro"
    assert metros["12420"].median_household_income == 90000
    assert metros["12420"].pct_bachelors_or_higher is None
    assert metros["1"].median_household_income is None
    companies = by(tables["dim_companies"], "company_id")
    assert set(companies) == {7, 8}
    assert companies[7].industries == "ai, software"
    assert (companies[7].employee_count, companies[7].follower_count) == (12, 120)
    assert companies[8].industries is None
    spine = tables["dim_date_spine"]
    assert spine.count() == (AS_OF - dt.date(2015, 1, 1)).days + 1


def test_title_mapping(tables):
    titles = by(tables["int_title_to_soc_mapping"], "title_lower")
    assert set(titles) == {"software engineer", "software developers", "data scientists", "chief executives"}
    assert titles["software engineer"].onet_soc_code == DEV
    assert titles["data scientists"].title_source == "occupation_title"
    assert titles["data scientists"].soc_code == "15-2051"


def test_live_postings_are_placed(tables):
    live = tables["int_adzuna__postings_enriched"].collect()
    assert len(live) == 11
    kinds = {r.posting_id: r.location_match_type for r in live}
    assert {k: kinds[k] for k in ("1", "20", "21", "22", "23")} == {
        "1": "CITY_STATE", "20": "COUNTRY_ONLY", "21": "CITY_COUNTY", "22": "UNMATCHED_CITY_COUNTY",
        "23": "UNMATCHED"}
    newest = next(r for r in live if r.posting_id == "1")
    assert (newest.created, newest.salary_mid, newest.county, newest.state) == (
        dt.datetime(2026, 3, 2, 10), 120000, "travis", "texas")
    assert {r.state for r in live if r.posting_id == "21"} == {"iowa", "ohio"}
    assert next(r for r in live if r.posting_id == "20").city is None
    assert next(r for r in live if r.posting_id == "22").county == "lost county"


def test_linkedin_salaries_and_skills(tables):
    rows = tables["int_kaggle_linkedin__postings_enriched"].collect()
    assert sorted((r.posting_id, r.annual_salary_estimate or 0) for r in rows) == [
        ("1", 54000), ("1", 124800), ("2", 0), ("3", 0)]
    first = next(r for r in rows if r.posting_id == "1")
    assert first.skills_array == ["information technology", "sales"]
    assert first.posted_at == dt.datetime(2024, 3, 24, 21, 50, 14)
    assert next(r for r in rows if r.posting_id == "3").posted_at is None


def test_job_postings(tables):
    jobs = tables["fct_job_postings"].collect()
    assert len(jobs) == 4 + 19 + 9 + 11  # four large listings have two skill rows and count twice
    remote = {(r.data_source, r.posting_id): r.is_remote for r in jobs}
    assert remote["kaggle_linkedin", "1"] is True
    assert remote["kaggle_linkedin", "2"] is False
    assert remote["kaggle_linkedin", "3"] is None
    assert remote["kaggle_linkedin_large", "link/50"] is False
    assert remote["kaggle_linkedin_large", "link/51"] is True
    assert remote["adzuna", "20"] is False
    assert sum(r.onet_soc_code == DEV for r in jobs) == 29
    assert sum(r.onet_soc_code == SCI for r in jobs) == 10


def test_posting_skills(tables):
    rows = [tuple(r) for r in tables["fct_posting_skills"].collect()]
    assert len(rows) == len(set(rows)) == 45
    names = {r[1] for r in rows}
    assert names == {"python", "sql", "problem solving", "rust", "go", "information technology", "sales",
                     "orphan skill"}


def test_series(tables):
    labor = tables["fct_bls_observations"].collect()
    assert len(labor) == 5
    annual = next(r for r in labor if r.period_code == "M13")
    assert annual.is_annual_average and annual.observation_date is None
    known = next(r for r in labor if r.value == 4.0)
    assert (known.series_name, known.net_change_1m, known.net_change_12m, known.pct_change_1m,
            known.pct_change_12m) == ("unemployment rate", 0.1, None, 2.5, None)
    assert next(r for r in labor if r.series_id == "OTHER").series_name == "OTHER"
    assert tables["fct_fred_indicators"].count() == 5


def test_snapshot_and_trends(tables):
    snapshot = by(tables["gold_market_snapshot"], "data_source")
    assert {k: r.total_postings for k, r in snapshot.items()} == {
        "kaggle_linkedin": 4, "kaggle_linkedin_large": 19, "kaggle_ds": 9, "adzuna": 11}
    assert snapshot["kaggle_linkedin"].postings_with_salary == 2
    assert snapshot["kaggle_linkedin"].median_salary is None
    assert snapshot["adzuna"].postings_with_salary == 8
    assert snapshot["adzuna"].distinct_months == 2
    trends = by(tables["gold_market_trends"], "report_month")
    assert set(trends) == {dt.datetime(2026, 3, 1), dt.datetime(2026, 4, 1)}
    april = trends[dt.datetime(2026, 4, 1)]
    assert (april.total_postings, april.postings_mom_change, april.postings_mom_change_pct) == (5, -1, -0.1667)


def test_economic(tables):
    rows = by(tables["gold_economic_dashboard"], "series_id", "report_month")
    assert len(rows) == 5
    february, march = dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)
    assert rows["LNS12300060", february].source_system == "bls"
    assert rows["LNS12300060", march].source_system == "fred"
    assert rows["DFF", february].value == 5.5
    assert rows["DFF", february].category == "inflation"
    assert rows["LNS14000000", dt.datetime(2024, 1, 1)].value_12m_ago is None


def test_role_analysis(tables):
    roles = by(tables["gold_role_analysis"], "onet_soc_code")
    dev = roles[DEV]
    assert (dev.total_postings, dev.postings_last_30d, dev.postings_last_90d) == (29, 4, 10)
    assert (dev.unique_companies, dev.postings_with_salary) == (4, 10)
    assert dev.top_hiring_companies == "acme, co 0, co 1"
    assert dev.most_common_experience_level == "mid senior"
    assert dev.most_common_work_type == "onsite"
    assert (dev.pct_bachelors_degree, dev.pct_doctoral_degree) == (65.0, 0.0)
    assert roles[SCI].pct_bachelors_degree is None


def test_role_top_skills(tables):
    rows = sorted((r.skill_rank, r.skill_name, r.mention_count, r.onet_importance_value)
                  for r in tables["gold_role_top_skills"].collect())
    assert rows == [(1, "problem solving", 12, None), (2, "python", 12, 4.5), (3, "sql", 12, None),
                    (4, "go", 3, None)]
    assert tables["gold_role_top_skills"].first().total_postings_for_soc == 21


def test_gap(tables):
    rows = sorted((r.onet_soc_code, r.skill_name, r.gap_direction, r.posting_mention_count)
                  for r in tables["gold_occupation_skills_profile"].collect())
    assert rows == [
        (DEV, "excel", "onet_only", 0), (DEV, "excel", "onet_only", 0), (DEV, "go", "market_only", 3),
        (DEV, "problem solving", "market_only", 12), (DEV, "python", "aligned", 12),
        (DEV, "sql", "market_only", 12), (SCI, "r", "onet_only", 0)]


def test_metros(tables):
    rows = tables["gold_metro_comparison"].collect()
    assert len(rows) == 1
    texas = rows[0]
    assert (texas.state, texas.cbsa_fips, texas.total_postings, texas.median_salary,
            texas.salary_to_income_ratio) == ("texas", "12420", 6, 100005, 1.11)


def test_quality_report(tables):
    failures = {(r.table, r.check, r.column): r.failures for r in tables["quality_report"].collect()}
    assert failures["fct_job_postings", "not_null", "is_remote"] == 1
    assert failures["dim_occupations", "unique", "onet_soc_code"] == 0
    assert failures["dim_metros", "not_null", "pct_bachelors_or_higher"] == 2
    assert failures["gold_market_snapshot", "unique", "data_source"] == 0
    assert len(failures) == sum(
        len(c.not_null) + len(c.unique) + len(c.positive_value) + len(c.text_trimmed) + len(c.accepted_values)
        for c in TABLE_CHECKS.values())


def test_exports_are_sorted_csv(tables, run_dir):
    for mart in MARTS:
        assert glob.glob(f"{run_dir}/out/export/{mart}/*.csv"), mart
    totals = []
    for path in sorted(glob.glob(f"{run_dir}/out/export/gold_market_snapshot/*.csv")):
        with open(path) as lines:
            totals += [int(r["total_postings"]) for r in csv.DictReader(lines)]
    assert totals == [19, 11, 9, 4]


def test_diagnostics(tables, run_dir):
    def lines(name):
        found = []
        for path in sorted(glob.glob(f"{run_dir}/out/diagnostics/{name}/*.csv")):
            with open(path) as part:
                found += list(csv.DictReader(part))
        return found

    counts = {r["model"]: int(r["rows"]) for r in lines("00_row_counts")}
    assert counts["gold_market_snapshot"] == 4 and len(counts) == 8
    assert [r["skill_name"] for r in lines("05_role_top_skills")] == ["problem solving", "python", "sql", "go"]
    assert [r["entries"] for r in lines("09_skills_gap_summary")] == ["3", "3", "1"]
    assert lines("10_emerging_market_only_skills")[0]["skill_name"] == "problem solving"
    assert len(glob.glob(f"{run_dir}/out/diagnostics/*")) == 11


def test_marts_push_filters_and_prune_columns(spark, tables):
    from jobtide.plans import marts
    roles = marts.qualified_roles(tables["fct_job_postings"])
    plan = roles._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "EqualTo(soc_match_type,exact_match)" in scan
    assert "description" not in scan.split("ReadSchema")[1]


def test_coded_names_are_cleaned_in_the_mapping(spark, monkeypatch):
    """The dictionary and the noise filter meet a code's name once, before the rows that have the code."""
    links = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (2, "c"), (3, "d"), (3, "e"), (4, None), (None, "a")], "job_id long, skill_abr string")
    mapping = spark.createDataFrame(
        [("a", " JS "), ("b", "JavaScript"), ("b", "Go"), ("c", NOISE_NAMES[0]), ("d", " "), ("e", None), (None, "SQL")],
        "skill_abr string, skill_name string")
    listed = spark.createDataFrame([("9", "js, SQL")], "job_link string, job_skills string")
    dictionary = spark.createDataFrame([("js", "javascript")], "raw_skill string, canonical_skill string")
    plain, cleaned = facts.drop_non_skills, []
    monkeypatch.setattr(facts, "drop_non_skills", lambda df: cleaned.append(df.columns) or plain(df))
    found = facts.posting_skills(links, mapping, listed, listed.limit(0), dictionary)
    assert {(r["posting_id"], r["skill_name"]) for r in found.collect()} == {
        ("1", "javascript"), ("1", "go"), ("2", "javascript"), ("2", "go"), ("9", "javascript"), ("9", "sql"), (None, "javascript")}
    assert found.count() == 7
    assert ["skill_abr", "skill_name"] in cleaned


def test_jobs_are_cleaned_before_salary_rows_multiply_them(spark, monkeypatch):
    """Texts are normalised once per job, not once per job and salary row; rows and columns stay."""
    columns = ("job_id long, title string, description string, location string, company_name string, company_id double, "
               "formatted_work_type string, formatted_experience_level string, listed_time double, remote_allowed double, views double, applies double")
    jobs = spark.createDataFrame([
        (1, " Dev ", " d ", " X", "Co ", 7.0, "Full", "Mid", 86400000.0, 1.0, 3.0, None),
        (None, "Ops", None, None, None, None, None, None, None, None, None, None)], columns)
    pay = spark.createDataFrame([(1, None, 90000.0, None, "YEARLY", "USD"), (1, None, 80000.0, None, "YEARLY", "USD")],
                                "job_id long, max_salary double, med_salary double, min_salary double, pay_period string, currency string")
    links = spark.createDataFrame([(1, "a"), (1, "b")], "job_id long, skill_abr string")
    mapping = spark.createDataFrame([("a", "SQL"), ("b", "Go")], "skill_abr string, skill_name string")
    met, plain = [], postings.left_chain
    monkeypatch.setattr(postings, "left_chain", lambda first, *others, on: met.append(first.columns) or plain(first, *others, on=on))
    found = postings.linkedin_enriched(jobs, pay, links, mapping)
    assert "job_title" in met[0] and "title" not in met[0]
    assert found.columns == [
        "posting_id", "job_title", "description", "location", "company_name", "company_id", "work_type", "experience_level",
        "posted_at", "is_remote", "view_count", "apply_count", "annual_salary_estimate", "skills_array", "data_source"]
    got = sorted(map(tuple, found.collect()), key=str)
    assert [(r[0], r[1], r[2], r[3], r[4], r[5], r[9], r[10], r[12], r[13]) for r in got if r[0]] == [
        ("1", "dev", "d", "x", "co", 7, True, 3, pay, ["go", "sql"]) for pay in (80000, 90000)]
    assert [(r[1], r[12]) for r in got if r[0] is None] == [("ops", None)]


def test_marts_of_one_run_read_written_facts(spark, tmp_path, monkeypatch):
    from driver_checks import report_queries, table_queries

    made = []
    monkeypatch.setattr(table_queries.s, "postings", lambda k, d: made.append("postings") or spark.createDataFrame(
        [("1", "a", "x", dt.datetime(2024, 1, 1), "LINKEDIN", "15-1.00")],
        "posting_id string, job_title string, company_name string, posted_at timestamp_ntz, data_source string, onet_soc_code string")
        .withColumn("soc_match_type", F.lit("exact_match")))
    monkeypatch.setattr(table_queries.s, "skills", lambda k, d: made.append("skills") or spark.createDataFrame(
        [("1", "sql", "LINKEDIN"), (None, "sql", "LINKEDIN")], "posting_id string, skill_name string, data_source string"))
    seen = []
    for name in report_queries.MARTS:
        monkeypatch.setitem(table_queries.QUERIES, name, lambda k, d, facts, name=name: seen.append(facts) or facts.postings)
    report_queries.all_marts(spark, "nowhere")
    assert made.count("postings") == 1 and made.count("skills") == 1
    assert all(facts is seen[0] for facts in seen) and len(seen) == len(report_queries.MARTS)
    assert seen[0].mentions.collect()[0].asDict() == {"onet_soc_code": "15-1.00", "skill_name": "sql", "mention_count": 1}
    assert all("part-" in f for table in seen[0] for f in table.inputFiles())
