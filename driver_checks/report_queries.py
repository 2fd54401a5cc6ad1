"""Reports and quality checks on the marts of the fixture shapes, with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_checks import oracle_parts as o
from driver_checks import shapes as s
from driver_checks import table_queries as t
from jobtide.fixed_values import COVERAGE_LABELS, SOURCES
from jobtide.plans import quality, reports
from jobtide.plans.quality import TABLE_CHECKS, Checks

# R18 looks at one occupation; this one exists at every scale.
OCCUPATION = "Occupation NATION_7"

# R7 needs names that look like requirements: the supplier's brand count as an age.
_SUSPECT = "CASE WHEN skill_name LIKE 'hot%' THEN skill_name || ' years' ELSE skill_name END"


MARTS = [
    "market_snapshot", "market_trends", "economic_dashboard", "role_analysis", "role_top_skills",
    "skills_demand", "metro_comparison", "occupation_skills_profile",
]


def all_marts(spark, d):
    """The marts of one run; the facts behind them are written once, not derived again for every mart and check."""
    facts = t.written_facts(spark, d)
    return {f"gold_{n}": t.QUERIES[n](spark, d, facts) for n in MARTS}


def leading_role_skills(spark, d):
    return reports.leading_role_skills(t.role_top_skills(spark, d), t.role_analysis(spark, d))


def suspected_non_skills(spark, d):
    demand = t.skills_demand(spark, d).withColumn("skill_name", F.expr(_SUSPECT))
    return reports.suspected_non_skills(demand)


def _loose_postings(spark, d):
    """Postings with blanks around titles and a signed salary, so that checks have something to find."""
    signed = F.when(F.col("state") == "ASIA", -F.col("annual_salary_estimate")).otherwise(
        F.col("annual_salary_estimate"))
    title = F.when(F.col("is_remote"), F.concat(F.lit(" "), "job_title")).otherwise(F.col("job_title"))
    return s.postings(spark, d).withColumns({"annual_salary_estimate": signed, "job_title": title})


POSTING_CHECKS = Checks(
    not_null=("posting_id", "posted_at", "is_remote", "state", "onet_soc_code"),
    unique=("posting_id", "company_name"),
    positive_value=("annual_salary_estimate",),
    text_trimmed=("job_title", "city"),
    accepted_values={"data_source": SOURCES[:2], "work_type": ["1-urgent", "2-high"]},
)


def quality_report(spark, d):
    return quality.quality_report({"postings": _loose_postings(spark, d)}, {"postings": POSTING_CHECKS})


def quality_of_marts(spark, d):
    return quality.quality_report(all_marts(spark, d))


def failing_rows(check, column, values=None):
    def query(spark, d):
        return quality.failing_rows(_loose_postings(spark, d), check, column, values).select(
            "posting_id", column if column != "posting_id" else "company_name")
    return query


QUERIES = {
    "report_snapshot": lambda k, d: reports.snapshot_by_volume(t.market_snapshot(k, d)),
    "report_trends": lambda k, d: reports.trends_by_source(t.market_trends(k, d)),
    "report_series_summary": lambda k, d: reports.series_summary(t.economic_dashboard(k, d)),
    "report_role_table": lambda k, d: reports.role_table(t.role_analysis(k, d)),
    "report_leading_role_skills": leading_role_skills,
    "report_leading_skills": lambda k, d: reports.leading_skills(t.skills_demand(k, d)),
    "report_suspected_non_skills": suspected_non_skills,
    "report_metro_table": lambda k, d: reports.metro_table(t.metro_comparison(k, d)),
    "report_gap_summary": lambda k, d: reports.gap_summary(t.occupation_skills_profile(k, d)),
    "report_emerging_skills": lambda k, d: reports.emerging_skills(t.occupation_skills_profile(k, d)),
    "report_row_counts": lambda k, d: reports.mart_row_counts(all_marts(k, d)),
    "report_key_figures": lambda k, d: reports.key_figures(t.market_snapshot(k, d)),
    "report_coverage": lambda k, d: reports.coverage_by_source(t.market_snapshot(k, d)),
    "report_occupation_group": lambda k, d: reports.occupation_group(t.role_analysis(k, d), "15"),
    "report_all_occupations": lambda k, d: reports.occupation_group(t.role_analysis(k, d)),
    "report_most_mentioned_skills": lambda k, d: reports.most_mentioned_skills(t.skills_demand(k, d)),
    "report_gap_counts": lambda k, d: reports.gap_counts(t.occupation_skills_profile(k, d)),
    "report_emerging_tools": lambda k, d: reports.emerging_tools(t.occupation_skills_profile(k, d)),
    "report_gap_detail": lambda k, d: reports.gap_detail(
        t.occupation_skills_profile(k, d), "aligned", OCCUPATION),
    "report_salary_against_income": lambda k, d: reports.salary_against_income(t.metro_comparison(k, d)),
    "report_category_series": lambda k, d: reports.category_series(
        t.economic_dashboard(k, d), "labor_demand"),
    "quality_report": quality_report,
    "quality_of_marts": quality_of_marts,
    "failing_positive_value": failing_rows("positive_value", "annual_salary_estimate"),
    "failing_text_trimmed": failing_rows("text_trimmed", "job_title"),
    "failing_not_null": failing_rows("not_null", "is_remote"),
    "failing_unique": failing_rows("unique", "company_name"),
    "failing_accepted_values": failing_rows("accepted_values", "data_source", SOURCES[:2]),
}

_M = t.ORACLE
_LOOSE = f"""
WITH {o.POSTS},
loose AS (
  SELECT *, if(state = 'ASIA', -pay, pay) AS signed,
    coalesce(if(remote, ' ', ''), '') || lower(c_mktsegment || ' ' || n_name) AS title
  FROM posts JOIN (SELECT o_orderkey::VARCHAR AS pid, c_mktsegment, n_name FROM placed) USING (pid)
)"""


def _count(check: str, column: str, condition: str) -> str:
    return (
        f"SELECT 'postings' AS \"table\", '{check}' AS \"check\", '{column}' AS \"column\", "
        f"count(*) AS failures FROM {condition}"
    )


def _mart_checks(mart: str) -> str:
    """One SELECT per declared check of a mart."""
    name, source = f"gold_{mart}", f"g_{mart}"
    checks = TABLE_CHECKS[name]
    failing = [("not_null", c, f"{c} IS NULL") for c in checks.not_null]
    failing += [("positive_value", c, f"{c} < 0") for c in checks.positive_value]
    failing += [
        ("accepted_values", c, f"{c} NOT IN ({', '.join(repr(v) for v in values)})")
        for c, values in checks.accepted_values.items()
    ]
    parts = [_count(check, c, f"{source} WHERE {condition}") for check, c, condition in failing]
    parts += [
        _count("unique", c, f"(SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
        for c in checks.unique
    ]
    return " UNION ALL ".join(parts).replace("'postings' AS", f"'{name}' AS")


_COVERAGE = " UNION ALL ".join(
    f"SELECT data_source, '{label}' AS metric, {c} AS count FROM g" for c, label in COVERAGE_LABELS)

ORACLE = {
    "report_snapshot": _M["market_snapshot"],
    "report_trends": _M["market_trends"],
    "report_series_summary": f"""
SELECT category, series_name, source_system, count(*) AS months, min(report_month) AS earliest,
  max(report_month) AS latest, round(min(value), 2) AS min_val, round(avg(value), 2) AS avg_val,
  round(max(value), 2) AS max_val
FROM ({_M['economic_dashboard']}) GROUP BY ALL""",
    "report_role_table": f"""
SELECT onet_soc_code, occupation_title, job_zone, total_postings, postings_last_30d, postings_with_salary,
  median_salary, salary_p25, salary_p75, pct_remote, most_common_experience_level, most_common_work_type,
  pct_bachelors_degree, pct_masters_degree
FROM ({_M['role_analysis']})""",
    "report_leading_role_skills": f"""
WITH best AS (FROM ({_M['role_analysis']}) ORDER BY total_postings DESC, onet_soc_code LIMIT 20)
SELECT occupation_title, skill_name, skill_rank, mention_count, pct_of_postings, onet_importance_value,
  onet_level_value
FROM ({_M['role_top_skills']})
WHERE skill_rank < 6 AND onet_soc_code IN (SELECT onet_soc_code FROM best)""",
    "report_leading_skills": f"""
SELECT skill_name, sum(mention_count)::BIGINT AS total_mentions,
  sum(distinct_postings)::BIGINT AS total_distinct_postings, count(DISTINCT report_month) AS months_active,
  round(avg(pct_of_postings), 4) AS avg_pct, count(*) FILTER (is_trending) AS months_trending
FROM ({_M['skills_demand']}) GROUP BY skill_name ORDER BY total_mentions DESC, skill_name LIMIT 30""",
    "report_suspected_non_skills": f"""
SELECT skill_name || ' years' AS skill_name, sum(mention_count)::BIGINT AS total_mentions
FROM ({_M['skills_demand']}) WHERE skill_name LIKE 'hot%' GROUP BY 1""",
    "report_metro_table": f"""
SELECT state, total_postings, median_salary, salary_to_income_ratio, pct_remote, cbsa_fips, metro_name,
  median_household_income, pct_bachelors_or_higher, pct_work_from_home, pct_information_industry
FROM ({_M['metro_comparison']})""",
    "report_gap_summary": f"""
SELECT gap_direction, count(*) AS entries, count(DISTINCT onet_soc_code) AS occupations,
  count(DISTINCT skill_name) AS unique_skills, round(avg(posting_mention_count), 1) AS avg_mentions,
  round(avg(posting_pct_of_postings), 4) AS avg_pct
FROM ({_M['occupation_skills_profile']}) GROUP BY 1""",
    "report_emerging_skills": f"""
SELECT occupation_title, skill_name, posting_mention_count, posting_pct_of_postings AS pct
FROM ({_M['occupation_skills_profile']}) WHERE NOT in_onet
ORDER BY posting_mention_count DESC, occupation_title, skill_name LIMIT 20""",
    "report_row_counts": " UNION ALL ".join(
        f"SELECT 'gold_{n}' AS model, count(*) AS rows FROM ({_M[n]})" for n in MARTS),
    "report_key_figures": f"""
SELECT sum(total_postings)::BIGINT AS total_postings, sum(unique_companies)::BIGINT AS unique_companies,
  max(median_salary) FILTER (data_source = 'adzuna') AS live_median_salary,
  max(postings_with_salary) FILTER (data_source = 'adzuna') AS live_postings_with_salary,
  max(median_salary) FILTER (data_source = 'kaggle_linkedin') AS linkedin_median_salary,
  max(postings_with_salary) FILTER (data_source = 'kaggle_linkedin') AS linkedin_postings_with_salary
FROM ({_M['market_snapshot']})""",
    "report_coverage": f"WITH g AS ({_M['market_snapshot']}) {_COVERAGE}",
    "report_occupation_group": f"""
SELECT count(*) AS occupations, sum(total_postings)::BIGINT AS total_postings,
  median(median_salary) AS median_of_medians, round(avg(pct_remote), 4) AS avg_pct_remote
FROM ({_M['role_analysis']}) WHERE onet_soc_code LIKE '15%'""",
    "report_all_occupations": f"""
SELECT count(*) AS occupations, sum(total_postings)::BIGINT AS total_postings,
  median(median_salary) AS median_of_medians, round(avg(pct_remote), 4) AS avg_pct_remote
FROM ({_M['role_analysis']})""",
    "report_most_mentioned_skills": f"""
SELECT skill_name, sum(mention_count)::BIGINT AS total_mentions, sum(distinct_postings)::BIGINT AS total_distinct,
  count(DISTINCT report_month) AS months_active
FROM ({_M['skills_demand']}) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
    "report_gap_counts": f"""
SELECT gap_direction, count(*) AS count FROM ({_M['occupation_skills_profile']}) GROUP BY 1""",
    "report_emerging_tools": f"""
SELECT skill_name, sum(posting_mention_count)::BIGINT AS posting_mention_count
FROM ({_M['occupation_skills_profile']}) WHERE NOT in_onet AND onet_soc_code[1:2] = '15'
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""",
    "report_gap_detail": f"""
SELECT skill_name, posting_mention_count, posting_pct_of_postings, onet_is_hot_technology, onet_is_in_demand
FROM ({_M['occupation_skills_profile']}) WHERE in_onet AND in_market AND occupation_title = '{OCCUPATION}'
ORDER BY posting_mention_count DESC, skill_name, onet_commodity_title, onet_is_hot_technology LIMIT 30""",
    "report_salary_against_income": f"""
SELECT state, metro_name, total_postings, median_salary, median_household_income, salary_to_income_ratio
FROM ({_M['metro_comparison']})
WHERE cbsa_fips IS NOT NULL AND median_salary IS NOT NULL AND median_household_income IS NOT NULL""",
    "report_category_series": f"""
SELECT series_name, report_month, value FROM ({_M['economic_dashboard']}) WHERE category = 'labor_demand'""",
    "quality_report": _LOOSE + " UNION ALL ".join([
        _count("not_null", "posting_id", "loose WHERE pid IS NULL"),
        _count("not_null", "posted_at", "loose WHERE posted IS NULL"),
        _count("not_null", "is_remote", "loose WHERE remote IS NULL"),
        _count("not_null", "state", "loose WHERE state IS NULL"),
        _count("not_null", "onet_soc_code", "loose WHERE occ IS NULL"),
        _count("unique", "posting_id", "(SELECT pid FROM loose GROUP BY 1 HAVING count(*) > 1)"),
        _count("unique", "company_name", "(SELECT company FROM loose GROUP BY 1 HAVING count(*) > 1)"),
        _count("positive_value", "annual_salary_estimate", "loose WHERE signed < 0"),
        _count("text_trimmed", "job_title", "loose WHERE title <> trim(title)"),
        _count("text_trimmed", "city", "loose WHERE city <> trim(city)"),
        _count("accepted_values", "data_source", "loose WHERE src = 'adzuna'"),
        _count("accepted_values", "work_type", "loose WHERE work NOT IN ('1-urgent', '2-high')"),
    ]),
    "quality_of_marts": "WITH " + ", ".join(f"g_{n} AS ({_M[n]})" for n in MARTS)
    + " UNION ALL ".join(["", *[_mart_checks(n) for n in MARTS]]).removeprefix(" UNION ALL"),
    "failing_positive_value": _LOOSE + " SELECT pid AS posting_id, signed AS annual_salary_estimate FROM loose WHERE signed < 0",
    "failing_text_trimmed": _LOOSE + " SELECT pid AS posting_id, title AS job_title FROM loose WHERE title LIKE ' %'",
    "failing_not_null": _LOOSE + " SELECT pid AS posting_id, remote AS is_remote FROM loose WHERE remote IS NULL",
    "failing_unique": _LOOSE + """ SELECT pid AS posting_id, company AS company_name FROM loose
QUALIFY count(*) OVER (PARTITION BY company) > 1""",
    "failing_accepted_values": _LOOSE + " SELECT pid AS posting_id, src AS data_source FROM loose WHERE src = 'adzuna'",
}
