"""Dimensions, enriched postings, facts and marts on the fixture shapes, with their oracles."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driver_checks import oracle_parts as o
from driver_checks import shapes as s
from jobtide.fixed_values import LABOR_SERIES, MACRO_SERIES, NOISE_NAMES, NOISE_PATTERNS, SKILL_VARIANTS
from jobtide.functions.numbers import round_to
from jobtide.operators.reshape import date_spine
from jobtide.plans import dimensions, facts, marts, postings
from jobtide.session import written
from jobtide.sources.readers import built_in_seeds

AS_OF = dt.date(2001, 6, 15)


# --- marts --------------------------------------------------------------------------------


def joined(spark, d):
    return marts.posting_skill_joined(s.skills(spark, d), s.postings(spark, d))


class Facts(NamedTuple):
    """What several marts read."""

    postings: DataFrame
    joined: DataFrame
    mentions: DataFrame
    roles: DataFrame


def facts_of(spark, d) -> Facts:
    postings, mentioned = s.postings(spark, d), joined(spark, d)
    return Facts(postings, mentioned, marts.role_mentions(mentioned), marts.qualified_roles(postings))


def written_facts(spark, d) -> Facts:
    """The facts as a run of all marts has them: each written once, then read by all that need it."""
    postings = written(s.postings(spark, d), "postings")
    mentioned = written(marts.posting_skill_joined(s.skills(spark, d), postings), "joined")
    return Facts(postings, mentioned, written(marts.role_mentions(mentioned), "mentions"),
                 written(marts.qualified_roles(postings), "roles"))


def market_snapshot(spark, d, facts=None):
    return marts.market_snapshot((facts or facts_of(spark, d)).postings)


def market_trends(spark, d, facts=None):
    return marts.market_trends((facts or facts_of(spark, d)).postings)


def economic_dashboard(spark, d, facts=None):
    return marts.economic_dashboard(s.labor_fact(spark, d), s.macro_fact(spark, d))


def role_analysis(spark, d, facts=None):
    roles = marts.role_analysis(
        (facts or facts_of(spark, d)).postings, s.dim_occupations(spark, d), s.dim_education(spark, d), AS_OF)
    # Sums of doubles differ in the last bits with the order of addition.
    shares = ["pct_bachelors_degree", "pct_masters_degree", "pct_doctoral_degree"]
    return roles.withColumns({c: round_to(F.col(c), 2) for c in shares})


def role_top_skills(spark, d, facts=None):
    facts = facts or facts_of(spark, d)
    return marts.role_top_skills(facts.mentions, facts.roles, s.dim_occupations(spark, d), s.dim_skills(spark, d))


def skills_demand(spark, d, facts=None):
    facts = facts or facts_of(spark, d)
    return marts.skills_demand(facts.joined, facts.postings)


def metro_comparison(spark, d, facts=None):
    return marts.metro_comparison((facts or facts_of(spark, d)).postings, s.metro_bridge(spark, d), s.dim_metros(spark, d))


def occupation_skills_profile(spark, d, facts=None):
    facts = facts or facts_of(spark, d)
    return marts.occupation_skills_profile(
        facts.mentions, facts.roles, s.dim_technology(spark, d), s.dim_occupations(spark, d))


# --- dimensions ---------------------------------------------------------------------------


def dim_education_requirements(spark, d):
    wide = s.dim_education(spark, d)
    return wide.withColumns({c: round_to(F.col(c), 2) for c in wide.columns if c != "onet_soc_code"})


def dim_companies(spark, d):
    return dimensions.dim_companies(
        s.companies(spark, d), s.company_industries(spark, d), s.company_specialties(spark, d),
        s.employee_counts(spark, d))


def dim_date_spine(spark, d):
    return date_spine(s.table(spark, d, "orders"), "o_orderdate")


# --- enriched postings --------------------------------------------------------------------


def linkedin_enriched(spark, d):
    return postings.linkedin_enriched(
        s.linkedin_postings(spark, d), s.linkedin_salaries(spark, d), s.linkedin_job_skills(spark, d),
        s.mapping_skills(spark, d))


def large_enriched(spark, d):
    return postings.large_enriched(s.listings(spark, d), s.listing_skills(spark, d))


def ds_enriched(spark, d):
    return postings.ds_enriched(
        s.listings(spark, d), s.turn_skills(spark, d), s.listing_summaries(spark, d))


def live_enriched(spark, d):
    return postings.live_enriched(s.live_postings(spark, d), s.places(spark, d))


def live_enriched_one_match(spark, d):
    return postings.live_enriched(s.live_postings(spark, d), s.places(spark, d), one_match=True)


# --- facts --------------------------------------------------------------------------------


def job_postings(spark, d):
    return facts.job_postings(
        linkedin_enriched(spark, d), large_enriched(spark, d), ds_enriched(spark, d),
        live_enriched(spark, d), s.titles(spark, d))


def posting_skills(spark, d):
    return facts.posting_skills(
        s.linkedin_job_skills(spark, d), s.mapping_skills(spark, d), s.listing_skills(spark, d),
        s.turn_skills(spark, d), built_in_seeds(spark)["skill_name_normalization"])


# --- marts on the facts that the raw feeds give ----------------------------------------------


def _fact(spark, d):
    """The postings fact as a run has it: written once, then read by all that needs it."""
    return written(job_postings(spark, d), "fct_job_postings")


def chain_market_snapshot(spark, d):
    return marts.market_snapshot(_fact(spark, d))


def _chain_mentions(spark, d, postings):
    return marts.role_mentions(marts.posting_skill_joined(posting_skills(spark, d), postings))


def chain_role_top_skills(spark, d):
    postings = _fact(spark, d)
    return marts.role_top_skills(
        _chain_mentions(spark, d, postings), marts.qualified_roles(postings), s.dim_occupations(spark, d),
        s.dim_skills(spark, d))


def chain_skills_profile(spark, d):
    postings = _fact(spark, d)
    return marts.occupation_skills_profile(
        _chain_mentions(spark, d, postings), marts.qualified_roles(postings), s.dim_technology(spark, d),
        s.dim_occupations(spark, d))


QUERIES = {
    "chain_market_snapshot": chain_market_snapshot,
    "chain_role_top_skills": chain_role_top_skills,
    "chain_skills_profile": chain_skills_profile,
    "market_snapshot": market_snapshot,
    "market_trends": market_trends,
    "economic_dashboard": economic_dashboard,
    "role_analysis": role_analysis,
    "role_top_skills": role_top_skills,
    "skills_demand": skills_demand,
    "metro_comparison": metro_comparison,
    "occupation_skills_profile": occupation_skills_profile,
    "dim_occupations": s.dim_occupations,
    "dim_skills": s.dim_skills,
    "dim_knowledge": lambda spark, d: dimensions.dim_ratings(s.ratings(spark, d, "p_brand")),
    "dim_work_activities": lambda spark, d: dimensions.dim_ratings(s.ratings(spark, d, "p_type")),
    "dim_technology_skills": s.dim_technology,
    "dim_education_requirements": dim_education_requirements,
    "dim_metros": s.dim_metros,
    "dim_companies": dim_companies,
    "dim_date_spine": dim_date_spine,
    "title_mapping": s.titles,
    "linkedin_enriched": linkedin_enriched,
    "large_enriched": large_enriched,
    "ds_enriched": ds_enriched,
    "live_enriched": live_enriched,
    "live_enriched_one_match": live_enriched_one_match,
    "job_postings": job_postings,
    "posting_skills": posting_skills,
    "labor_observations": lambda spark, d: facts.labor_observations(s.labor_series(spark, d)),
    "macro_indicators": lambda spark, d: facts.macro_indicators(s.macro_series(spark, d)),
    "posting_skill_joined": joined,
}

# --- oracles ------------------------------------------------------------------------------

_MATCHED = "occ IS NOT NULL"

_MENTIONS = o.POSTS + "," + o.SKILLS + f""",
roles AS (
  SELECT occ, count(DISTINCT pid) AS total FROM posts WHERE {_MATCHED} GROUP BY occ HAVING total >= 10
),
hits AS (
  SELECT occ, skill, count(DISTINCT pid) AS n FROM posts JOIN skilled USING (pid, src)
  WHERE {_MATCHED} GROUP BY ALL
)"""


def _values(rows, names):
    body = ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in rows)
    return f"(VALUES {body}) AS v({', '.join(names)})"


def _change(now: str, before: str) -> str:
    return f"round(({now} - {before}) / nullif(abs({before}), 0), 4) + 0.0"


_SALARY_ROWS = """
stated AS (
  SELECT l_orderkey AS job_id, CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS hi,
    CASE WHEN l_linenumber = 5 THEN l_quantity * 50 END AS mid,
    CASE WHEN l_returnflag <> 'A' THEN l_extendedprice * (1 - l_discount) END AS lo,
    MAP {'A': 'MONTHLY', 'N': 'WEEKLY', 'R': 'HOURLY'}[l_returnflag] AS said,
    l_linestatus = 'O' OR l_tax <= 0.04 AS dollars, coalesce(mid, hi, lo) AS seen
  FROM lineitem
),
factored AS (
  SELECT *, CASE WHEN seen >= 250000 THEN 1
      WHEN seen >= 15000 THEN if(said = 'MONTHLY' AND seen <= 50000, 12, 1)
      WHEN seen >= 4000 THEN if(said = 'WEEKLY', 52, 12)
      WHEN seen >= 1000 THEN if(said = 'MONTHLY' AND seen >= 2500, 12, 52)
      ELSE if(said = 'WEEKLY' AND seen >= 200, 52, 2080) END AS factor,
    coalesce(mid * factor, (lo * factor + hi * factor) / 2, lo * factor, hi * factor) AS yearly
  FROM stated
)"""

_LINKEDIN = o.PLACED_ORDERS + "," + _SALARY_ROWS + """,
named AS (
  SELECT l_orderkey AS job_id, list_sort(list(DISTINCT lower(p_name))) AS skills_array
  FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size > 3 GROUP BY 1
),
linkedin AS (
  SELECT o_orderkey::VARCHAR AS posting_id, lower(c_mktsegment || ' ' || n_name) AS job_title,
    'Order of ' || c_name AS description, lower(n_name || ', ' || r_name) AS location,
    lower(c_name) AS company_name, o_custkey AS company_id, lower(o_orderpriority) AS work_type,
    lower(c_mktsegment) AS experience_level,
    CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate::DATE::TIMESTAMP END AS posted_at,
    CASE o_orderpriority WHEN '1-URGENT' THEN true WHEN '2-HIGH' THEN false END AS is_remote,
    floor(o_totalprice)::INTEGER AS view_count,
    CASE WHEN o_orderstatus = 'F' THEN n_nationkey END AS apply_count,
    round(yearly)::INTEGER AS annual_salary_estimate, skills_array, 'kaggle_linkedin' AS data_source
  FROM placed
  LEFT JOIN (SELECT * FROM factored WHERE yearly BETWEEN 15000 AND 1000000 AND dollars) f
    ON o_orderkey = f.job_id
  LEFT JOIN named ON o_orderkey = named.job_id
)"""

_LISTED = """
listed AS (
  SELECT doc_id::VARCHAR AS posting_id, lower(source || ' ' || lang) AS job_title,
    lower(source) AS company_name, lower(lang || ', remote') AS location,
    CASE lang WHEN 'de' THEN 'senior' ELSE 'mid' END AS experience_level,
    CASE lang WHEN 'fr' THEN 'remote' WHEN 'en' THEN NULL ELSE 'onsite' END AS work_type,
    lower('role ' || lang) AS search_role,
    CASE WHEN source NOT IN ('src5', 'src6')
      THEN try_cast('2024-01-' || lpad(source[4:], 2, '0') AS DATE) END AS posted_at
  FROM documents WHERE source <> 'src3'
),
large AS (
  SELECT l.*, lower(trim(text)) AS skills_raw, NULL::INTEGER AS annual_salary_estimate,
    NULL::VARCHAR AS description, 'kaggle_linkedin_large' AS data_source
  FROM listed l LEFT JOIN (SELECT * FROM documents WHERE trim(text) <> '') d ON posting_id = doc_id::VARCHAR
),
science AS (
  SELECT l.*, lower(trim(text)) AS skills_raw, NULL::INTEGER AS annual_salary_estimate,
    CASE WHEN quality = 1 THEN 'quality 1' END AS description, 'kaggle_ds' AS data_source
  FROM listed l
  LEFT JOIN (SELECT * FROM conversations WHERE trim(text) <> '') c ON posting_id = conv_id::VARCHAR
  LEFT JOIN (SELECT * FROM labels WHERE quality = 1) b ON posting_id = b.doc_id::VARCHAR
)"""


def _live(fan_out: bool) -> str:
    several = "n.n_regionkey = b.n_regionkey" + ("" if fan_out else " AND b.n_name = first_name")
    return f"""
firsts AS (SELECT n_regionkey AS rk, min(n_name) AS first_name FROM nation GROUP BY 1),
newest AS (
  SELECT * FROM placed QUALIFY row_number() OVER (
    PARTITION BY o_custkey ORDER BY o_orderdate DESC, c_mktsegment || ' ' || o_orderkey DESC) = 1
),
live AS (
  SELECT o_custkey::VARCHAR AS posting_id, lower(c_mktsegment) || ' ' || o_orderkey AS job_title,
    'Order ' || o_orderkey AS description, CASE WHEN o_orderstatus = 'F' THEN 'full_time' END AS work_type,
    lower(c_name) AS company, lower(c_mktsegment) AS category_label,
    CASE WHEN o_orderstatus <> 'P' THEN round(o_totalprice)::INTEGER END AS salary_max,
    CASE WHEN o_orderstatus <> 'P' THEN round((o_totalprice / 2 + o_totalprice) / 2)::INTEGER END AS salary_mid,
    round(o_totalprice / 2)::INTEGER AS salary_min,
    CASE o_orderpriority WHEN '2-HIGH' THEN lower(r_name) || ' county'
      WHEN '3-MEDIUM' THEN lower(r_name) || ' county' WHEN '5-LOW' THEN 'nowhere county' END AS county,
    CASE WHEN o_orderpriority <> '1-URGENT' THEN lower(n.n_name) END AS city,
    CASE o_orderpriority WHEN '2-HIGH' THEN lower(n.n_name) WHEN '3-MEDIUM' THEN lower(b.n_name) END AS state,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'us' WHEN '2-HIGH' THEN lower(n.n_name || ', ' || n.n_name)
      WHEN '3-MEDIUM' THEN lower('"' || n.n_name || '", ' || r_name || ' county')
      WHEN '5-LOW' THEN lower(n.n_name) || ', nowhere county' ELSE lower(n.n_name) END AS location,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'COUNTRY_ONLY' WHEN '2-HIGH' THEN 'CITY_STATE'
      WHEN '3-MEDIUM' THEN 'CITY_COUNTY' WHEN '5-LOW' THEN 'UNMATCHED_CITY_COUNTY' ELSE 'UNMATCHED' END
      AS location_match_type,
    n.n_nationkey::DOUBLE AS latitude, n.n_regionkey::DOUBLE AS longitude, o_orderdate AS created
  FROM newest n JOIN firsts ON n.n_regionkey = rk
  LEFT JOIN nation b ON o_orderpriority = '3-MEDIUM' AND {several}
)"""


_REMOTE = "work_type LIKE '%remote%'"
_NO_PAY = "NULL::INTEGER AS salary_min, NULL::INTEGER AS salary_max"
_JOB_POSTINGS = f"""
WITH {_LINKEDIN}, {_LISTED}, {_live(True)},
known AS (
  SELECT lower(c_mktsegment || ' ' || n_name) AS title, min(code) AS code FROM placed
  WHERE c_mktsegment NOT IN ('HOUSEHOLD', 'MACHINERY') GROUP BY 1
),
parts AS (
  SELECT posting_id, job_title, description, company_name, location, NULL::VARCHAR AS city,
    NULL::VARCHAR AS state, work_type, experience_level, posted_at, annual_salary_estimate, {_NO_PAY},
    coalesce(is_remote, {_REMOTE}) AS is_remote, false AS is_snapshot, data_source FROM linkedin
  UNION ALL
  SELECT posting_id, job_title, description, company_name, location, NULL, NULL, work_type,
    experience_level, posted_at::TIMESTAMP, annual_salary_estimate, {_NO_PAY},
    coalesce({_REMOTE}, job_title LIKE '%remote%', false), true, data_source
  FROM (FROM large UNION ALL FROM science)
  UNION ALL
  SELECT posting_id, job_title, description, company, location, city, state, work_type, NULL, created,
    salary_mid, salary_min, salary_max, coalesce({_REMOTE}, job_title LIKE '%remote%', location LIKE '%remote%'),
    false, 'adzuna' FROM live
)
SELECT parts.*, code AS onet_soc_code, code[1:7] AS soc_code,
  if(code IS NULL, 'unmatched', 'exact_match') AS soc_match_type
FROM parts LEFT JOIN known ON job_title = title"""

_NOISE = " OR ".join("name ILIKE '" + p.replace("'", "''") + "'" for p in NOISE_PATTERNS)
_NOISE_LIST = ", ".join(f"'{n}'" for n in NOISE_NAMES)

_POSTING_SKILLS = f"""
WITH raw AS (
  SELECT l_orderkey::VARCHAR AS posting_id, lower(p_name) AS item, 'kaggle_linkedin' AS data_source
  FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size > 3
  UNION ALL
  SELECT doc_id::VARCHAR, lower(trim(unnest(string_split(text, ',')))), 'kaggle_linkedin_large'
  FROM documents WHERE trim(text) <> ''
  UNION ALL
  SELECT conv_id::VARCHAR, lower(trim(unnest(string_split(text, ',')))), 'kaggle_ds'
  FROM conversations WHERE trim(text) <> ''
),
renamed AS (
  SELECT posting_id, coalesce(canonical, item) AS name, data_source
  FROM raw LEFT JOIN {_values(SKILL_VARIANTS, ['variant', 'canonical'])} ON item = variant
)
SELECT DISTINCT posting_id, name AS skill_name, data_source FROM renamed
WHERE length(name) BETWEEN 2 AND 50 AND name NOT IN ({_NOISE_LIST}) AND NOT ({_NOISE})"""

_MACRO_VALUES = {
    "UNRATE": "l_quantity", "CPIAUCSL": "l_extendedprice", "ICSA": "nullif(l_discount, 0)",
    "LNS12300060": "CASE l_returnflag WHEN 'A' THEN l_extendedprice END", "DFF": "l_tax",
}

ORACLE = {
    "market_snapshot": f"""
WITH {o.POSTS}
SELECT src AS data_source, snap AS is_snapshot, count(*) AS total_postings,
  count(DISTINCT company) AS unique_companies, min(posted) AS earliest_posting,
  max(posted) AS latest_posting, count(DISTINCT m) AS distinct_months, count(pay) AS postings_with_salary,
  {o.MEDIAN}, {o.AVERAGE}, {o.P25}, {o.P75}, {o.REMOTE}, count(occ) AS soc_matched_postings,
  round(count(occ) / count(*), 4) AS soc_match_rate
FROM posts GROUP BY src, snap""",
    "market_trends": f"""
WITH {o.POSTS},
g AS (
  SELECT m AS report_month, src AS data_source, count(*) AS total_postings,
    count(DISTINCT company) AS unique_companies, count(pay) AS postings_with_salary,
    {o.MEDIAN}, {o.AVERAGE}, {o.P25}, {o.P75}, {o.REMOTE},
    round(count(occ) / count(*), 4) AS soc_match_rate
  FROM posts WHERE NOT snap AND m IS NOT NULL GROUP BY ALL HAVING count(*) >= 5
)
SELECT * EXCLUDE b, total_postings - b AS postings_mom_change,
  {_change('total_postings', 'b')} AS postings_mom_change_pct,
  year(report_month) AS year, quarter(report_month) AS quarter, month(report_month) AS month_num
FROM (SELECT *, lag(total_postings) OVER (PARTITION BY data_source ORDER BY report_month) AS b FROM g)""",
    "economic_dashboard": f"""
WITH a AS (
  SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS mo, o_orderstatus AS id,
    MAP {{'F': 'unemployment rate', 'O': 'jolts hires', 'P': 'unlisted'}}[id] AS label, 'bls' AS sys,
    max(o_totalprice) AS v
  FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY ALL
),
b AS (
  SELECT date_trunc('month', l_shipdate)::TIMESTAMP AS mo,
    if(l_linestatus = 'F', 'F', l_returnflag) AS id,
    CASE id WHEN 'A' THEN 'consumer price index' WHEN 'N' THEN 'retail sales ex food services'
      ELSE 'unemployed less than 5 weeks' END AS label, 'fred' AS sys, avg(l_extendedprice) AS v
  FROM lineitem GROUP BY ALL
),
u AS (FROM a UNION ALL SELECT * FROM b WHERE NOT EXISTS (FROM a WHERE a.mo = b.mo AND a.id = b.id)),
w AS (SELECT *, lag(v, 12) OVER (PARTITION BY id ORDER BY mo) AS p FROM u)
SELECT mo AS report_month, id AS series_id, label AS series_name, sys AS source_system,
  MAP {{'unemployment rate': 'employment', 'jolts hires': 'labor_demand', 'unlisted': 'other',
    'consumer price index': 'inflation', 'retail sales ex food services': 'consumer',
    'unemployed less than 5 weeks': 'unemployment_duration'}}[label] AS category,
  round(v, 4) AS value, round(p, 4) AS value_12m_ago, round(v - p, 4) AS yoy_change,
  {_change('v', 'p')} AS yoy_change_pct, year(mo) AS year, quarter(mo) AS quarter
FROM w""",
    "role_analysis": f"""
WITH {o.POSTS}, {o.OCCUPATIONS}, {o.education()},
g AS (
  SELECT occ AS onet_soc_code, occ[1:7] AS soc_code, count(*) AS total_postings,
    count(*) FILTER (posted >= DATE '{AS_OF}' - INTERVAL 30 DAY) AS postings_last_30d,
    count(*) FILTER (posted >= DATE '{AS_OF}' - INTERVAL 90 DAY) AS postings_last_90d,
    count(DISTINCT company) AS unique_companies, count(pay) AS postings_with_salary,
    {o.P25}, {o.MEDIAN}, {o.P75}, {o.REMOTE},
    count(*) FILTER (src = 'adzuna') AS adzuna_postings,
    count(*) FILTER (src = 'kaggle_linkedin') AS linkedin_postings,
    count(*) FILTER (src = 'kaggle_linkedin_large') AS linkedin_large_postings,
    count(*) FILTER (src = 'kaggle_ds') AS ds_postings
  FROM posts WHERE {_MATCHED} GROUP BY occ HAVING count(*) >= 10
),
long AS (
  SELECT occ, unnest(['e', 'w', 'c']) AS k, unnest([experience, work, company]) AS v
  FROM posts WHERE {_MATCHED}
),
best AS (
  SELECT occ, k, v, row_number() OVER (PARTITION BY occ, k ORDER BY count(*) DESC, v) AS r
  FROM long WHERE v IS NOT NULL GROUP BY occ, k, v
),
habit AS (
  SELECT occ AS onet_soc_code, max(v) FILTER (k = 'e' AND r = 1) AS most_common_experience_level,
    max(v) FILTER (k = 'w' AND r = 1) AS most_common_work_type,
    string_agg(v, ', ' ORDER BY r) FILTER (k = 'c' AND r <= 5) AS top_hiring_companies
  FROM best GROUP BY occ
)
SELECT g.*, occupied.* EXCLUDE onet_soc_code, habit.* EXCLUDE onet_soc_code, pct_bachelors_degree,
  pct_masters_degree, pct_doctoral_degree
FROM g JOIN occupied USING (onet_soc_code) LEFT JOIN educated USING (onet_soc_code)
LEFT JOIN habit USING (onet_soc_code)""",
    "role_top_skills": f"""
WITH {_MENTIONS}, {o.OCCUPATIONS}, {o.rated('p_name')},
best AS (
  SELECT occ AS onet_soc_code, skill AS skill_name, n AS mention_count, total AS total_postings_for_soc,
    row_number() OVER (PARTITION BY occ ORDER BY n DESC, skill)::INTEGER AS skill_rank
  FROM hits JOIN roles USING (occ) WHERE n >= 3
)
SELECT best.*, occupation_title, round(mention_count / total_postings_for_soc, 4) AS pct_of_postings,
  importance_value AS onet_importance_value, level_value AS onet_level_value
FROM best JOIN occupied USING (onet_soc_code)
LEFT JOIN rated ON rated.onet_soc_code = best.onet_soc_code AND lower(rated.skill_name) = best.skill_name
WHERE skill_rank <= 20""",
    "skills_demand": f"""
WITH {o.POSTS}, {o.SKILLS},
c AS (
  SELECT skill AS skill_name, m AS report_month, count(*) AS mention_count,
    count(DISTINCT pid) AS distinct_postings
  FROM posts JOIN skilled USING (pid, src) WHERE m IS NOT NULL GROUP BY ALL
),
w AS (
  SELECT *, sum(mention_count) OVER (PARTITION BY skill_name) AS t,
    lag(mention_count) OVER (PARTITION BY skill_name ORDER BY report_month) AS prev_month_mentions
  FROM c
)
SELECT w.* EXCLUDE t, total AS total_postings_that_month,
  round(distinct_postings / total, 6) AS pct_of_postings,
  {_change('mention_count', 'prev_month_mentions')} AS mom_change_pct,
  coalesce(mention_count >= 10 AND (mention_count - prev_month_mentions) / prev_month_mentions > 0.1, false)
    AS is_trending,
  year(report_month) AS year, month(report_month) AS month_num
FROM w JOIN (SELECT m AS report_month, count(DISTINCT pid) AS total FROM posts GROUP BY 1) USING (report_month)
WHERE t >= 50 AND mention_count >= 5""",
    "metro_comparison": f"""
WITH {o.POSTS}, {o.metros()},
g AS (
  SELECT lower(state) AS state, CASE WHEN state IN ('AMERICA', 'ASIA', 'EUROPE') THEN n_nationkey::VARCHAR END
      AS cbsa_fips, count(*) AS total_postings, count(DISTINCT company) AS unique_companies,
    count(pay) AS postings_with_salary, {o.MEDIAN}, {o.AVERAGE}, {o.P25}, {o.P75}, {o.REMOTE},
    count(*) FILTER (src = 'adzuna') AS adzuna_postings,
    count(*) FILTER (src <> 'adzuna') AS other_source_postings,
    CASE WHEN count(pay) >= 5 THEN quantile_cont(pay, 0.5) END AS mid
  FROM posts WHERE state IS NOT NULL GROUP BY ALL HAVING count(*) >= 5
)
SELECT g.* EXCLUDE mid, metro_name, median_household_income,
  CASE WHEN median_household_income > 0 THEN round(mid / median_household_income, 2) END
    AS salary_to_income_ratio,
  pct_bachelors_or_higher, pct_work_from_home, pct_information_industry, pct_mgmt_business_science_arts,
  pct_professional_scientific_management_admin_waste, pct_broadband,
  unemployment_rate AS acs_unemployment_rate, mean_commute_minutes
FROM g LEFT JOIN metros USING (cbsa_fips)""",
    "occupation_skills_profile": f"""
WITH {_MENTIONS}, {o.OCCUPATIONS}, {o.TOOLS},
lhs AS (
  SELECT t.*, lower(technology_name) AS skill FROM tools t
  WHERE onet_soc_code IN (SELECT occ FROM roles)
),
rhs AS (SELECT occ AS onet_soc_code, skill, n FROM hits WHERE occ IN (SELECT occ FROM roles))
SELECT onet_soc_code, occupation_title, skill AS skill_name, technology_name IS NOT NULL AS in_onet,
  n IS NOT NULL AS in_market, is_hot_technology AS onet_is_hot_technology,
  is_in_demand AS onet_is_in_demand, commodity_title AS onet_commodity_title,
  coalesce(n, 0) AS posting_mention_count, total AS total_postings_for_soc,
  round(coalesce(n, 0) / total, 4) AS posting_pct_of_postings,
  CASE WHEN n IS NULL THEN 'onet_only' WHEN technology_name IS NULL THEN 'market_only' ELSE 'aligned' END
    AS gap_direction
FROM lhs FULL JOIN rhs USING (onet_soc_code, skill) JOIN roles ON occ = onet_soc_code
JOIN occupied USING (onet_soc_code)
WHERE technology_name IS NOT NULL OR n >= 3""",
    "dim_occupations": f"WITH {o.OCCUPATIONS} FROM occupied",
    "dim_skills": f"WITH {o.rated('p_name')} FROM rated",
    "dim_knowledge": f"WITH {o.rated('p_brand')} FROM rated",
    "dim_work_activities": f"WITH {o.rated('p_type')} FROM rated",
    "dim_technology_skills": f"WITH {o.TOOLS} FROM tools",
    "dim_education_requirements": f"WITH {o.PLACED_ORDERS}, {o.education()} FROM educated",
    "dim_metros": f"WITH {o.metros()} FROM metros",
    "dim_companies": """
WITH facts AS (
  SELECT l_suppkey AS company_id, string_agg(DISTINCT lower(p_brand), ', ' ORDER BY lower(p_brand)) AS industries,
    string_agg(DISTINCT lower(p_type), ', ' ORDER BY lower(p_type)) FILTER (l_quantity > 49) AS specialties
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1
),
heads AS (
  SELECT l_suppkey AS company_id, l_quantity::INTEGER AS employee_count, l_linenumber::INTEGER AS follower_count
  FROM lineitem WHERE l_returnflag <> 'R' QUALIFY row_number() OVER (
    PARTITION BY l_suppkey ORDER BY l_shipdate::DATE DESC, l_quantity DESC, l_linenumber DESC) = 1
)
SELECT s_suppkey AS company_id, lower(s_name) AS company_name, 'About ' || s_name AS company_description,
  n_regionkey AS company_size, lower(n_name) AS city, 'state ' || n_regionkey AS state, 'us' AS country,
  s_nationkey::VARCHAR AS zip_code, 'http://' || s_name AS url, industries, specialties, employee_count,
  follower_count
FROM supplier JOIN nation ON s_nationkey = n_nationkey
LEFT JOIN facts ON s_suppkey = facts.company_id LEFT JOIN heads ON s_suppkey = heads.company_id""",
    "dim_date_spine": """
WITH d AS (
  SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL 1 DAY))::DATE AS full_date
  FROM orders
)
SELECT full_date, strftime(full_date, '%Y%m%d')::INTEGER AS date_key, year(full_date) AS year,
  month(full_date) AS month, quarter(full_date) AS quarter, isodow(full_date)::INTEGER AS day_of_week,
  isodow(full_date) > 5 AS is_weekend, monthname(full_date) AS month_name
FROM d""",
    "title_mapping": f"""
SELECT DISTINCT {o.CODE} AS onet_soc_code, ({o.CODE})[1:7] AS soc_code,
  lower(if(c_mktsegment IN ('HOUSEHOLD', 'MACHINERY'), 'other ', '') || c_mktsegment || ' ' || n_name) AS title_lower,
  lower(c_mktsegment) AS short_title_lower, 'alternate_title' AS title_source
FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL
SELECT {o.CODE}, ({o.CODE})[1:7], lower('occupation ' || n_name), lower('occupation ' || n_name),
  'occupation_title' FROM nation""",
    "linkedin_enriched": f"WITH {_LINKEDIN} FROM linkedin",
    "large_enriched": f"WITH {_LISTED} FROM large",
    "ds_enriched": f"WITH {_LISTED} FROM science",
    "live_enriched": f"WITH {o.PLACED_ORDERS}, {_live(True)} FROM live",
    "live_enriched_one_match": f"WITH {o.PLACED_ORDERS}, {_live(False)} FROM live",
    "job_postings": _JOB_POSTINGS,
    "posting_skills": _POSTING_SKILLS,
    "labor_observations": f"""
WITH x AS (
  SELECT MAP {{'F': 'LNS12300060', 'O': 'JTS000000000000000HIR', 'P': 'UNKNOWN1'}}[o_orderstatus] AS series_id,
    CASE o_orderpriority WHEN '5-LOW' THEN 'M13' WHEN '2-HIGH' THEN 'S01'
      ELSE 'M' || lpad(month(o_orderdate)::VARCHAR, 2, '0') END AS period_code, *
  FROM orders WHERE NOT (o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P')
)
SELECT x.series_id, coalesce(label, x.series_id) AS series_name,
  CASE WHEN period_code NOT IN ('M13', 'S01') THEN date_trunc('month', o_orderdate)::DATE END AS observation_date,
  year(o_orderdate)::VARCHAR AS obs_year, period_code, monthname(o_orderdate) AS period_name,
  o_totalprice AS value, period_code = 'M13' AS is_annual_average,
  o_totalprice - 1000 AS net_change_1m, NULL::DOUBLE AS net_change_12m, o_custkey::DOUBLE AS pct_change_1m,
  CASE o_orderstatus WHEN 'F' THEN 1.5::DOUBLE END AS pct_change_12m
FROM x LEFT JOIN {_values(LABOR_SERIES, ['id', 'label'])} ON id = series_id""",
    "macro_indicators": f"""
WITH x AS ({" UNION ALL ".join(
        f"SELECT '{s_}' AS series_id, ({e})::DOUBLE AS value, l_shipdate::DATE AS observation_date "
        f"FROM lineitem WHERE l_linenumber < 7" for s_, e in _MACRO_VALUES.items())})
SELECT observation_date, year(observation_date) AS obs_year, month(observation_date) AS obs_month, series_id,
  label AS series_name, value
FROM x JOIN {_values(MACRO_SERIES, ['id', 'label'])} ON id = series_id WHERE value IS NOT NULL""",
    "posting_skill_joined": f"""
WITH {o.POSTS}, {o.SKILLS}
SELECT pid AS posting_id, skill AS skill_name, occ AS onet_soc_code, m AS report_month, count(*) AS n
FROM posts JOIN skilled USING (pid, src) WHERE occ IS NOT NULL OR m IS NOT NULL GROUP BY ALL""",
}

_CHAINED = {
    o.POSTS: f"""
posts AS (
  SELECT posting_id AS pid, company_name AS company, posted_at AS posted, date_trunc('month', posted_at)::TIMESTAMP AS m,
    annual_salary_estimate AS pay, is_remote AS remote, is_snapshot AS snap, data_source AS src, onet_soc_code AS occ
  FROM ({_JOB_POSTINGS})
)""",
    o.SKILLS: f"""
skilled AS (SELECT posting_id AS pid, skill_name AS skill, data_source AS src FROM ({_POSTING_SKILLS}))""",
}


def _chained(sql: str) -> str:
    """A mart's SQL on the facts of the raw feeds in place of the shapes of the facts."""
    for shape, fact in _CHAINED.items():
        sql = sql.replace(shape, fact)
    return sql


ORACLE |= {
    "chain_market_snapshot": _chained(ORACLE["market_snapshot"]),
    "chain_role_top_skills": _chained(ORACLE["role_top_skills"]),
    "chain_skills_profile": _chained(ORACLE["occupation_skills_profile"]),
}
