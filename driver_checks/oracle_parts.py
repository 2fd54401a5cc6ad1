"""SQL for the shapes of ``shapes.py``, as common table expressions the oracle queries start from."""

from __future__ import annotations

from jobtide.fixed_values import METRO_VARIABLES

SOURCE = (
    "CASE {0} WHEN 'F' THEN 'kaggle_linkedin' WHEN 'O' THEN 'kaggle_linkedin_large' ELSE 'adzuna' END"
)
CODE = "(11 + 2 * n_regionkey)::VARCHAR || '-' || lpad(n_nationkey::VARCHAR, 4, '0') || '.00'"

PLACED_ORDERS = f"""
placed AS (
  SELECT o.*, c_name, c_mktsegment, c_acctbal, n_nationkey, n_name, n_regionkey, r_name, {CODE} AS code
  FROM orders o, customer, nation, region
  WHERE o_custkey = c_custkey AND c_nationkey = n_nationkey AND n_regionkey = r_regionkey
)"""

POSTS = PLACED_ORDERS + f""",
posts AS (
  SELECT o_orderkey::VARCHAR AS pid, lower(c_name) AS company, lower(c_mktsegment) AS experience,
    CASE WHEN o_orderpriority <> '5-LOW' THEN lower(o_orderpriority) END AS work,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderdate END AS posted,
    date_trunc('month', posted)::TIMESTAMP AS m,
    CASE WHEN o_orderpriority <> '5-LOW' THEN round(o_totalprice)::INTEGER END AS pay,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority = '1-URGENT' END AS remote,
    o_orderstatus = 'O' AS snap, {SOURCE.format('o_orderstatus')} AS src,
    nullif(r_name, 'AFRICA') AS state, n_name AS city, n_nationkey, n_regionkey,
    CASE WHEN c_mktsegment NOT IN ('HOUSEHOLD', 'MACHINERY') THEN code END AS occ
  FROM placed
)"""

SKILLS = f"""
skilled AS (
  SELECT DISTINCT l_orderkey::VARCHAR AS pid, lower(p_name) AS skill, {SOURCE.format('l_linestatus')} AS src
  FROM lineitem JOIN part ON l_partkey = p_partkey
)"""

SUPPLIED = f"""
supplied AS (
  SELECT l.*, part.*, {CODE} AS code
  FROM lineitem l, part, supplier, nation
  WHERE l_partkey = p_partkey AND l_suppkey = s_suppkey AND s_nationkey = n_nationkey
)"""


def capital(column: str) -> str:
    """Every word of a two-word name with a capital first letter."""
    return f"list_aggregate([upper(w[1]) || lower(w[2:]) FOR w IN string_split({column}, ' ')], 'string_agg', ' ')"


def rated(element: str) -> str:
    return SUPPLIED + f""",
rated AS (
  SELECT code AS onet_soc_code, upper({element}) AS element_id, {capital(element)} AS skill_name,
    max(l_extendedprice) FILTER (l_returnflag = 'A') AS importance_value,
    max(l_extendedprice) FILTER (l_returnflag = 'N') AS level_value
  FROM supplied WHERE l_linestatus = 'O' GROUP BY ALL
  HAVING importance_value IS NOT NULL AND level_value IS NOT NULL
)"""


TOOLS = SUPPLIED + f""",
tools AS (
  SELECT DISTINCT code AS onet_soc_code,
    {capital('p_name')} || CASE WHEN p_brand <> 'Brand#1' THEN ' ' || p_brand ELSE '' END AS technology_name,
    p_size::BIGINT AS commodity_code, p_type AS commodity_title,
    CASE WHEN p_size <= 40 THEN p_size > 20 END AS is_hot_technology, p_type = 'PROMO' AS is_in_demand
  FROM supplied
)"""

OCCUPATIONS = f"""
occupied AS (
  SELECT {CODE} AS onet_soc_code, 'Occupation ' || n_name AS occupation_title,
    'Work of ' || n_name AS occupation_description, n_regionkey + 1 AS job_zone
  FROM nation
)"""

LEVELS = [
    "pct_less_than_high_school", "pct_high_school_diploma", "pct_postsecondary_certificate",
    "pct_some_college", "pct_associates_degree", "pct_bachelors_degree",
    "pct_post_baccalaureate_certificate", "pct_masters_degree", "pct_post_masters_certificate",
    "pct_first_professional_degree", "pct_doctoral_degree", "pct_post_doctoral_training",
]


def education(digits: int | None = 2) -> str:
    """Needs PLACED_ORDERS in front."""
    def level(i: int, name: str) -> str:
        total = f"coalesce(sum(o_totalprice) FILTER (month(o_orderdate) = {i}), 0.0)"
        return f"{f'round({total}, {digits})' if digits is not None else total} AS {name}"

    return f"""
educated AS (
  SELECT code AS onet_soc_code, {', '.join(level(i, n) for i, n in enumerate(LEVELS, 1))}
  FROM placed
  WHERE o_orderstatus <> 'P' AND c_mktsegment <> 'HOUSEHOLD' AND o_orderpriority IN ('1-URGENT', '2-HIGH')
  GROUP BY code
)"""


def metros() -> str:
    def figure(i: int, name: str, kind: str) -> str:
        number = f"(high + {i})::{kind.upper()}"
        return f"{f'CASE WHEN n_regionkey <> 4 THEN {number} END' if i == 2 else number} AS {name}"

    return f"""
metros AS (
  SELECT n_nationkey::VARCHAR AS cbsa_fips, n_name AS metro_name,
    {', '.join(figure(i, n, k) for i, (_, n, k) in enumerate(METRO_VARIABLES))}
  FROM nation JOIN (SELECT c_nationkey, floor(max(c_acctbal)) AS high FROM customer GROUP BY 1)
    ON n_nationkey = c_nationkey
)"""


def pay(expression: str, name: str) -> str:
    return f"CASE WHEN count(pay) >= 5 THEN round({expression})::INTEGER END AS {name}"


MEDIAN = pay("quantile_cont(pay, 0.5)", "median_salary")
AVERAGE = pay("avg(pay)", "avg_salary")
P25 = pay("quantile_cont(pay, 0.25)", "salary_p25")
P75 = pay("quantile_cont(pay, 0.75)", "salary_p75")
REMOTE = """count(*) FILTER (remote) AS remote_postings,
    round(count(*) FILTER (remote) / count(*), 4) AS pct_remote"""
