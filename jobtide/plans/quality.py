"""Data-quality checks Q1–Q5: how many rows (for unique: values) of a column fail.

All row checks of a table run in one aggregation over one scan; only ``unique`` needs a shuffle
by the checked value.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from jobtide.fixed_values import (
    DATA_SCIENCE, EDUCATION_LEVELS, LINKEDIN, LINKEDIN_LARGE, METRO_VARIABLES, SOURCES,
)


@dataclass(frozen=True)
class Checks:
    """Columns of one table by check."""

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    positive_value: tuple[str, ...] = ()
    text_trimmed: tuple[str, ...] = ()
    accepted_values: dict[str, list[str]] = field(default_factory=dict)


def negative(c: Column) -> Column:
    """Q1: below zero; zero and NULL pass."""
    return c < 0


def untrimmed(c: Column) -> Column:
    """Q2: outer blanks."""
    return F.trim(c) != c


def not_accepted(c: Column, values: list[str]) -> Column:
    """Q5: outside the list; NULL passes."""
    return ~c.isin(*values)


def _row_checks(checks: Checks) -> dict[tuple[str, str], Column]:
    failing = {("not_null", c): F.col(c).isNull() for c in checks.not_null}
    failing |= {("positive_value", c): negative(F.col(c)) for c in checks.positive_value}
    failing |= {("text_trimmed", c): untrimmed(F.col(c)) for c in checks.text_trimmed}
    failing |= {
        ("accepted_values", c): not_accepted(F.col(c), values)
        for c, values in checks.accepted_values.items()
    }
    return failing


def repeated(df: DataFrame, column: str) -> DataFrame:
    """Q4: values that occur more than once."""
    present = df.where(F.col(column).isNotNull())
    return present.groupBy(column).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def failing_rows(df: DataFrame, check: str, column: str, values: list[str] | None = None) -> DataFrame:
    """The rows behind one number of the report."""
    if check == "unique":
        return df.join(repeated(df, column).select(column), column, "left_semi")
    found = _row_checks(Checks(**{check: {column: values} if check == "accepted_values" else (column,)}))
    return df.where(found[(check, column)])


def check_table(df: DataFrame, table: str, checks: Checks) -> DataFrame:
    """(table, check, column, failures), a row per check."""
    parts = []
    row_checks = _row_checks(checks)
    if row_checks:
        counted = df.agg(*[
            F.count_if(failing).alias(f"{check}|{column}")
            for (check, column), failing in row_checks.items()
        ])
        keys = [f"`{name}`" for name in counted.columns]
        long = counted.unpivot([], [F.col(k) for k in keys], "key", "failures")
        parts.append(long.select(
            F.split_part("key", F.lit("|"), F.lit(1)).alias("check"),
            F.split_part("key", F.lit("|"), F.lit(2)).alias("column"),
            "failures",
        ))
    for column in checks.unique:
        parts.append(repeated(df, column).agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit("unique").alias("check"), F.lit(column).alias("column"), "failures"))
    return reduce(DataFrame.unionByName, parts).select(
        F.lit(table).alias("table"), "check", "column", "failures")


def observed(df: DataFrame, checks: Checks) -> tuple[DataFrame, Observation | None]:
    """The rows with their row checks as metrics of whatever action runs over them, a write for instance."""
    row_checks = _row_checks(checks)
    if not row_checks:
        return df, None
    metrics = Observation()
    return df.observe(metrics, *[
        F.count_if(failing).alias(f"{check}|{column}") for (check, column), failing in row_checks.items()]), metrics


def report_of_writes(spark: SparkSession, metrics: dict[str, Observation | None], tables: dict[str, DataFrame],
                     checks: dict[str, Checks] | None = None) -> DataFrame:
    """:func:`quality_report` of tables whose row checks were observed while they were written.

    Only the columns that must be unique are read again.
    """
    wanted = checks or TABLE_CHECKS
    found = []
    for table, observation in metrics.items():
        counted = observation.get if observation is not None else {}
        found += [(table, check, column, int(counted.get(f"{check}|{column}", 0))) for check, column in _row_checks(wanted[table])]
    rows = spark.createDataFrame(found, "table string, check string, column string, failures bigint")
    uniques = [check_table(tables[table], table, Checks(unique=wanted[table].unique))
               for table in metrics if wanted[table].unique]
    return reduce(DataFrame.unionByName, uniques, rows)


def quality_report(tables: dict[str, DataFrame], checks: dict[str, Checks] | None = None) -> DataFrame:
    """All checks of all given tables that have some."""
    wanted = checks or TABLE_CHECKS
    return reduce(
        DataFrame.unionByName,
        [check_table(df, name, wanted[name]) for name, df in tables.items() if name in wanted],
    )


# --- the checks of the engine's own tables ------------------------------------------------------

_RATED = Checks(
    not_null=("onet_soc_code", "element_id", "skill_name", "importance_value", "level_value"),
)
_EDUCATION = tuple(EDUCATION_LEVELS)
_METRO_FIGURES = tuple(name for _, name, _ in METRO_VARIABLES)

# Which columns of the engine's own tables are checked, and for what.
TABLE_CHECKS: dict[str, Checks] = {
    "dim_occupations": Checks(
        not_null=("onet_soc_code", "occupation_title", "occupation_description"),
        unique=("onet_soc_code",),
        text_trimmed=("occupation_title", "occupation_description"),
    ),
    "dim_skills": Checks(not_null=_RATED.not_null, text_trimmed=("skill_name",)),
    "dim_knowledge": Checks(not_null=_RATED.not_null, text_trimmed=("skill_name",)),
    "dim_work_activities": Checks(not_null=_RATED.not_null, text_trimmed=("skill_name",)),
    "dim_technology_skills": Checks(
        not_null=(
            "onet_soc_code", "technology_name", "commodity_code", "commodity_title",
            "is_hot_technology", "is_in_demand",
        ),
        text_trimmed=("commodity_title",),
    ),
    "dim_education_requirements": Checks(
        not_null=("onet_soc_code", *_EDUCATION), unique=("onet_soc_code",)
    ),
    "dim_metros": Checks(
        not_null=("cbsa_fips", "metro_name", *_METRO_FIGURES),
        unique=("cbsa_fips", "metro_name"),
        text_trimmed=("metro_name",),
        positive_value=(
            "median_household_income", "median_earnings_male_ft_yr_round",
            "median_earnings_female_ft_yr_round",
        ),
    ),
    "dim_companies": Checks(not_null=("company_id",), unique=("company_id",)),
    "dim_date_spine": Checks(
        not_null=(
            "date_key", "full_date", "year", "month", "quarter", "day_of_week", "is_weekend",
            "month_name",
        ),
        unique=("date_key", "full_date"),
    ),
    "int_title_to_soc_mapping": Checks(
        not_null=("title_lower", "onet_soc_code", "soc_code", "title_source"),
        unique=("title_lower",),
    ),
    "int_kaggle_linkedin__postings_enriched": Checks(
        not_null=("posting_id", "job_title"),
        positive_value=("annual_salary_estimate",),
        accepted_values={"data_source": [LINKEDIN]},
    ),
    "int_kaggle_large__postings_enriched": Checks(
        not_null=("posting_id", "job_title"), accepted_values={"data_source": [LINKEDIN_LARGE]}
    ),
    "int_kaggle_ds__postings_enriched": Checks(
        not_null=("posting_id", "job_title"), accepted_values={"data_source": [DATA_SCIENCE]}
    ),
    "int_adzuna__postings_enriched": Checks(
        not_null=("posting_id", "job_title", "category_label", "created"),
        positive_value=("salary_mid",),
    ),
    "fct_job_postings": Checks(
        not_null=("posting_id", "job_title", "soc_match_type", "data_source", "is_remote", "is_snapshot"),
        positive_value=("annual_salary_estimate",),
        accepted_values={"data_source": SOURCES},
    ),
    "fct_posting_skills": Checks(
        not_null=("posting_id", "skill_name", "data_source"),
        accepted_values={"data_source": [LINKEDIN, LINKEDIN_LARGE, DATA_SCIENCE]},
    ),
    "fct_bls_observations": Checks(not_null=("series_id", "series_name", "value")),
    "fct_fred_indicators": Checks(not_null=("observation_date", "series_id", "series_name", "value")),
    "gold_market_snapshot": Checks(
        not_null=("data_source", "is_snapshot", "total_postings"),
        unique=("data_source",),
        positive_value=("total_postings",),
        accepted_values={"data_source": SOURCES},
    ),
    "gold_market_trends": Checks(
        not_null=("report_month", "data_source", "total_postings"),
        positive_value=("total_postings",),
    ),
    "gold_economic_dashboard": Checks(
        not_null=("report_month", "series_id", "series_name", "source_system", "category", "value"),
        accepted_values={"source_system": ["bls", "fred"]},
    ),
    "gold_role_analysis": Checks(
        not_null=("onet_soc_code", "occupation_title", "total_postings"),
        unique=("onet_soc_code",),
        positive_value=("total_postings",),
    ),
    "gold_role_top_skills": Checks(
        not_null=("onet_soc_code", "occupation_title", "skill_name", "skill_rank", "mention_count"),
        positive_value=("skill_rank", "mention_count"),
    ),
    "gold_metro_comparison": Checks(
        not_null=("state", "total_postings"), positive_value=("total_postings",)
    ),
    "gold_skills_demand": Checks(
        not_null=("skill_name", "report_month", "mention_count", "distinct_postings"),
        positive_value=("mention_count", "distinct_postings"),
    ),
    "gold_occupation_skills_profile": Checks(
        not_null=("onet_soc_code", "skill_name", "gap_direction"),
        accepted_values={"gap_direction": ["market_only", "onet_only", "aligned"]},
    ),
}
