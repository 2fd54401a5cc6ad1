"""Dimension tables D1–D9."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.fixed_values import EDUCATION_LEVELS, METRO_KEY, METRO_VARIABLES
from jobtide.functions.numbers import safe_cast
from jobtide.functions.text import norm, not_blank, trimmed, yes_no
from jobtide.operators.groups import agg_sorted_distinct, category_pivot, rating_pivot
from jobtide.operators.joins import inner_on, left_chain
from jobtide.operators.reshape import calendar
from jobtide.operators.windows import latest_first, latest_per_key

SPINE_START = dt.date(2015, 1, 1)


def _code() -> Column:
    return F.col("`O*NET-SOC Code`").alias("onet_soc_code")


def _reliable() -> Column:
    """Rows not marked for suppression; an unknown mark is not good enough."""
    return F.col("Recommend Suppress") != "Y"


def dim_occupations(occupations: DataFrame, job_zones: DataFrame) -> DataFrame:
    names = occupations.select(
        _code(),
        trimmed(F.col("Title")).alias("occupation_title"),
        trimmed(F.col("Description")).alias("occupation_description"),
    )
    return inner_on(names, job_zones.select(_code(), F.col("Job Zone").alias("job_zone")), "onet_soc_code")


def dim_ratings(ratings: DataFrame) -> DataFrame:
    """Importance and level per occupation and element: skills, knowledge or work activities."""
    reliable = ratings.where(_reliable()).select(
        _code(),
        trimmed(F.col("Element ID")).alias("element_id"),
        trimmed(F.col("Element Name")).alias("skill_name"),
        "Scale ID",
        "Data Value",
    )
    return rating_pivot(
        reliable, ["onet_soc_code", "element_id", "skill_name"], "Scale ID", "Data Value",
        {"IM": "importance_value", "LV": "level_value"},
    )


def dim_technology_skills(technology: DataFrame) -> DataFrame:
    return technology.select(
        _code(),
        F.col("Example").alias("technology_name"),
        F.col("Commodity Code").alias("commodity_code"),
        trimmed(F.col("Commodity Title")).alias("commodity_title"),
        yes_no(F.col("Hot Technology")).alias("is_hot_technology"),
        yes_no(F.col("In Demand")).alias("is_in_demand"),
    )


def dim_education_requirements(education: DataFrame, categories: DataFrame) -> DataFrame:
    """Share of workers per education level; only levels the category list describes count."""
    keys = ["element_id", "element_name", "scale_id", "category"]
    required = education.where(_reliable()).select(
        _code(),
        trimmed(F.col("Element ID")).alias("element_id"),
        trimmed(F.col("Element Name")).alias("element_name"),
        trimmed(F.col("Scale ID")).alias("scale_id"),
        F.col("Category").cast("int").alias("category"),
        F.col("Data Value").alias("data_value"),
    ).where(F.col("scale_id") == "RL")
    described = categories.select(
        trimmed(F.col("Element ID")).alias("element_id"),
        trimmed(F.col("Element Name")).alias("element_name"),
        trimmed(F.col("Scale ID")).alias("scale_id"),
        safe_cast(F.col("Category"), "int").alias("category"),
    )
    return category_pivot(
        inner_on(required, described, keys), "onet_soc_code", "category", "data_value",
        dict(enumerate(EDUCATION_LEVELS, start=1)),
    )


def dim_metros(profiles: DataFrame) -> DataFrame:
    return profiles.select(
        F.col(f"`{METRO_KEY}`").cast("string").alias("cbsa_fips"),
        trimmed(F.col("NAME")).alias("metro_name"),
        *[safe_cast(F.col(code), kind).alias(name) for code, name, kind in METRO_VARIABLES],
    )


def dim_companies(companies: DataFrame, industries: DataFrame, specialties: DataFrame,
                  employee_counts: DataFrame) -> DataFrame:
    """Companies with their industries, specialties and latest head count."""
    company_id = F.col("company_id").cast("bigint").alias("company_id")
    base = companies.where(F.col("company_id").isNotNull()).select(
        company_id,
        norm(F.col("name")).alias("company_name"),
        trimmed(F.col("description")).alias("company_description"),
        F.col("company_size").cast("int").alias("company_size"),
        *[norm(F.col(c)).alias(c) for c in ("city", "state", "country")],
        *[trimmed(F.col(c)).alias(c) for c in ("zip_code", "url")],
    )

    def joined(df: DataFrame, column: str, name: str) -> DataFrame:
        present = df.where(not_blank(F.col(column))).select(company_id, column)
        return agg_sorted_distinct(present, "company_id", norm(F.col(column)), name)

    counted = employee_counts.where(F.col("employee_count").isNotNull()).select(
        company_id, "employee_count", "follower_count", "time_recorded"
    )
    latest = latest_per_key(
        counted, "company_id", latest_first("time_recorded", "employee_count", "follower_count")
    ).select(
        "company_id",
        F.col("employee_count").cast("int").alias("employee_count"),
        F.col("follower_count").cast("int").alias("follower_count"),
    )
    return left_chain(
        base,
        joined(industries, "industry", "industries"),
        joined(specialties, "speciality", "specialties"),
        latest,
        on="company_id",
    )


def dim_date_spine(spark: SparkSession, as_of: dt.date, start: dt.date = SPINE_START) -> DataFrame:
    """A row per day from ``start`` to ``as_of``, both included."""
    bounds = spark.range(1).select(F.lit(start).alias("lo"), F.lit(as_of).alias("hi"))
    return calendar(bounds, "lo", "hi")
