"""Fact tables F1–F4."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.fixed_values import (
    DATA_SCIENCE, LABOR_SERIES, LINKEDIN, LINKEDIN_LARGE, LIVE, MACRO_SERIES, NOISE_NAMES,
    NOISE_PATTERNS, SKILL_LENGTHS,
)
from jobtide.functions.dates import month_of, period_date, safe_date, year_of
from jobtide.functions.labels import remote_flag
from jobtide.functions.numbers import safe_cast
from jobtide.functions.text import ilike_any, norm, not_blank, trimmed
from jobtide.operators.joins import (
    apply_dictionary, inline_mapping, lookup_or_self, match_titles, resolve_codes,
)
from jobtide.operators.reshape import explode_csv, to_long, union_sources

POSTING_COLUMNS = [
    "posting_id", "job_title", "description", "company_name", "location", "city", "state",
    "work_type", "experience_level", "posted_at", "annual_salary_estimate", "salary_min",
    "salary_max", "is_remote", "is_snapshot", "onet_soc_code", "soc_code", "soc_match_type",
    "data_source",
]

# Columns a feed may lack, with the type they have in the fact.
_OPTIONAL = {
    "city": "string", "state": "string", "salary_min": "int", "salary_max": "int",
    "experience_level": "string",
}


def _posting_rows(df: DataFrame, is_remote: Column, is_snapshot: bool) -> DataFrame:
    missing = {c: F.lit(None).cast(t) for c, t in _OPTIONAL.items() if c not in df.columns}
    rows = df.withColumns({
        **missing,
        "posted_at": F.col("posted_at").cast("timestamp_ntz"),
        "is_remote": is_remote,
        "is_snapshot": F.lit(is_snapshot),
    })
    return rows.select(*[c for c in POSTING_COLUMNS if "soc" not in c])


def job_postings(linkedin: DataFrame, large: DataFrame, science: DataFrame, live: DataFrame,
                 titles: DataFrame) -> DataFrame:
    """All postings under one schema, classified by exact title."""
    work_type, title, location = F.col("work_type"), F.col("job_title"), F.col("location")
    live_rows = live.withColumnsRenamed(
        {"company": "company_name", "created": "posted_at", "salary_mid": "annual_salary_estimate"}
    ).withColumn("data_source", F.lit(LIVE))
    everything = union_sources(
        _posting_rows(linkedin, remote_flag(work_type, stated=F.col("is_remote")), False),
        _posting_rows(large, remote_flag(work_type, title, default=False), True),
        _posting_rows(science, remote_flag(work_type, title, default=False), True),
        _posting_rows(live_rows, remote_flag(work_type, title, location, default=False), False),
    )
    return match_titles(everything, titles).select(*POSTING_COLUMNS)


def drop_non_skills(df: DataFrame, column: str = "skill_name") -> DataFrame:
    """Remove names that are requirements, benefits or sentence fragments rather than skills.

    The name is tested where it stands: one regular expression costs less than gathering a
    dictionary of names and joining the verdicts back, which would shuffle on hot names.
    """
    name = F.col(column)
    fits = F.length(name).between(*SKILL_LENGTHS)
    return df.where(fits & ~name.isin(*NOISE_NAMES) & ~ilike_any(name, NOISE_PATTERNS))


def posting_skills(linkedin_skills: DataFrame, mapping_skills: DataFrame, large_skills: DataFrame,
                   science_skills: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Posting × skill, each pair once per source, with skill names normalised and noise removed."""
    def cleaned(df: DataFrame) -> DataFrame:
        return drop_non_skills(apply_dictionary(df, dictionary, "skill_name", "raw_skill", "canonical_skill"))

    # A code's name is cleaned once in the mapping, not on every row that has the code.
    names = cleaned(mapping_skills.where(not_blank(F.col("skill_name"))).select(
        "skill_abr", norm(F.col("skill_name")).alias("skill_name")))
    coded = resolve_codes(linkedin_skills, names, "skill_abr", "skill_name").select(
        F.col("job_id").cast("string").alias("posting_id"), "skill_name", F.lit(LINKEDIN).alias("data_source"))

    def listed(df: DataFrame, source: str) -> DataFrame:
        rows = df.where(not_blank(F.col("job_skills"))).select("job_link", "job_skills")
        return explode_csv(rows, "job_skills", "skill").select(
            trimmed(F.col("job_link")).alias("posting_id"),
            norm(F.col("skill")).alias("skill_name"),
            F.lit(source).alias("data_source"),
        )

    raw = union_sources(listed(large_skills, LINKEDIN_LARGE), listed(science_skills, DATA_SCIENCE))
    return union_sources(coded, cleaned(raw)).select("posting_id", "skill_name", "data_source").distinct()


def labor_observations(series: DataFrame) -> DataFrame:
    """Labor series, a row per period; only monthly periods have a date."""
    value = safe_cast(F.col("value"), "double")
    rows = series.where(value.isNotNull()).select(
        trimmed(F.col("seriesID")).alias("series_id"),
        period_date(F.col("year"), F.col("period")).alias("observation_date"),
        F.col("year").alias("obs_year"),
        F.col("period").alias("period_code"),
        trimmed(F.col("periodName")).alias("period_name"),
        value.alias("value"),
        (F.col("period") == "M13").alias("is_annual_average"),
        *[
            safe_cast(F.col(f"`calculations.{kind}_changes.{months}`"), "double")
            .alias(f"{kind}_change_{months}m")
            for kind in ("net", "pct") for months in (1, 12)
        ],
    )
    names = inline_mapping(series.sparkSession, LABOR_SERIES, ["series_id", "series_name"])
    named = lookup_or_self(rows, names, "series_id", "series_name")
    return named.select("series_id", "series_name", *[c for c in rows.columns if c != "series_id"])


def macro_indicators(wide: DataFrame) -> DataFrame:
    """Macro series from a column per series to a row per date and series."""
    series = [s for s, _ in MACRO_SERIES]
    # The date is read once per row here, not once per series behind the unpivot.
    dated = wide.where(F.col("date").isNotNull()).select(
        safe_date(F.col("date")).alias("observation_date"), *series)
    long = to_long(dated, ["observation_date"], series, "series_id", "value")
    names = inline_mapping(wide.sparkSession, MACRO_SERIES, ["series_id", "series_name"])
    day = F.col("observation_date")
    return lookup_or_self(long.where(F.col("value").isNotNull()), names, "series_id", "series_name").select(
        day,
        year_of(day).alias("obs_year"),
        month_of(day).alias("obs_month"),
        "series_id",
        "series_name",
        F.col("value").cast("double").alias("value"),
    )
