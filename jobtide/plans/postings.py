"""Title lookup and enriched postings I1–I5: one table per feed, cleaned to common columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.fixed_values import DATA_SCIENCE, LINKEDIN, LINKEDIN_LARGE
from jobtide.functions.dates import from_epoch_ms, safe_date
from jobtide.functions.labels import location_match
from jobtide.functions.numbers import rounded_int
from jobtide.functions.salary import best_estimate, correct_period, credible, in_dollars
from jobtide.functions.text import norm, not_blank, place_part, soc_code, trimmed
from jobtide.operators.groups import agg_distinct_list
from jobtide.operators.joins import geo_match, left_chain, resolve_codes
from jobtide.operators.reshape import union_sources
from jobtide.operators.windows import first_by_priority, latest_first, latest_per_key

SHORTEST_TITLE = 3


def title_to_soc(alternate_titles: DataFrame, occupations: DataFrame) -> DataFrame:
    """Each known title once with its occupation; an official title beats an alternate one."""

    def titles(df: DataFrame, title: str, short: str, source: str) -> DataFrame:
        code = F.col("`O*NET-SOC Code`")
        return df.where(not_blank(F.col(title))).select(
            code.alias("onet_soc_code"),
            soc_code(code).alias("soc_code"),
            norm(F.col(title)).alias("title_lower"),
            norm(F.col(short)).alias("short_title_lower"),
            F.lit(source).alias("title_source"),
        )

    both = union_sources(
        titles(alternate_titles, "Alternate Title", "Short Title", "alternate_title"),
        titles(occupations, "Title", "Title", "occupation_title"),
    ).where(F.length("title_lower") >= SHORTEST_TITLE)
    official_first = F.when(F.col("title_source") == "occupation_title", 0).otherwise(1)
    return first_by_priority(
        both, "title_lower", official_first, ["onet_soc_code", "short_title_lower"]
    )


def linkedin_salaries(salaries: DataFrame) -> DataFrame:
    """Credible annual dollar estimates, one row per salary row that has one."""
    observed = F.coalesce("med_salary", "max_salary", "min_salary")
    estimate = best_estimate(
        F.col("min_salary"), F.col("med_salary"), F.col("max_salary"),
        correct_period(observed, F.col("pay_period")),
    )
    # As a filter the long estimate would be evaluated several times per row, in code too large
    # for the JIT compiler; inside the array it is evaluated once.
    kept = F.explode(F.filter(F.array(estimate), credible)).alias("estimate")
    dollars = salaries.where(in_dollars(F.col("currency")))
    return dollars.select("job_id", kept).select(
        "job_id", rounded_int(F.col("estimate")).alias("annual_salary_estimate"))


def linkedin_enriched(postings: DataFrame, salaries: DataFrame, job_skills: DataFrame,
                      mapping_skills: DataFrame) -> DataFrame:
    """Postings with stated pay and coded skills. A job with several salary rows gives several rows."""
    named = resolve_codes(
        job_skills, mapping_skills.select("skill_abr", norm(F.col("skill_name")).alias("skill_name")),
        "skill_abr", "skill_name",
    )
    skills = agg_distinct_list(named, "job_id", F.col("skill_name"), "skills_array")
    # Cleaned before the joins: once per job, however many salary rows it has.
    jobs = postings.select(
        "job_id",
        F.col("job_id").cast("string").alias("posting_id"),
        norm(F.col("title")).alias("job_title"),
        trimmed(F.col("description")).alias("description"),
        norm(F.col("location")).alias("location"),
        norm(F.col("company_name")).alias("company_name"),
        F.col("company_id").cast("bigint").alias("company_id"),
        norm(F.col("formatted_work_type")).alias("work_type"),
        norm(F.col("formatted_experience_level")).alias("experience_level"),
        from_epoch_ms(F.col("listed_time")).alias("posted_at"),
        F.col("remote_allowed").cast("boolean").alias("is_remote"),
        F.col("views").cast("int").alias("view_count"),
        F.col("applies").cast("int").alias("apply_count"),
    )
    joined = left_chain(jobs, linkedin_salaries(salaries), skills, on="job_id")
    return joined.select(*jobs.columns[1:], "annual_salary_estimate", "skills_array", F.lit(LINKEDIN).alias("data_source"))


def _listings(postings: DataFrame) -> DataFrame:
    return postings.where(not_blank(F.col("job_title"))).select(
        trimmed(F.col("job_link")).alias("posting_id"),
        norm(F.col("job_title")).alias("job_title"),
        norm(F.col("company")).alias("company_name"),
        norm(F.col("job_location")).alias("location"),
        norm(F.col("job_level")).alias("experience_level"),
        norm(F.col("job_type")).alias("work_type"),
        norm(F.col("search_position")).alias("search_role"),
        safe_date(F.col("first_seen")).alias("posted_at"),
    )


def _texts(df: DataFrame, column: str, text, name: str) -> DataFrame:
    return df.where(not_blank(F.col(column))).select(
        trimmed(F.col("job_link")).alias("posting_id"), text(F.col(column)).alias(name)
    )


_LISTING_COLUMNS = [
    "posting_id", "job_title", "company_name", "location", "experience_level", "work_type",
    "search_role", "posted_at", "skills_raw", "annual_salary_estimate", "description", "data_source",
]


def large_enriched(postings: DataFrame, job_skills: DataFrame) -> DataFrame:
    """The large listing snapshot with its skill text; it has neither pay nor descriptions."""
    joined = left_chain(
        _listings(postings), _texts(job_skills, "job_skills", norm, "skills_raw"), on="posting_id"
    )
    return joined.withColumns({
        "annual_salary_estimate": F.lit(None).cast("int"),
        "description": F.lit(None).cast("string"),
        "data_source": F.lit(LINKEDIN_LARGE),
    }).select(*_LISTING_COLUMNS)


def ds_enriched(postings: DataFrame, job_skills: DataFrame, summary: DataFrame) -> DataFrame:
    """The data-science snapshot with skill text and summary."""
    joined = left_chain(
        _listings(postings),
        _texts(job_skills, "job_skills", norm, "skills_raw"),
        _texts(summary, "job_summary", trimmed, "description"),
        on="posting_id",
    )
    return joined.withColumns({
        "annual_salary_estimate": F.lit(None).cast("int"),
        "data_source": F.lit(DATA_SCIENCE),
    }).select(*_LISTING_COLUMNS)


def newest_first() -> list[Column]:
    """Which of the landed rows of one id :func:`live_enriched` takes."""
    created = F.col("created").try_cast("timestamp_ntz").desc_nulls_last()
    return [created, *latest_first(
        "title", "`location.display_name`", "`company.display_name`", "description", "salary_max", "salary_min",
        "contract_time", "`category.label`", "latitude", "longitude")]


def live_enriched(postings: DataFrame, places: DataFrame, one_match: bool = False) -> DataFrame:
    """Live postings, each id once (the latest), with the location resolved.

    A city and county that occur in several states give a row per state, see ``geo_match``.
    """
    raw = F.col("`location.display_name`")
    read = postings.select(
        F.col("id").cast("string").alias("posting_id"),
        "title", "description", "contract_time", "salary_min", "salary_max", "latitude", "longitude",
        F.col("`company.display_name`").alias("company"),
        F.col("`category.label`").alias("category_label"),
        F.col("created").try_cast("timestamp_ntz").alias("created"),
        raw.alias("raw_location"),
        place_part(raw, 0).alias("part_1"),
        place_part(raw, 1).alias("part_2"),
    )
    once = latest_per_key(read, "posting_id", latest_first(
        "created", "title", "raw_location", "company", "description", "salary_max", "salary_min",
        "contract_time", "category_label", "latitude", "longitude"))
    placed = geo_match(once, places, "part_1", "part_2", one_match)

    resolved = F.lower(F.col("raw_location")) != "us"
    known = F.coalesce(resolved, F.lit(True))
    second = F.col("part_2")
    city = F.coalesce("city_by_state", "city_by_county", "part_1")
    county = F.coalesce(
        "county_by_county", "county_by_state", F.when(F.lower(second).contains("county"), second)
    )
    state = F.coalesce("state_by_state", "state_by_county")
    return placed.select(
        "posting_id",
        norm(F.col("title")).alias("job_title"),
        trimmed(F.col("description")).alias("description"),
        norm(F.col("contract_time")).alias("work_type"),
        norm(F.col("company")).alias("company"),
        norm(F.col("category_label")).alias("category_label"),
        rounded_int(F.col("salary_max")).alias("salary_max"),
        rounded_int((F.col("salary_min") + F.col("salary_max")) / 2.0).alias("salary_mid"),
        rounded_int(F.col("salary_min")).alias("salary_min"),
        norm(F.when(known, county)).alias("county"),
        norm(F.when(known, city)).alias("city"),
        norm(F.when(known, state)).alias("state"),
        norm(F.col("raw_location")).alias("location"),
        location_match(F.col("raw_location"), F.col("city_by_state"), F.col("city_by_county"), second)
        .alias("location_match_type"),
        "latitude",
        "longitude",
        "created",
    )
