"""Marts G1–G8. Row order is a matter of export and is not stored."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from jobtide.fixed_values import DATA_SCIENCE, LINKEDIN, LINKEDIN_LARGE, LIVE
from jobtide.functions.dates import date_parts, month_start
from jobtide.functions.labels import gap_direction, is_trending, series_category
from jobtide.functions.numbers import count_where, gate, growth, round_to, rounded_int, safe_ratio
from jobtide.functions.text import norm, not_blank
from jobtide.operators.groups import (
    distinct_count, group_stats, having, monthly, most_common, qualified, top_names, value_ranks, with_percentiles,
)
from jobtide.operators.joins import (
    attach_metro, attach_ratings, attach_totals, compare_sets, join_null_safe, prefer_source,
)
from jobtide.operators.windows import top_k_per_group, with_prev, yoy

# How much data a published row needs.
MIN_SALARIES = 5
MIN_POSTINGS = 5
MIN_ROLE_POSTINGS = 10
MIN_ROLE_MENTIONS = 3
MIN_SKILL_TOTAL = 50
MIN_SKILL_MENTIONS = 5
ROLE_SKILLS = 20
ROLE_COMPANIES = 5

SALARY = "annual_salary_estimate"
QUARTILES = {"salary_p25": 0.25, "median_salary": 0.5, "salary_p75": 0.75}


def _matched() -> Column:
    return F.col("soc_match_type") == "exact_match"


def _volume() -> dict[str, Column]:
    """The counts every posting mart shows."""
    return {
        "total_postings": F.count(F.lit(1)),
        "unique_companies": F.countDistinct("company_name"),
        "postings_with_salary": F.count(SALARY),
        "avg_salary": F.avg(SALARY),
        "remote_postings": count_where(F.col("is_remote")),
    }


def _salary(name: str) -> Column:
    """Whole-dollar statistic, shown only with enough salaries behind it."""
    return gate(rounded_int(F.col(name)), F.col("postings_with_salary"), MIN_SALARIES).alias(name)


def _share(part: str, name: str) -> Column:
    return safe_ratio(F.col(part), F.col("total_postings"), 4).alias(name)


def market_snapshot(postings: DataFrame) -> DataFrame:
    """G1: one row per source: volume, time span, salaries, remote share, match rate."""
    keys = ["data_source", "is_snapshot"]
    volume = _volume()
    del volume["unique_companies"]
    stats = group_stats(
        postings, keys, **volume,
        earliest_posting=F.min("posted_at"),
        latest_posting=F.max("posted_at"),
        soc_matched_postings=count_where(_matched()),
    )
    for column, name in ((F.col("company_name"), "unique_companies"),
                         (month_start(F.col("posted_at")), "distinct_months")):
        counted = distinct_count(postings, keys, column, name)
        stats = join_null_safe(stats, counted, keys).withColumn(name, F.coalesce(name, F.lit(0)))
    return with_percentiles(stats, postings, keys, SALARY, QUARTILES).select(
        *keys, "total_postings", "unique_companies", "earliest_posting", "latest_posting",
        "distinct_months", "postings_with_salary", _salary("median_salary"), _salary("avg_salary"),
        _salary("salary_p25"), _salary("salary_p75"), "remote_postings",
        _share("remote_postings", "pct_remote"), "soc_matched_postings",
        _share("soc_matched_postings", "soc_match_rate"),
    )


_TREND_KEYS = ["report_month", "data_source"]


def trend_months(postings: DataFrame, least: int = 1) -> DataFrame:
    """Volume and salaries per month × source with ``least`` postings, for sources with a real time axis."""
    dated = postings.where(F.col("posted_at").isNotNull() & ~F.col("is_snapshot")).withColumn(
        "report_month", month_start(F.col("posted_at"))
    )
    stats = group_stats(dated, _TREND_KEYS, **_volume(), soc_matched_postings=count_where(_matched()))
    shown = having(stats, F.col("total_postings") >= least)
    return with_percentiles(shown, dated, _TREND_KEYS, SALARY, QUARTILES)


def compare_months(months: DataFrame) -> DataFrame:
    """The shown columns of :func:`trend_months` with the change on the month before.

    Months below the posting minimum are removed before the comparison, so a month compares
    with the last month that is shown.
    """
    complete = having(months, F.col("total_postings") >= MIN_POSTINGS)
    now, before = F.col("total_postings"), F.col("__before")
    compared = with_prev(complete, "data_source", "report_month", {"__before": "total_postings"})
    return compared.select(
        *_TREND_KEYS, "total_postings", "unique_companies", "postings_with_salary",
        _salary("median_salary"), _salary("avg_salary"), _salary("salary_p25"), _salary("salary_p75"),
        "remote_postings", _share("remote_postings", "pct_remote"),
        _share("soc_matched_postings", "soc_match_rate"),
        (now - before).alias("postings_mom_change"),
        growth(now, before, 4).alias("postings_mom_change_pct"),
        *date_parts(F.col("report_month"), month="month_num"),
    )


def market_trends(postings: DataFrame) -> DataFrame:
    """Month × source for sources with a real time axis, with change on the month before."""
    return compare_months(trend_months(postings, MIN_POSTINGS))


def economic_dashboard(labor: DataFrame, macro: DataFrame) -> DataFrame:
    """Month × series of both feeds with the change over twelve rows of the series.

    Where both feeds have a series and month, the labor feed wins.
    """
    keys = ["series_id", "series_name"]
    source = "source_system"
    from_labor = monthly(
        labor.where(~F.col("is_annual_average")), "observation_date", keys, "value", F.max
    ).withColumn(source, F.lit("bls"))
    from_macro = monthly(macro, "observation_date", keys, "value", F.avg).withColumn(
        source, F.lit("fred")
    )
    both = prefer_source(from_labor, from_macro, ["report_month", "series_id"])
    value, ago = F.col("value"), F.col("value_12m_ago")
    return yoy(both, "series_id", "report_month", "value").select(
        "report_month", *keys, source,
        series_category(F.col("series_name")).alias("category"),
        round_to(value, 4).alias("value"),
        round_to(ago, 4).alias("value_12m_ago"),
        round_to(value - ago, 4).alias("yoy_change"),
        growth(value, ago, 4).alias("yoy_change_pct"),
        *date_parts(F.col("report_month")),
    )


def role_analysis(postings: DataFrame, occupations: DataFrame, education: DataFrame,
                  as_of: dt.date) -> DataFrame:
    """One row per occupation with enough postings: volume, pay, habits, top employers."""
    keys = ["onet_soc_code", "soc_code"]
    matched = postings.where(_matched() & F.col("onet_soc_code").isNotNull())

    def since(days: int) -> Column:
        start = F.lit(as_of - dt.timedelta(days=days)).cast("timestamp_ntz")
        return count_where(F.col("posted_at") >= start)

    def from_source(name: str) -> Column:
        return count_where(F.col("data_source") == name)

    stats = group_stats(
        matched, keys, **_volume(),
        postings_last_30d=since(30),
        postings_last_90d=since(90),
        adzuna_postings=from_source(LIVE),
        linkedin_postings=from_source(LINKEDIN),
        linkedin_large_postings=from_source(LINKEDIN_LARGE),
        ds_postings=from_source(DATA_SCIENCE),
    )
    shown = having(stats, F.col("total_postings") >= MIN_ROLE_POSTINGS)
    complete = with_percentiles(shown, matched, keys, SALARY, QUARTILES)

    habits = value_ranks(
        matched, "onet_soc_code", ["experience_level", "work_type", "company_name"], ROLE_COMPANIES
    ).groupBy("onet_soc_code").agg(
        most_common("experience_level").alias("most_common_experience_level"),
        most_common("work_type").alias("most_common_work_type"),
        top_names("company_name", ROLE_COMPANIES).alias("top_hiring_companies"),
    )
    return (
        complete.join(occupations, "onet_soc_code", "inner")
        .join(education, "onet_soc_code", "left")
        .join(habits, "onet_soc_code", "left")
        .select(
            *keys, "occupation_title", "occupation_description", "job_zone", "total_postings",
            "postings_last_30d", "postings_last_90d", "unique_companies", "postings_with_salary",
            _salary("salary_p25"), _salary("median_salary"), _salary("salary_p75"),
            "remote_postings", _share("remote_postings", "pct_remote"),
            "most_common_experience_level", "most_common_work_type", "top_hiring_companies",
            "pct_bachelors_degree", "pct_masters_degree", "pct_doctoral_degree",
            "adzuna_postings", "linkedin_postings", "linkedin_large_postings", "ds_postings",
        )
    )


def posting_counts(postings: DataFrame) -> DataFrame:
    """Postings per (posting, source, occupation, month), counted map-side as ``n``.

    A posting that is repeated very often is a few rows here, whatever joins on it.
    """
    useful = postings.select(
        "posting_id",
        "data_source",
        F.when(_matched(), F.col("onet_soc_code")).alias("onet_soc_code"),
        month_start(F.col("posted_at")).alias("report_month"),
    ).where(F.col("onet_soc_code").isNotNull() | F.col("report_month").isNotNull())
    return useful.groupBy(*useful.columns).agg(F.count(F.lit(1)).alias("n"))


def skill_mentions(skills: DataFrame, counts: DataFrame) -> DataFrame:
    """Skill mentions with the occupation and month of their posting, from :func:`posting_counts`.

    Tables that are stored in buckets of (posting_id, data_source) meet here without a shuffle.
    """
    named = skills.where(F.length("skill_name") >= 2).select("posting_id", "skill_name", "data_source")
    return named.join(counts, ["posting_id", "data_source"], "inner").select(
        "posting_id", "skill_name", "onet_soc_code", "report_month", "n"
    )


def posting_skill_joined(skills: DataFrame, postings: DataFrame) -> DataFrame:
    """Skill mentions with the occupation and month of their posting, for the three skill marts.

    Repeated postings reach the join as one row with a count ``n`` and do not multiply the mentions.
    """
    return skill_mentions(skills, posting_counts(postings))


def qualified_roles(postings: DataFrame) -> DataFrame:
    """Occupations with enough distinct postings, for the two occupation skill marts."""
    matched = postings.where(_matched() & F.col("onet_soc_code").isNotNull())
    return qualified(
        matched, "onet_soc_code", "posting_id", MIN_ROLE_POSTINGS, "total_postings_for_soc"
    )


def role_mentions(joined: DataFrame) -> DataFrame:
    """Distinct postings per occupation and skill, for the two occupation skill marts."""
    return group_stats(
        joined.where(F.col("onet_soc_code").isNotNull()), ["onet_soc_code", "skill_name"],
        mention_count=F.countDistinct("posting_id"),
    )


def role_top_skills(mentions: DataFrame, roles: DataFrame, occupations: DataFrame,
                    ratings: DataFrame) -> DataFrame:
    """The most mentioned skills per occupation; equal counts rank by name."""
    shown = having(mentions, F.col("mention_count") >= MIN_ROLE_MENTIONS)
    counted = shown.join(roles, "onet_soc_code", "inner")
    best = top_k_per_group(
        counted, "onet_soc_code", [F.col("mention_count").desc(), F.col("skill_name").asc()],
        ROLE_SKILLS, rank="skill_rank",
    )
    titled = best.join(occupations.select("onet_soc_code", "occupation_title"), "onet_soc_code", "inner")
    rated = attach_ratings(
        titled, ratings.select("onet_soc_code", "skill_name", "importance_value", "level_value"),
        "onet_soc_code", "skill_name",
    )
    return rated.select(
        "onet_soc_code", "occupation_title", "skill_name", "skill_rank", "mention_count",
        "total_postings_for_soc",
        safe_ratio(F.col("mention_count"), F.col("total_postings_for_soc"), 4).alias("pct_of_postings"),
        F.col("importance_value").alias("onet_importance_value"),
        F.col("level_value").alias("onet_level_value"),
    )


def skills_demand(joined: DataFrame, postings: DataFrame) -> DataFrame:
    """Skill × month for skills with enough mentions in total, with change and trend flag.

    The monthly minimum applies after the comparison: a small month is not shown but is still
    the month its successor compares with.
    """
    mentions = group_stats(
        joined.where(F.col("report_month").isNotNull()), ["skill_name", "report_month"],
        mention_count=F.sum("n"), distinct_postings=F.countDistinct("posting_id"),
    )
    # The total and the comparison share one partitioning by skill; a skill has a row per month.
    in_total = F.sum("mention_count").over(Window.partitionBy("skill_name"))
    compared = with_prev(
        mentions.withColumn("__total", in_total), "skill_name", "report_month",
        {"prev_month_mentions": "mention_count"},
    )
    shown = compared.where(
        (F.col("__total") >= MIN_SKILL_TOTAL) & (F.col("mention_count") >= MIN_SKILL_MENTIONS)
    )
    months = group_stats(
        postings.where(F.col("posted_at").isNotNull())
        .select(month_start(F.col("posted_at")).alias("report_month"), "posting_id"),
        "report_month", total_postings_that_month=F.countDistinct("posting_id"),
    )
    now, before = F.col("mention_count"), F.col("prev_month_mentions")
    return attach_totals(shown, months, "report_month").select(
        "skill_name", "report_month", "mention_count", "distinct_postings",
        "total_postings_that_month",
        safe_ratio(F.col("distinct_postings"), F.col("total_postings_that_month"), 6)
        .alias("pct_of_postings"),
        "prev_month_mentions",
        growth(now, before, 4).alias("mom_change_pct"),
        is_trending(now, before).alias("is_trending"),
        *date_parts(F.col("report_month"), quarter=None, month="month_num"),
    )


def metro_comparison(postings: DataFrame, bridge: DataFrame, metros: DataFrame) -> DataFrame:
    """State × metro (or state without one): volume and pay against local living conditions."""
    keys = ["state", "cbsa_fips"]
    placed = attach_metro(postings.where(not_blank(F.col("state"))), bridge).withColumn(
        "state", norm(F.col("state"))
    )
    live = F.col("data_source") == LIVE
    stats = group_stats(
        placed, keys, **_volume(),
        adzuna_postings=count_where(live), other_source_postings=count_where(~live),
    )
    shown = having(stats, F.col("total_postings") >= MIN_POSTINGS)
    complete = with_percentiles(shown, placed, keys, SALARY, QUARTILES)
    income = F.col("median_household_income")
    ratio = F.when(income > 0, round_to(F.col("median_salary") / income, 2))
    return complete.join(metros, "cbsa_fips", "left").select(
        "state", "total_postings", "unique_companies", "postings_with_salary",
        _salary("median_salary"), _salary("avg_salary"), _salary("salary_p25"), _salary("salary_p75"),
        "remote_postings", _share("remote_postings", "pct_remote"), "adzuna_postings",
        "other_source_postings", "cbsa_fips", "metro_name", "median_household_income",
        gate(ratio, F.col("postings_with_salary"), MIN_SALARIES).alias("salary_to_income_ratio"),
        "pct_bachelors_or_higher", "pct_work_from_home", "pct_information_industry",
        "pct_mgmt_business_science_arts", "pct_professional_scientific_management_admin_waste",
        "pct_broadband", F.col("unemployment_rate").alias("acs_unemployment_rate"),
        "mean_commute_minutes",
    )


def occupation_skills_profile(mentions: DataFrame, roles: DataFrame, technology: DataFrame,
                              occupations: DataFrame) -> DataFrame:
    """Catalogued tools against demanded skills per occupation.

    A tool listed twice for an occupation gives two rows. Skills only the market knows need a
    minimum of mentions.
    """
    catalogue = technology.select(
        "onet_soc_code",
        norm(F.col("technology_name")).alias("skill_name"),
        F.col("is_hot_technology").alias("onet_is_hot_technology"),
        F.col("is_in_demand").alias("onet_is_in_demand"),
        F.col("commodity_title").alias("onet_commodity_title"),
    ).join(roles.select("onet_soc_code"), "onet_soc_code", "left_semi")
    demand = mentions.withColumnRenamed("mention_count", "posting_mention_count").join(
        roles.select("onet_soc_code"), "onet_soc_code", "left_semi"
    )
    both = compare_sets(
        catalogue, demand, ["onet_soc_code", "skill_name"], "in_onet", "in_market"
    ).withColumn("posting_mention_count", F.coalesce("posting_mention_count", F.lit(0)))
    gap = gap_direction(F.col("in_onet"), F.col("in_market"))
    mentioned = F.col("posting_mention_count")
    strong = both.withColumn("gap_direction", gap).where(
        (F.col("gap_direction") != "market_only") | (mentioned >= MIN_ROLE_MENTIONS)
    )
    return (
        strong.join(roles, "onet_soc_code", "inner")
        .join(occupations.select("onet_soc_code", "occupation_title"), "onet_soc_code", "inner")
        .select(
            "onet_soc_code", "occupation_title", "skill_name", "in_onet", "in_market",
            "onet_is_hot_technology", "onet_is_in_demand", "onet_commodity_title",
            "posting_mention_count", "total_postings_for_soc",
            safe_ratio(mentioned, F.col("total_postings_for_soc"), 4).alias("posting_pct_of_postings"),
            "gap_direction",
        )
    )
