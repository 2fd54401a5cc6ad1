"""Report queries R1–R20 over the marts. Sorting here is the report's own order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.fixed_values import COVERAGE_LABELS, LINKEDIN, LIVE
from jobtide.functions.labels import suspect_skill
from jobtide.functions.numbers import count_where, round_to
from jobtide.functions.text import soc_prefix
from jobtide.operators.groups import group_stats, row_counts
from jobtide.operators.joins import for_top_groups
from jobtide.operators.reshape import coverage_long
from jobtide.operators.windows import top_k


def down(column: str) -> Column:
    return F.col(column).desc_nulls_last()


def up(column: str) -> Column:
    return F.col(column).asc_nulls_last()


def snapshot_by_volume(snapshot: DataFrame) -> DataFrame:
    """R1"""
    return snapshot.orderBy(down("total_postings"), up("data_source"))


def trends_by_source(trends: DataFrame) -> DataFrame:
    """R2"""
    return trends.orderBy(up("data_source"), up("report_month"))


def series_summary(economic: DataFrame) -> DataFrame:
    """Span and range of every series."""
    summary = group_stats(
        economic, ["category", "series_name", "source_system"],
        months=F.count(F.lit(1)),
        earliest=F.min("report_month"),
        latest=F.max("report_month"),
        min_val=round_to(F.min("value"), 2),
        avg_val=round_to(F.avg("value"), 2),
        max_val=round_to(F.max("value"), 2),
    )
    return summary.orderBy(up("category"), up("series_name"), up("source_system"))


def role_table(roles: DataFrame) -> DataFrame:
    """R4"""
    return roles.select(
        "onet_soc_code", "occupation_title", "job_zone", "total_postings", "postings_last_30d",
        "postings_with_salary", "median_salary", "salary_p25", "salary_p75", "pct_remote",
        "most_common_experience_level", "most_common_work_type", "pct_bachelors_degree",
        "pct_masters_degree",
    ).orderBy(down("total_postings"), up("onet_soc_code"))


def leading_role_skills(role_skills: DataFrame, roles: DataFrame, largest: int = 20,
                        per_role: int = 5) -> DataFrame:
    """First skills of the largest roles."""
    first = role_skills.where(F.col("skill_rank") <= per_role)
    order = [down("total_postings"), up("onet_soc_code")]
    return for_top_groups(first, roles, "onet_soc_code", order, largest).select(
        "occupation_title", "skill_name", "skill_rank", "mention_count",
        round_to(F.col("pct_of_postings"), 4).alias("pct_of_postings"),
        "onet_importance_value", "onet_level_value",
    ).orderBy(up("occupation_title"), up("skill_rank"))


def leading_skills(demand: DataFrame, k: int = 30) -> DataFrame:
    """Skills by total mentions, with the number of trending months."""
    totals = group_stats(
        demand, "skill_name",
        total_mentions=F.sum("mention_count"),
        total_distinct_postings=F.sum("distinct_postings"),
        months_active=F.countDistinct("report_month"),
        avg_pct=round_to(F.avg("pct_of_postings"), 4),
        months_trending=count_where(F.col("is_trending")),
    )
    return top_k(totals, [down("total_mentions"), up("skill_name")], k)


def suspected_non_skills(demand: DataFrame) -> DataFrame:
    """R7"""
    suspects = demand.where(suspect_skill(F.col("skill_name")))
    totals = group_stats(suspects, "skill_name", total_mentions=F.sum("mention_count"))
    return totals.orderBy(down("total_mentions"), up("skill_name"))


def metro_table(metros: DataFrame) -> DataFrame:
    """R8"""
    return metros.select(
        "state", "total_postings", "median_salary", "salary_to_income_ratio", "pct_remote",
        "cbsa_fips", "metro_name", "median_household_income", "pct_bachelors_or_higher",
        "pct_work_from_home", "pct_information_industry",
    ).orderBy(down("total_postings"), up("state"), up("cbsa_fips"))


def gap_summary(profile: DataFrame) -> DataFrame:
    """R9"""
    summary = group_stats(
        profile, "gap_direction",
        entries=F.count(F.lit(1)),
        occupations=F.countDistinct("onet_soc_code"),
        unique_skills=F.countDistinct("skill_name"),
        avg_mentions=round_to(F.avg("posting_mention_count"), 1),
        avg_pct=round_to(F.avg("posting_pct_of_postings"), 4),
    )
    return summary.orderBy(down("entries"), up("gap_direction"))


def emerging_skills(profile: DataFrame, k: int = 20) -> DataFrame:
    """Strongest skills only the market knows, per occupation."""
    news = profile.where(F.col("gap_direction") == "market_only").select(
        "occupation_title", "skill_name", "posting_mention_count",
        round_to(F.col("posting_pct_of_postings"), 4).alias("pct"),
    )
    return top_k(news, [down("posting_mention_count"), up("occupation_title"), up("skill_name")], k)


def mart_row_counts(marts: dict[str, DataFrame]) -> DataFrame:
    """R11"""
    return row_counts(marts).orderBy("model")


def key_figures(snapshot: DataFrame) -> DataFrame:
    """Totals over all sources and the pay of the two sources that state it."""

    def of(source: str, column: str) -> Column:
        return F.max(F.when(F.col("data_source") == source, F.col(column)))

    return snapshot.agg(
        F.sum("total_postings").alias("total_postings"),
        F.sum("unique_companies").alias("unique_companies"),
        of(LIVE, "median_salary").alias("live_median_salary"),
        of(LIVE, "postings_with_salary").alias("live_postings_with_salary"),
        of(LINKEDIN, "median_salary").alias("linkedin_median_salary"),
        of(LINKEDIN, "postings_with_salary").alias("linkedin_postings_with_salary"),
    )


def coverage_by_source(snapshot: DataFrame) -> DataFrame:
    """R13"""
    return coverage_long(snapshot, ["data_source"], COVERAGE_LABELS)


def occupation_group(roles: DataFrame, prefix: str | None = None) -> DataFrame:
    """Figures of one major occupation group, or of all. One row per occupation goes in."""
    members = roles if prefix is None else roles.where(soc_prefix(F.col("onet_soc_code")) == prefix)
    return members.agg(
        F.count(F.lit(1)).alias("occupations"),
        F.sum("total_postings").alias("total_postings"),
        F.median("median_salary").alias("median_of_medians"),
        round_to(F.avg("pct_remote"), 4).alias("avg_pct_remote"),
    )


def most_mentioned_skills(demand: DataFrame, k: int = 20) -> DataFrame:
    """R15"""
    totals = group_stats(
        demand, "skill_name",
        total_mentions=F.sum("mention_count"),
        total_distinct=F.sum("distinct_postings"),
        months_active=F.countDistinct("report_month"),
    )
    return top_k(totals, [down("total_mentions"), up("skill_name")], k)


def gap_counts(profile: DataFrame) -> DataFrame:
    """R16"""
    return group_stats(profile, "gap_direction", count=F.count(F.lit(1))).orderBy(
        down("count"), up("gap_direction"))


def emerging_tools(profile: DataFrame, prefix: str = "15", k: int = 15) -> DataFrame:
    """Market-only skills of one occupation group by mentions over its occupations."""
    news = profile.where(
        (F.col("gap_direction") == "market_only") & F.col("onet_soc_code").startswith(prefix)
    )
    totals = group_stats(news, "skill_name", posting_mention_count=F.sum("posting_mention_count"))
    return top_k(totals, [down("posting_mention_count"), up("skill_name")], k)


def gap_detail(profile: DataFrame, gap: str, occupation: str, k: int = 30) -> DataFrame:
    """One kind of gap of one occupation."""
    rows = profile.where((F.col("gap_direction") == gap) & (F.col("occupation_title") == occupation))
    order = ["skill_name", "onet_commodity_title", "onet_is_hot_technology"]
    first = top_k(rows, [down("posting_mention_count"), *[up(c) for c in order]], k)
    return first.select(
        "skill_name", "posting_mention_count", "posting_pct_of_postings", "onet_is_hot_technology",
        "onet_is_in_demand",
    )


def salary_against_income(metros: DataFrame) -> DataFrame:
    """Matched metros with both a salary and an income."""
    return metros.where(F.col("cbsa_fips").isNotNull()).dropna(
        subset=["median_salary", "median_household_income"]
    ).select(
        "state", "metro_name", "total_postings", "median_salary", "median_household_income",
        "salary_to_income_ratio",
    )


def category_series(economic: DataFrame, category: str) -> DataFrame:
    """All series of a category over time."""
    return economic.where(F.col("category") == category).select(
        "series_name", "report_month", "value"
    ).orderBy(up("series_name"), up("report_month"))


def diagnostics(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """R1–R11 over the built tables, by the name of the file each one is exported to."""
    marts = {name: df for name, df in tables.items() if name.startswith("gold_")}
    economic, roles = marts["gold_economic_dashboard"], marts["gold_role_analysis"]
    demand, profile = marts["gold_skills_demand"], marts["gold_occupation_skills_profile"]
    return {
        "00_row_counts": mart_row_counts(marts),
        "01_market_snapshot": snapshot_by_volume(marts["gold_market_snapshot"]),
        "02_market_trends": trends_by_source(marts["gold_market_trends"]),
        "03_economic_summary": series_summary(economic),
        "04_role_analysis": role_table(roles),
        "05_role_top_skills": leading_role_skills(marts["gold_role_top_skills"], roles),
        "06_skills_demand_top30": leading_skills(demand),
        "07_skills_quality_check": suspected_non_skills(demand),
        "08_metro_comparison": metro_table(marts["gold_metro_comparison"]),
        "09_skills_gap_summary": gap_summary(profile),
        "10_emerging_market_only_skills": emerging_skills(profile),
    }
