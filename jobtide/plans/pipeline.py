"""The whole run: raw files to silver, gold, checks and exports.

Every table is written once and read back, so later tables scan parquet with pushed filters and
pruned columns instead of recomputing, and a lost executor costs no more than its own stage.
"""

from __future__ import annotations

import argparse
import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from jobtide.plans import dimensions, facts, marts, postings, quality, reports
from jobtide.plans.refresh import ddl, merged_rows, scan
from jobtide.session import build_session
from jobtide.sources.catalog import BRONZE
from jobtide.sources.landing import (
    land_api_payloads, land_csv_files, land_occupation_files,
)
from jobtide.sources.readers import bronze, built_in_seeds, read_seed
from jobtide.sources.writers import export_csv, save

Tables = dict[str, DataFrame]

MARTS = [
    "gold_market_snapshot", "gold_market_trends", "gold_economic_dashboard", "gold_role_analysis",
    "gold_role_top_skills", "gold_skills_demand", "gold_metro_comparison",
    "gold_occupation_skills_profile",
]

# Facts are filtered by source, so their files are split by it.
_SPLIT = {"fct_job_postings": ["data_source"], "fct_posting_skills": ["data_source"]}


def silver_dimensions(spark: SparkSession, raw: Tables, as_of: dt.date) -> Tables:
    return {
        "dim_occupations": dimensions.dim_occupations(
            raw["stg_onet__occupations"], raw["stg_onet__job_zones"]),
        "dim_skills": dimensions.dim_ratings(raw["stg_onet__skills"]),
        "dim_knowledge": dimensions.dim_ratings(raw["stg_onet__knowledge"]),
        "dim_work_activities": dimensions.dim_ratings(raw["stg_onet__work_activities"]),
        "dim_technology_skills": dimensions.dim_technology_skills(raw["stg_onet__technology_skills"]),
        "dim_education_requirements": dimensions.dim_education_requirements(
            raw["stg_onet__education_training_experience"], raw["stg_onet__ete_categories"]),
        "dim_metros": dimensions.dim_metros(raw["stg_acs__metro_profiles"]),
        "dim_companies": dimensions.dim_companies(
            raw["stg_kaggle_linkedin__companies"], raw["stg_kaggle_linkedin__company_industries"],
            raw["stg_kaggle_linkedin__company_specialties"],
            raw["stg_kaggle_linkedin__employee_counts"]),
        "dim_date_spine": dimensions.dim_date_spine(spark, as_of),
    }


def silver_postings(raw: Tables, seeds: Tables) -> Tables:
    return {
        "int_title_to_soc_mapping": postings.title_to_soc(
            raw["stg_onet__alternate_titles"], raw["stg_onet__occupations"]),
        "int_kaggle_linkedin__postings_enriched": postings.linkedin_enriched(
            raw["stg_kaggle_linkedin__postings"], raw["stg_kaggle_linkedin__salaries"],
            raw["stg_kaggle_linkedin__job_skills"], raw["stg_kaggle_linkedin__mapping_skills"]),
        "int_kaggle_large__postings_enriched": postings.large_enriched(
            raw["stg_kaggle_linkedin_large__postings"], raw["stg_kaggle_linkedin_large__job_skills"]),
        "int_kaggle_ds__postings_enriched": postings.ds_enriched(
            raw["stg_kaggle_ds__postings"], raw["stg_kaggle_ds__job_skills"],
            raw["stg_kaggle_ds__summary"]),
        "int_adzuna__postings_enriched": postings.live_enriched(
            raw["stg_adzuna__postings"], seeds["us_cities_states_counties"]),
    }


def silver_facts(raw: Tables, seeds: Tables, silver: Tables) -> Tables:
    return {
        "fct_job_postings": facts.job_postings(
            silver["int_kaggle_linkedin__postings_enriched"],
            silver["int_kaggle_large__postings_enriched"],
            silver["int_kaggle_ds__postings_enriched"],
            silver["int_adzuna__postings_enriched"],
            silver["int_title_to_soc_mapping"]),
        "fct_posting_skills": facts.posting_skills(
            raw["stg_kaggle_linkedin__job_skills"], raw["stg_kaggle_linkedin__mapping_skills"],
            raw["stg_kaggle_linkedin_large__job_skills"], raw["stg_kaggle_ds__job_skills"],
            seeds["skill_name_normalization"]),
        "fct_bls_observations": facts.labor_observations(raw["stg_bls__series"]),
        "fct_fred_indicators": facts.macro_indicators(raw["stg_fred__series"]),
    }


def shared_joins(silver: Tables) -> Tables:
    """What several marts need, computed once."""
    return {
        "posting_skill_joined": marts.posting_skill_joined(
            silver["fct_posting_skills"], silver["fct_job_postings"]),
        "qualified_roles": marts.qualified_roles(silver["fct_job_postings"]),
    }


def shared_counts(silver: Tables) -> Tables:
    """What the two occupation skill marts count, computed once: the largest shuffle of a run."""
    return {"role_mentions": marts.role_mentions(silver["posting_skill_joined"])}


def gold_marts(silver: Tables, seeds: Tables, as_of: dt.date) -> Tables:
    mentions = silver["role_mentions"]
    jobs, joined = silver["fct_job_postings"], silver["posting_skill_joined"]
    roles, occupations = silver["qualified_roles"], silver["dim_occupations"]
    return {
        "gold_market_snapshot": marts.market_snapshot(jobs),
        "gold_market_trends": marts.market_trends(jobs),
        "gold_economic_dashboard": marts.economic_dashboard(
            silver["fct_bls_observations"], silver["fct_fred_indicators"]),
        "gold_role_analysis": marts.role_analysis(
            jobs, occupations, silver["dim_education_requirements"], as_of),
        "gold_role_top_skills": marts.role_top_skills(
            mentions, roles, occupations, silver["dim_skills"]),
        "gold_skills_demand": marts.skills_demand(joined, jobs),
        "gold_metro_comparison": marts.metro_comparison(
            jobs, seeds["state_to_cbsa_bridge"], silver["dim_metros"]),
        "gold_occupation_skills_profile": marts.occupation_skills_profile(
            mentions, roles, silver["dim_technology_skills"], occupations),
    }


def export_orders() -> dict[str, list]:
    up, down = reports.up, reports.down
    return {
        "gold_market_snapshot": [down("total_postings"), up("data_source")],
        "gold_market_trends": [up("data_source"), up("report_month")],
        "gold_economic_dashboard": [up("series_name"), up("report_month")],
        "gold_role_analysis": [down("total_postings"), up("onet_soc_code")],
        "gold_role_top_skills": [up("onet_soc_code"), up("skill_rank")],
        "gold_skills_demand": [up("skill_name"), up("report_month")],
        "gold_metro_comparison": [down("total_postings"), up("state"), up("cbsa_fips")],
        "gold_occupation_skills_profile": [
            up("onet_soc_code"), down("posting_mention_count"), up("skill_name")],
    }


def live_postings(spark: SparkSession, raw_root: str) -> DataFrame | None:
    """The newest landed row of each live posting, and files that were put there by hand; None before any landing."""
    schema = BRONZE["stg_adzuna__postings"].schema
    kept = merged_rows(spark, f"{raw_root}/adzuna/latest", schema)
    by_hand = scan(spark, f"{raw_root}/adzuna/adzuna_*.parquet", ddl(schema))
    return kept if kept is None or by_hand is None else kept.unionByName(by_hand)


def run(spark: SparkSession, raw_root: str, out: str, as_of: dt.date | None = None,
        export: bool = False, side_by_side: int = 4) -> Tables:
    """Build and write all tables; returns scans of them plus ``quality_report``.

    Tables of one step do not need each other and are written a few at a time.
    """
    as_of = as_of or dt.date.today()
    raw = bronze(spark, raw_root)
    newest = live_postings(spark, raw_root)
    if newest is not None:  # the history has been looked through when its batches landed
        raw["stg_adzuna__postings"] = newest
    seeds = {
        **built_in_seeds(spark),
        "us_cities_states_counties": read_seed(spark, f"{raw_root}/seeds", "us_cities_states_counties"),
    }
    done: Tables = {}
    metrics: dict = {}

    def write(layer: str, tables: Tables) -> None:
        checked = {}
        for name, df in tables.items():
            checked[name], found = quality.observed(df, quality.TABLE_CHECKS.get(name, quality.Checks()))
            if name in quality.TABLE_CHECKS:
                metrics[name] = found
        with ThreadPoolExecutor(side_by_side) as pool:
            jobs = {name: pool.submit(save, df, out, layer, name, _SPLIT.get(name, ()))
                    for name, df in checked.items()}
        done.update({name: job.result() for name, job in jobs.items()})

    write("silver", silver_dimensions(spark, raw, as_of))
    write("silver", silver_postings(raw, seeds))
    write("silver", silver_facts(raw, seeds, done))
    write("silver", shared_joins(done))
    write("silver", shared_counts(done))
    write("gold", gold_marts(done, seeds, as_of))
    write("checks", {"quality_report": quality.report_of_writes(spark, metrics, done)})
    if export:
        for name, order in export_orders().items():
            export_csv(done[name], f"{out}/export/{name}", order)
        for name, report in reports.diagnostics(done).items():
            export_csv(report, f"{out}/diagnostics/{name}")
    return done


def land(spark: SparkSession, raw_root: str, api: str | None = None, occupations: str | None = None,
         files: str | None = None) -> None:
    """Bring fetched files into the raw layout; each folder is optional."""
    if api:
        land_api_payloads(spark, api, raw_root)
    if occupations:
        land_occupation_files(spark, occupations, raw_root)
    if files:
        land_csv_files(spark, files, raw_root)


def start_settings(partitions: str | None) -> dict[str, str]:
    """Adaptive execution merges small partitions but never splits a number chosen too low."""
    return {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": partitions} if partitions else {}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Land fetched files and build all tables.")
    parser.add_argument("mode", choices=["land", "build", "all"])
    parser.add_argument("raw", help="folder with the raw parquet files and seeds")
    parser.add_argument("out", help="folder the layers are written to")
    parser.add_argument("--api", help="folder with the JSON answers of the four interfaces")
    parser.add_argument("--occupations", help="folder with the tab-separated occupation files")
    parser.add_argument("--files", help="folder with downloaded CSV files")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, default=None)
    parser.add_argument("--export", action="store_true", help="also write marts and diagnostics as CSV")
    parser.add_argument("--master", default=None)
    parser.add_argument("--partitions", default=None,
                        help="shuffle partitions to start with, where the session's own setting is not wanted")
    args = parser.parse_args(argv)
    spark = build_session(master=args.master, **start_settings(args.partitions))
    if args.mode in ("land", "all"):
        land(spark, args.raw, args.api, args.occupations, args.files)
    if args.mode in ("build", "all"):
        run(spark, args.raw, args.out, args.as_of, args.export)


if __name__ == "__main__":
    main()
