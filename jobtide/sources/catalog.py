"""Bronze tables: where each one lies under the raw folder and which columns it has.

Column names are those of the feeds, odd characters included; they are renamed in silver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from jobtide.fixed_values import MACRO_SERIES, METRO_KEY, METRO_VARIABLES

_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "long": T.LongType(), "int": T.IntegerType(),
}


def columns(**groups: list[str]) -> T.StructType:
    """Schema from type=names."""
    schema = T.StructType()
    for kind, names in groups.items():
        for name in names:
            schema.add(name, _TYPES[kind])
    return schema


@dataclass(frozen=True)
class Bronze:
    """One raw table: folder, file (may hold a wildcard) and schema.

    ``schema`` None means the columns are taken from the files themselves.
    """

    source: str
    file: str
    schema: T.StructType | None = None


_RATINGS = columns(
    string=[
            "O*NET-SOC Code", "Element ID", "Element Name", "Scale ID", "Recommend Suppress"], double=["Data Value"])
_LISTINGS = columns(
    string=[
            "job_link", "job_title", "company", "job_location", "job_level", "job_type",
            "search_position", "search_city", "search_country", "first_seen"])
_LISTING_SKILLS = columns(string=["job_link", "job_skills"])

_LINKEDIN = "kaggle/linkedin_jobs"
_LARGE = "kaggle/linkedin_jobs_2024_large"
_SCIENCE = "kaggle/data_science_jobs"

BRONZE: dict[str, Bronze] = {
    "stg_adzuna__postings": Bronze("adzuna", "{adzuna_*.parquet,live/batch-*}", columns(
        string=[
            "id", "title", "description", "contract_time", "location.display_name",
            "company.display_name", "category.label", "created", "_search_query",
            "_search_location", "_fetched_at"],
        double=["salary_min", "salary_max", "latitude", "longitude"])),
    "stg_bls__series": Bronze("bls", "bls_*.parquet", columns(
        string=[
            "seriesID", "year", "period", "periodName", "value", "latest",
            "calculations.net_changes.1", "calculations.net_changes.12",
            "calculations.pct_changes.1", "calculations.pct_changes.12"])),
    "stg_fred__series": Bronze("fred", "fred_series.parquet", columns(
        string=["date"], double=[series for series, _ in MACRO_SERIES])),
    "stg_acs__metro_profiles": Bronze("acs", "acs_metro_profiles.parquet", columns(
        string=["NAME", METRO_KEY, *[code for code, _, _ in METRO_VARIABLES]])),
    "stg_onet__occupations": Bronze("onet", "occupation_data.parquet", columns(
        string=["O*NET-SOC Code", "Title", "Description"])),
    "stg_onet__job_zones": Bronze("onet", "job_zones.parquet", columns(
        string=["O*NET-SOC Code"], int=["Job Zone"])),
    "stg_onet__alternate_titles": Bronze("onet", "alternate_titles.parquet", columns(
        string=["O*NET-SOC Code", "Alternate Title", "Short Title"])),
    "stg_onet__skills": Bronze("onet", "skills.parquet", _RATINGS),
    "stg_onet__knowledge": Bronze("onet", "knowledge.parquet", _RATINGS),
    "stg_onet__work_activities": Bronze("onet", "work_activities.parquet", _RATINGS),
    "stg_onet__abilities": Bronze("onet", "abilities.parquet", _RATINGS),
    "stg_onet__technology_skills": Bronze("onet", "technology_skills.parquet", columns(
        string=["O*NET-SOC Code", "Example", "Commodity Title", "Hot Technology", "In Demand"],
        long=["Commodity Code"])),
    "stg_onet__education_training_experience": Bronze(
            "onet", "education_training_experience.parquet", columns(
            string=[
            "O*NET-SOC Code", "Element ID", "Element Name", "Scale ID", "Recommend Suppress"],
            int=["Category"], double=["Data Value"])),
    "stg_onet__emerging_tasks": Bronze("onet", "emerging_tasks.parquet"),
    "stg_onet__task_statements": Bronze("onet", "task_statements.parquet"),
    "stg_kaggle_linkedin__postings": Bronze(_LINKEDIN, "linkedin_postings.parquet", columns(
        string=[
            "title", "description", "location", "company_name", "work_type",
            "formatted_work_type", "formatted_experience_level"],
        long=["job_id"], double=["company_id", "listed_time", "remote_allowed", "views", "applies"])),
    "stg_kaggle_linkedin__salaries": Bronze(f"{_LINKEDIN}/jobs", "linkedin_salaries.parquet", columns(
        long=["salary_id", "job_id"], double=["max_salary", "med_salary", "min_salary"],
        string=["pay_period", "currency"])),
    "stg_kaggle_linkedin__job_skills": Bronze(
        f"{_LINKEDIN}/jobs", "linkedin_job_skills.parquet", columns(long=["job_id"], string=["skill_abr"])),
    "stg_kaggle_linkedin__job_benefits": Bronze(f"{_LINKEDIN}/jobs", "linkedin_benefits.parquet"),
    "stg_kaggle_linkedin__job_industries": Bronze(
        f"{_LINKEDIN}/jobs", "linkedin_job_industries.parquet"),
    "stg_kaggle_linkedin__mapping_skills": Bronze(
        f"{_LINKEDIN}/mappings", "linkedin_mapping_skills.parquet",
        columns(string=["skill_abr", "skill_name"])),
    "stg_kaggle_linkedin__mapping_industries": Bronze(
        f"{_LINKEDIN}/mappings", "linkedin_mapping_industries.parquet"),
    "stg_kaggle_linkedin__companies": Bronze(
        f"{_LINKEDIN}/companies", "linkedin_companies.parquet", columns(
            long=["company_id"], double=["company_size"],
            string=["name", "description", "city", "state", "country", "zip_code", "url"])),
    "stg_kaggle_linkedin__company_industries": Bronze(
        f"{_LINKEDIN}/companies", "linkedin_company_industries.parquet",
        columns(long=["company_id"], string=["industry"])),
    "stg_kaggle_linkedin__company_specialties": Bronze(
        f"{_LINKEDIN}/companies", "linkedin_company_specialities.parquet",
        columns(long=["company_id"], string=["speciality"])),
    "stg_kaggle_linkedin__employee_counts": Bronze(
        f"{_LINKEDIN}/companies", "linkedin_employee_counts.parquet",
        columns(long=["company_id", "employee_count", "follower_count", "time_recorded"])),
    "stg_kaggle_linkedin_large__postings": Bronze(
        _LARGE, "linkedin_1_3m_job_postings.parquet", _LISTINGS),
    "stg_kaggle_linkedin_large__job_skills": Bronze(
        _LARGE, "linkedin_1_3m_job_skills.parquet", _LISTING_SKILLS),
    "stg_kaggle_ds__postings": Bronze(_SCIENCE, "ds_job_postings.parquet", _LISTINGS),
    "stg_kaggle_ds__job_skills": Bronze(_SCIENCE, "ds_job_skills.parquet", _LISTING_SKILLS),
    "stg_kaggle_ds__summary": Bronze(
        _SCIENCE, "ds_job_summary.parquet", columns(string=["job_link", "job_summary"])),
}

# Seed tables: file under the seed folder, delimiter and the columns that are used.
SEEDS: dict[str, tuple[str, str, list[str]]] = {
    "seed_onet__ete_categories": (
            "seed_onet__ete_categories.csv", ",",
        ["Element ID", "Element Name", "Scale ID", "Category", "Category Description"]),
    "us_cities_states_counties": (
            "us_cities_states_counties.csv", "|", ["city", "county", "state_full"]),
    "state_to_cbsa_bridge": ("state_to_cbsa_bridge.csv", ",", ["state", "city", "cbsa_fips"]),
    "skill_name_normalization": (
            "skill_name_normalization.csv", ",", ["raw_skill", "canonical_skill"]),
}

# The seed whose rows form a bronze table of their own.
SEED_BRONZE = {"stg_onet__ete_categories": "seed_onet__ete_categories"}

# Bulk files of the occupation database that are used, and the table each one becomes.
OCCUPATION_FILES = {
    "Occupation Data.txt": "occupation_data",
    "Skills.txt": "skills",
    "Knowledge.txt": "knowledge",
    "Abilities.txt": "abilities",
    "Technology Skills.txt": "technology_skills",
    "Alternate Titles.txt": "alternate_titles",
    "Job Zones.txt": "job_zones",
    "Task Statements.txt": "task_statements",
    "Emerging Tasks.txt": "emerging_tasks",
    "Work Activities.txt": "work_activities",
    "Education, Training, and Experience.txt": "education_training_experience",
}
