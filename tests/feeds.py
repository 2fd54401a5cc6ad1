"""A small made-up raw folder with every feed, written as the pipeline expects it."""

from __future__ import annotations

import csv
import os

from jobtide.fixed_values import MACRO_SERIES, METRO_VARIABLES
from jobtide.sources.catalog import BRONZE

DEV, SCI = "15-1252.00", "15-2051.00"
UNTYPED = "key string, value string"


def ratings(name):
    return [
        (DEV, "2.A ", f" {name} ", "IM", "N", 3.0),
        (DEV, "2.A", name, "IM", "N", 4.5),
        (DEV, "2.A", name, "LV", "N", 5.0),
        (DEV, "2.B", "Suppressed", "IM", "Y", 1.0),
        (DEV, "2.B", "Suppressed", "LV", "N", 1.0),
        (DEV, "2.C", "Unmarked", "IM", None, 1.0),
        (DEV, "2.C", "Unmarked", "LV", None, 1.0),
    ]


def live(id_, created, location, low, high, company="Acme", title="Software Engineer"):
    return (id_, title, " text ", "Full_Time", location, company, "IT Jobs", created, "data engineer",
            "all", "2026-03-02", low, high, 30.0, -97.0)


LIVE = [
    live("1", "2026-03-01T10:00:00Z", "Austin, Texas", 100000.0, 120000.0),
    live("1", "2026-03-02T10:00:00Z", "Austin, Texas", 110000.0, 130000.0),
    *[live(str(i), f"2026-03-{i:02d}T00:00:00Z", "Austin, Texas", 90000.0 + i, 110000.0 + i) for i in range(2, 7)],
    live("20", "2026-04-01T00:00:00Z", "US", None, None, title="Remote Lead"),
    live("21", "2026-04-01T00:00:00Z", "Union, Union County", 50000.0, 70001.0),
    live("22", "2026-04-01T00:00:00Z", "Ghost, Lost County", None, None, company=" "),
    live("23", "2026-04-01T00:00:00Z", "Nowhere", None, None),
]


def listing(i, title="Software Engineer", kind="Onsite", seen="2024-01-15"):
    return (f" link/{i} ", title, f"Co {i % 2}", "Austin, TX", "Mid Senior", kind, "Dev", "Austin", "US", seen)


LARGE = [listing(i) for i in range(12)] + [
    listing(50, title="remote nurse", kind="Onsite"), listing(51, title="remote nurse", kind=None),
    listing(52, title=" "), listing(53, title=None), listing(54, title="Data Scientists", seen="soon"),
]
LARGE_SKILLS = [(f"link/{i}", "Python, SQL ,problem-solving,,python") for i in range(12)] + [
    ("link/0", "Rust, Bachelor's degree"), ("link/1", "rust, Go"), ("link/2", "go"), ("link/3", "GO"),
    ("link/54", "  "), ("link/99", "orphan skill"),
]
SCIENCE = [listing(i + 100, title="Data Scientists") for i in range(9)]
SCIENCE_SKILLS = [("link/100", "R, SQL")]
SUMMARY = [("link/100", " about "), ("link/101", " ")]

LINKEDIN = [
    # job_id, texts …, company_id, listed_time, remote_allowed, views, applies
    ("Software Engineer", "d", "NYC", "Acme", "FULL_TIME", "Full-time", "Entry", 1, 7.0, 1711317014000.0, 1.0, 5.0, 1.0),
    ("Software Engineer", "d", "NYC", "Acme", "FULL_TIME", "Full-time", "Entry", 2, 7.0, 1713500000000.0, None, 5.0, None),
    ("Plumber", None, "NYC", None, None, None, None, 3, None, 0.0, None, None, None),
]
SALARIES = [
    # max, med, min, period, currency by (salary_id, job_id)
    (10, 1, None, 60.0, None, "HOURLY", "USD"),
    (11, 1, 5000.0, None, 4000.0, "MONTHLY", "usd"),
    (12, 2, None, 10.0, None, "HOURLY", "EUR"),
    (13, 3, None, 3.0, None, "HOURLY", "USD"),
]

LABOR = [
    ("LNS14000000", "2023", "M01", "January", "3.5", "false", None, None, None, None),
    ("LNS14000000", "2024", "M01", "January", "4.0", "true", "0.1", "x", "2.5", ""),
    ("LNS14000000", "2024", "M13", "Annual", "3.9", "false", None, None, None, None),
    ("LNS12300060", "2024", "M02", "February", "80.0", "false", None, None, None, None),
    ("OTHER", "2024", "S01", "Half", "-", "false", None, None, None, None),
    ("OTHER", "2024", "Q05", "Quarter", "1.0", "false", None, None, None, None),
    ("OTHER", "2024", "M02", "February", " ", "false", None, None, None, None),
]


def macro(date, **values):
    return (date, *[values.get(s) for s, _ in MACRO_SERIES])


MACRO = [
    macro("2024-02-01T00:00:00.000", LNS12300060=79.0, DFF=5.0), macro("2024-02-02", DFF=6.0),
    macro("2024-03-01", LNS12300060=79.5), macro(None, DFF=9.0), macro("bad", DFF=9.0),
]


def metro(fips, name, income):
    figures = {"DP03_0062E": income, "DP03_0009PE": "4.5", "DP02_0068PE": "-"}
    return (name, fips, *[figures.get(code, "10.5") for code, _, _ in METRO_VARIABLES])


def rows_by_table():
    """Rows per bronze table, in the order of the declared columns."""
    return {
        "stg_adzuna__postings": LIVE,
        "stg_bls__series": LABOR,
        "stg_fred__series": MACRO,
        "stg_acs__metro_profiles": [metro("12420", " Austin Metro ", "90000"), metro("1", "None", "(X)")],
        "stg_onet__occupations": [
            (DEV, " Software Developers ", "Write "), (SCI, "Data Scientists", "Study"),
            ("11-1011.00", "Chief Executives", "Lead")],
        "stg_onet__job_zones": [(DEV, 4), (SCI, 5)],
        "stg_onet__alternate_titles": [
            (SCI, "Software Engineer", "SWE"), (DEV, "Software Engineer", "SWE"),
            (DEV, "Data Scientists", None), (SCI, "ml", None), (SCI, None, None), (SCI, " ", None)],
        "stg_onet__skills": ratings("Python"),
        "stg_onet__knowledge": ratings("Math"),
        "stg_onet__work_activities": ratings("Analyse"),
        "stg_onet__abilities": ratings("See"),
        "stg_onet__technology_skills": [
            (DEV, "Python", " Languages ", "Y", "N", 432), (DEV, "Excel", "Sheets", "N", "?", 433),
            (DEV, "Excel", "Sheets", "N", "?", 433), (SCI, "R", "Languages", "Y", "Y", 432)],
        "stg_onet__education_training_experience": [
            (DEV, "2.D.1", "Required", "RL", "N", 6, 60.0), (DEV, "2.D.1", "Required", "RL", "N", 6, 5.0),
            (DEV, "2.D.1", "Required", "RL", "N", 8, 20.0), (DEV, "2.D.1", "Required", "RL", "Y", 8, 1.0),
            (DEV, "2.D.1", "Required", "PT", "N", 6, 99.0), (DEV, "2.D.1", "Required", "RL", "N", 12, 15.0)],
        "stg_kaggle_linkedin__postings": LINKEDIN,
        "stg_kaggle_linkedin__salaries": [(s, j, *rest) for s, j, *rest in SALARIES],
        "stg_kaggle_linkedin__job_skills": [(1, "IT"), (1, "IT"), (1, "SALE"), (2, "NONE"), (2, "GONE")],
        "stg_kaggle_linkedin__mapping_skills": [
            ("IT", " Information Technology "), ("SALE", "Sales"), ("NONE", None)],
        "stg_kaggle_linkedin__companies": [
            (7, 3.0, " Acme ", "d ", "Austin", "TX", "US", " 1 ", "u"),
            (8, None, "Solo", None, None, None, None, None, None),
            (None, None, "Nobody", None, None, None, None, None, None)],
        "stg_kaggle_linkedin__company_industries": [(7, "Software"), (7, " software "), (7, "AI"), (8, " ")],
        "stg_kaggle_linkedin__company_specialties": [(7, "Cloud")],
        "stg_kaggle_linkedin__employee_counts": [
            (7, 10, 100, 1), (7, 12, 120, 2), (7, None, 130, 3)],
        "stg_kaggle_linkedin_large__postings": LARGE,
        "stg_kaggle_linkedin_large__job_skills": LARGE_SKILLS,
        "stg_kaggle_ds__postings": SCIENCE,
        "stg_kaggle_ds__job_skills": SCIENCE_SKILLS,
        "stg_kaggle_ds__summary": SUMMARY,
    }


SEED_ROWS = {
    "seed_onet__ete_categories.csv": (",", [
        ["Element ID", "Element Name", "Scale ID", "Category", "Category Description"],
        ["2.D.1", "Required ", "RL", "6", "Bachelor's"], ["2.D.1", "Required", "RL", "8", "Master's"],
        ["2.D.1", "Required", "PT", "6", "Training"], ["2.D.1", "Required", "RL", "n/a", "Unknown"]]),
    "us_cities_states_counties.csv": ("|", [
        ["city", "state_short", "state_full", "county", "city_alias"],
        ["Austin", "TX", "Texas", "Travis", "Austin"], ["Austin", "TX", "Texas", "Travis", "Waterloo"],
        ["Union", "IA", "Iowa", "Union County", "Union"], ["Union", "OH", "Ohio", "Union County", "Union"]]),
}


def write_raw(spark, root: str) -> str:
    rows = rows_by_table()
    for name, entry in BRONZE.items():
        schema = entry.schema or UNTYPED
        data = rows.get(name, [("k", "v")])
        # The first of several patterns is that of a single file.
        file = entry.file.strip("{}").split(",")[0].replace("*", "data")
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{root}/{entry.source}/{file}")
    os.makedirs(f"{root}/seeds")
    for file, (sep, lines) in SEED_ROWS.items():
        with open(f"{root}/seeds/{file}", "w", newline="") as out:
            csv.writer(out, delimiter=sep).writerows(lines)
    return root

