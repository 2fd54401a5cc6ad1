"""Fetched files to the raw parquet layout that the bronze tables are scanned from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from jobtide.fixed_values import MACRO_SERIES
from jobtide.sources import readers as r
from jobtide.sources.catalog import BRONZE, OCCUPATION_FILES
from jobtide.streaming.landing import land_live_postings


def _write(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").parquet(path)
    return path


def land_api_payloads(spark: SparkSession, api: str, raw: str,
                      metros: Sequence[str] = tuple(r.METRO_CODES)) -> list[str]:
    """JSON answers below ``api/{adzuna,bls,fred,acs}`` to parquet below ``raw``.

    Live postings accumulate and are landed incrementally; the three series and profile feeds
    are small, complete answers and replace what was there. ``metros`` are the areas to keep.
    """
    live = f"{raw}/adzuna/live"
    land_live_postings(spark, f"{api}/adzuna", live, f"{raw}/_checkpoints/adzuna", latest=f"{raw}/adzuna/latest")
    labor = r.explode_series(r.read_json(spark, f"{api}/bls/*.json", r.LABOR_PAYLOAD))
    macro = r.wide_from_map(
        r.read_payloads(spark, f"{api}/fred/*.json"), [series for series, _ in MACRO_SERIES])
    profiles = r.header_rows(r.read_payloads(spark, f"{api}/acs/*.json"), r.METRO_NAMES, metros)
    return [
        live,
        _write(labor, f"{raw}/bls/bls_series.parquet"),
        _write(macro, f"{raw}/fred/fred_series.parquet"),
        _write(profiles, f"{raw}/acs/acs_metro_profiles.parquet"),
    ]


def land_occupation_files(spark: SparkSession, folder: str, raw: str) -> list[str]:
    """The used tab-separated files of the occupation database, typed, to ``raw/onet``."""
    schemas = {e.file: e.schema for e in BRONZE.values() if e.source == "onet"}
    present = {path.rsplit("/", 1)[-1].replace("%20", " "): path
               for path in r.list_files(spark, folder, "*.txt")}
    return [
        _write(r.typed(r.read_tsv(spark, present[name]), schemas[f"{table}.parquet"]),
               f"{raw}/onet/{table}.parquet")
        for name, table in OCCUPATION_FILES.items() if name in present
    ]


def land_csv_files(spark: SparkSession, folder: str, raw: str) -> dict[str, tuple[int, int]]:
    """Downloaded CSV below ``folder`` (laid out like ``raw``) to parquet; (rows, rejected rows) by table."""
    return r.csv_to_parquet(spark, folder, raw, schemas=r.file_schemas())
