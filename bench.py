"""Headline queries on the fixture tables; prints one JSON line.

Every query is run once to warm up and then ``BENCH_RUNS`` times (default 3); the median wall
time of building the plan and running it to a no-op sink counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from driver_checks.operator_queries import QUERIES as OPERATORS
from driver_checks.report_queries import QUERIES as REPORTS
from driver_checks.table_queries import QUERIES as TABLES
from jobtide.session import build_session

# Tables that only repeat another one's plan on other columns are left out.
REPEATED = {"dim_knowledge", "dim_work_activities", "live_enriched_one_match"}
HEADLINE = [
    *[name for name in TABLES if name not in REPEATED],
    "exact_percentiles", "explode_words", "noise_filter", "unpivot_series", "quality_report",
]


def timed(query, spark, sf_dir) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    queries = {**TABLES, **OPERATORS, **REPORTS}
    seconds = {}
    for name in HEADLINE:
        timed(queries[name], spark, sf_dir)
        seconds[name] = round(statistics.median(timed(queries[name], spark, sf_dir) for _ in range(runs)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    spark.stop()
    print(json.dumps({
        "metric": "total median wall time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rsplit("/sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
