from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from jobtide.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def rows(spark):
    """Rows with a DDL schema to a DataFrame."""
    return lambda data, schema: spark.createDataFrame(data, schema)


@pytest.fixture
def result():
    """Collected rows as a sorted list of tuples; NULLs sort first."""
    def collect(df, *columns):
        picked = df.select(*[f"`{c}`" for c in columns]) if columns else df
        return sorted((tuple(r) for r in picked.collect()),
                      key=lambda t: tuple((x is not None, str(x)) for x in t))
    return collect
