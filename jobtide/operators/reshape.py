"""Reshaping: wide to long, delimited text to rows, unions, spines and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.functions.dates import (
    date_key, is_weekend, iso_weekday, month_name, month_of, quarter_of, year_of,
)
from jobtide.operators.windows import latest_per_key


def to_long(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str,
            value: str) -> DataFrame:
    """A row per listed column, from a single scan. NULL values are kept."""
    return df.unpivot(list(ids), [F.col(f"`{c}`") for c in columns], name, value)


def explode_csv(df: DataFrame, column: str, alias: str, sep: str = ",") -> DataFrame:
    """A row per delimited item; empty items stay, rows without text give none."""
    others = [c for c in df.columns if c != column]
    return df.select(*others, F.explode(F.split(F.col(column), sep)).alias(alias))


def union_sources(*frames: DataFrame) -> DataFrame:
    """Rows of all sources under one schema, matched by name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def dedup_keep_null(df: DataFrame, key: str, order: Sequence[Column], within: Sequence[str] = ()) -> DataFrame:
    """First row per key (in each of ``within``), and every row that has no key."""
    keyed = latest_per_key(df.where(F.col(key).isNotNull()), [*within, key], order)
    return keyed.unionByName(df.where(F.col(key).isNull()))


def calendar(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """A row per day of the ranges in ``bounds`` (both ends included) with its calendar columns."""
    day = F.col("full_date")
    days = bounds.select(F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return days.select(
        day,
        date_key(day).alias("date_key"),
        year_of(day).alias("year"),
        month_of(day).alias("month"),
        quarter_of(day).alias("quarter"),
        iso_weekday(day).alias("day_of_week"),
        is_weekend(day).alias("is_weekend"),
        month_name(day).alias("month_name"),
    )


def date_spine(df: DataFrame, column: str) -> DataFrame:
    """The calendar that covers a date or timestamp column."""
    day = F.col(column).cast("date")
    return calendar(df.agg(F.min(day).alias("lo"), F.max(day).alias("hi")), "lo", "hi")


def coverage_long(df: DataFrame, ids: Sequence[str], labels: Sequence[tuple[str, str]]) -> DataFrame:
    """Count columns as (metric, count) rows under display labels."""
    renamed = df.select(*ids, *[F.col(c).alias(label) for c, label in labels])
    return to_long(renamed, ids, [label for _, label in labels], "metric", "count")
