"""Dates without a time zone: nothing here depends on the session's zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobtide.functions.text import pad_month

_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def month_start(c: Column) -> Column:
    """Midnight of the first of the month, for a date or a timestamp."""
    return F.trunc(c.cast("date"), "month").cast("timestamp_ntz")


def year_of(c: Column) -> Column:
    return F.year(c).cast("bigint")


def quarter_of(c: Column) -> Column:
    return F.quarter(c).cast("bigint")


def month_of(c: Column) -> Column:
    return F.month(c).cast("bigint")


def date_parts(c: Column, year: str = "year", quarter: str | None = "quarter",
               month: str | None = None) -> list[Column]:
    """Named calendar parts of one date, in the order year, quarter, month."""
    parts = [year_of(c).alias(year)]
    if quarter:
        parts.append(quarter_of(c).alias(quarter))
    if month:
        parts.append(month_of(c).alias(month))
    return parts


def iso_weekday(c: Column) -> Column:
    """Monday 1 … Sunday 7."""
    return (F.weekday(c) + 1).cast("int")


def is_weekend(c: Column) -> Column:
    return F.weekday(c) >= 5


def date_key(c: Column) -> Column:
    """The day as the integer yyyyMMdd."""
    return F.date_format(c, "yyyyMMdd").cast("int")


def month_name(c: Column) -> Column:
    return F.date_format(c, "MMMM")


def add_part(c: Column, amount: int, part: str) -> Column:
    """Add a number of DAYs, MONTHs, YEARs … to a timestamp."""
    return F.timestamp_add(part.upper(), F.lit(amount), c)


def safe_date(c: Column) -> Column:
    """ISO date text, with or without a time behind it; everything else is NULL."""
    text = F.trim(c)
    return F.when(text.rlike(r"^\d{4,}-\d{1,2}-\d{1,2}([T ].*)?$"), text.try_cast("date"))


def period_date(year: Column, period: Column) -> Column:
    """First of the month for monthly period codes; annual, half-year and quarter codes have none."""
    text = F.concat_ws("-", year.cast("string"), pad_month(period), F.lit("01"))
    return F.when(period.rlike(r"^M?(0?[1-9]|1[0-2])$"), text.try_cast("date"))


def _since_epoch(unit: str, amount: Column) -> Column:
    whole = amount.cast("bigint")
    return F.when(whole > 0, F.timestamp_add(unit, whole, F.expr(_EPOCH)))


def from_epoch_ms(c: Column) -> Column:
    """Epoch milliseconds; zero and negative values mean 'unknown'."""
    return _since_epoch("MILLISECOND", c)


def from_epoch_s(c: Column) -> Column:
    return _since_epoch("SECOND", c)
