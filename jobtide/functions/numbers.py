"""Numbers: tolerant casts, rounding, ratios and conditional counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_cast(c: Column, to: str) -> Column:
    """NULL instead of an error where the value does not fit; text with a fraction rounds to INT."""
    if to == "int":
        return F.round(c.try_cast("double")).try_cast("int")
    return c.try_cast(to)


def round_to(c: Column, digits: int) -> Column:
    """Round a double half away from zero on its scaled value, as SQL engines with binary doubles do."""
    scale = float(10 ** digits)
    return F.round(c.cast("double") * F.lit(scale)) / F.lit(scale)


def rounded_int(c: Column) -> Column:
    """Round first, cast second: a bare cast would cut the fraction off."""
    return F.round(c).cast("int")


def safe_ratio(part: Column, whole: Column, digits: int) -> Column:
    """Share rounded to ``digits``; NULL for a zero denominator."""
    return round_to(part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), digits)


def growth(now: Column, before: Column, digits: int) -> Column:
    """Relative change against the absolute earlier value."""
    return safe_ratio(now - before, F.abs(before), digits)


def gate(c: Column, points: Column, at_least: int = 5) -> Column:
    """Publish a statistic only where enough data points stand behind it."""
    return F.when(points >= at_least, c)


def count_where(condition: Column) -> Column:
    return F.count_if(condition)
