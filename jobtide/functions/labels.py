"""Flags and classes derived from several columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobtide.fixed_values import SERIES_CATEGORIES, SUSPECT_SKILL_LENGTH, SUSPECT_SKILL_PATTERNS
from jobtide.functions.text import ilike_any


def remote_flag(*texts: Column, stated: Column | None = None, default: bool | None = None) -> Column:
    """Remote-work flag from the first text that is present.

    This is a fallback chain and not an OR: a title that says 'remote' counts only while the
    texts before it are missing. Without a default the flag may stay unknown.
    """
    chain = [] if stated is None else [stated]
    chain += [t.ilike("%remote%") for t in texts]
    if default is not None:
        chain.append(F.lit(default))
    return F.coalesce(*chain)


def series_category(name: Column) -> Column:
    """Group of an economic series by its readable name; unknown names are 'other'."""
    chain = reduce(
        lambda acc, item: acc.when(name.isin(*item[1]), item[0]), SERIES_CATEGORIES.items(), F
    )
    return chain.otherwise("other")


def location_match(raw: Column, by_state: Column, by_county: Column, second_part: Column) -> Column:
    """How well a raw location could be resolved."""
    return (
        F.when(F.lower(raw) == "us", "COUNTRY_ONLY")
        .when(by_state.isNotNull(), "CITY_STATE")
        .when(by_county.isNotNull(), "CITY_COUNTY")
        .when(F.lower(second_part).contains("county"), "UNMATCHED_CITY_COUNTY")
        .otherwise("UNMATCHED")
    )


def gap_direction(in_catalogue: Column, in_market: Column) -> Column:
    """Which side knows the skill. A row always comes from at least one side."""
    return (
        F.when(in_market & in_catalogue, "aligned")
        .when(in_market, "market_only")
        .otherwise("onet_only")
    )


def is_trending(mentions: Column, before: Column) -> Column:
    """More than a tenth above the previous month, with at least ten mentions; never NULL."""
    rising = (before > 0) & ((mentions - before).cast("double") / F.nullif(before, F.lit(0)) > 0.10)
    return F.coalesce((mentions >= 10) & rising, F.lit(False))


def suspect_skill(name: Column) -> Column:
    """Names that survived the noise filter but still look like requirements."""
    return ilike_any(name, SUSPECT_SKILL_PATTERNS) | (F.length(name) > SUSPECT_SKILL_LENGTH)
