"""Joins.

No side is broadcast by hint unless it is a list written in the code. For every other side the
planner decides from its size, and adaptive execution decides again from the size measured at
run time; a side over the threshold is shuffled, and hot keys are split (skew join).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide.functions.text import norm
from jobtide.operators.windows import top_k

Keys = str | Sequence[str]


def as_list(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def inline_mapping(spark: SparkSession, rows: Sequence[tuple], columns: Sequence[str]) -> DataFrame:
    """A table written in the code. Its size is fixed there, so broadcasting it is safe."""
    table = pa.table({name: [row[i] for row in rows] for i, name in enumerate(columns)})
    return F.broadcast(spark.createDataFrame(table))


def inner_on(left: DataFrame, right: DataFrame, keys: Keys) -> DataFrame:
    return left.join(right, as_list(keys), "inner")


def join_null_safe(left: DataFrame, right: DataFrame, keys: Keys, how: str = "left") -> DataFrame:
    """Join where NULL equals NULL, as group keys do; the keys of the left side are kept."""
    keys = as_list(keys)
    renamed = right.select(
        *[F.col(k).alias(f"__{k}") for k in keys],
        *[F.col(c) for c in right.columns if c not in keys],
    )
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"__{k}" for k in keys])


def left_chain(first: DataFrame, *others: DataFrame, on: Keys) -> DataFrame:
    """Left joins on one key: all sides meet on one partitioning of that key."""
    return reduce(lambda acc, side: acc.join(side, as_list(on), "left"), others, first)


def lookup_or_self(df: DataFrame, mapping: DataFrame, key: str, name: str) -> DataFrame:
    """Readable name of a key; the key itself where the mapping has none."""
    return df.join(mapping, key, "left").withColumn(name, F.coalesce(F.col(name), F.col(key)))


def apply_dictionary(df: DataFrame, dictionary: DataFrame, column: str, variant: str,
                     canonical: str) -> DataFrame:
    """Replace variants by their canonical form, in place. Variants must be unique."""
    rename = dictionary.select(F.col(variant).alias("__variant"), F.col(canonical).alias("__name"))
    joined = df.join(rename, F.col(column) == F.col("__variant"), "left")
    return joined.withColumn(column, F.coalesce("__name", column)).drop("__variant", "__name")


def resolve_codes(df: DataFrame, mapping: DataFrame, key: str, name: str) -> DataFrame:
    """Attach the name of a code and drop rows whose code has none."""
    named = mapping.where(F.col(name).isNotNull()).select(key, name)
    return df.join(named, key, "inner")


def match_titles(df: DataFrame, titles: DataFrame, title: str = "job_title") -> DataFrame:
    """Occupation by exact title. ``titles`` holds each title once, so rows do not multiply."""
    lookup = titles.select(
        F.col("title_lower").alias("__title"), "onet_soc_code", "soc_code"
    )
    matched = df.join(lookup, F.col(title) == F.col("__title"), "left").drop("__title")
    found = F.col("onet_soc_code").isNotNull()
    return matched.withColumn(
        "soc_match_type", F.when(found, "exact_match").otherwise("unmatched")
    )


def geo_match(df: DataFrame, places: DataFrame, part_1: str, part_2: str,
              one_match: bool = False) -> DataFrame:
    """Resolve a two-part place against (city, state) and against (city, county).

    A city and county name can exist in several states and then yields several rows; with
    ``one_match`` only the alphabetically first place is kept.
    """
    known = places.select(
        norm(F.col("city")).alias("__city"),
        norm(F.col("county")).alias("__county"),
        norm(F.col("state_full")).alias("__state"),
        "city",
        "county",
        F.col("state_full").alias("state"),
    ).distinct()

    def side(second: str, tag: str) -> DataFrame:
        keyed = known.select(
            F.col("__city").alias(f"__{tag}_1"),
            F.col(second).alias(f"__{tag}_2"),
            F.struct("state", "county", "city").alias(f"__{tag}"),
        )
        if one_match:
            keyed = keyed.groupBy(f"__{tag}_1", f"__{tag}_2").agg(F.min(f"__{tag}").alias(f"__{tag}"))
        return keyed

    first, second = F.lower(F.col(part_1)), F.lower(F.col(part_2))
    matched = df
    for tag, column in (("by_state", "__state"), ("by_county", "__county")):
        matched = matched.join(
            side(column, tag),
            (first == F.col(f"__{tag}_1")) & (second == F.col(f"__{tag}_2")),
            "left",
        )
    return matched.select(
        *df.columns,
        *[F.col(f"__{tag}.{field}").alias(f"{field}_{tag}")
          for tag in ("by_state", "by_county") for field in ("city", "county", "state")],
    )


def compare_sets(left: DataFrame, right: DataFrame, keys: Keys, in_left: str,
                 in_right: str) -> DataFrame:
    """Full outer join with one flag per side telling whether it has the key.

    Adaptive execution splits no full outer join, so a key with very many rows would be one task. Matched rows and
    those of one side alone are three joins here, which it can split; the keys of the other side are made distinct
    before they are dealt.
    """
    keys = as_list(keys)
    flags = lambda has_left, has_right: {in_left: F.lit(has_left), in_right: F.lit(has_right)}
    both = left.join(right, keys).withColumns(flags(True, True))

    def alone(side: DataFrame, other: DataFrame) -> DataFrame:
        return side.join(other.select(*keys).distinct(), keys, "left_anti")

    only_left = alone(left, right).withColumns(flags(True, False))
    only_right = alone(right, left).withColumns(flags(False, True))
    columns = [*keys, *[c for c in left.columns if c not in keys], in_left, *[c for c in right.columns if c not in keys], in_right]
    return both.unionByName(only_left, allowMissingColumns=True).unionByName(
        only_right, allowMissingColumns=True).select(*[F.col(f"`{c}`") for c in columns])


def prefer_source(primary: DataFrame, secondary: DataFrame, keys: Keys) -> DataFrame:
    """All of the primary rows, and the secondary rows whose key the primary does not have."""
    rest = secondary.join(primary.select(*as_list(keys)), as_list(keys), "left_anti")
    return primary.unionByName(rest)


def for_top_groups(df: DataFrame, groups: DataFrame, key: str, order: Sequence[Column],
                   k: int) -> DataFrame:
    """Rows of the first ``k`` groups. The kept key set has at most ``k`` rows."""
    best = top_k(groups, order, k).select(key)
    return df.join(F.broadcast(best), key, "left_semi")


def attach_metro(df: DataFrame, bridge: DataFrame) -> DataFrame:
    """Metro code by normalised state and city."""
    keyed = bridge.select(
        norm(F.col("state")).alias("__state"),
        norm(F.col("city")).alias("__city"),
        F.trim(F.col("cbsa_fips").cast("string")).alias("cbsa_fips"),
    )
    here = (norm(F.col("state")) == F.col("__state")) & (norm(F.col("city")) == F.col("__city"))
    return df.join(keyed, here, "left").drop("__state", "__city")


def attach_ratings(df: DataFrame, ratings: DataFrame, key: str, name: str) -> DataFrame:
    """Formal ratings by key and normalised name; most names have none."""
    keyed = ratings.select(
        F.col(key).alias("__key"),
        norm(F.col(name)).alias("__name"),
        *[c for c in ratings.columns if c not in (key, name)],
    )
    same = (F.col(key) == F.col("__key")) & (F.col(name) == F.col("__name"))
    return df.join(keyed, same, "left").drop("__key", "__name")


def attach_totals(df: DataFrame, totals: DataFrame, keys: Keys) -> DataFrame:
    """Denominators, one row per key."""
    return df.join(totals, as_list(keys), "left")
