"""Ranking and row-to-row comparison.

Each 'first k rows per key' is a row number plus a filter on it: Spark then limits every task
to k rows per key before the shuffle, so a hot key does not arrive whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide.session import written


def latest_first(*columns: str) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in columns]


def earliest_first(*columns: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def top_k_per_group(df: DataFrame, keys: Sequence[str] | str, order: Sequence[Column], k: int,
                    rank: str | None = None) -> DataFrame:
    """First ``k`` rows per key; end ``order`` with a unique column to make ties repeatable."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    name = rank or "__rank"
    spec = Window.partitionBy(*keys).orderBy(*order)
    best = df.withColumn(name, F.row_number().over(spec)).where(F.col(name) <= k)
    return best if rank else best.drop(name)


def latest_per_key(df: DataFrame, keys: Sequence[str] | str, order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given order."""
    return top_k_per_group(df, keys, order, 1)


def first_by_priority(df: DataFrame, key: str, priority: Column,
                      ties: Sequence[str]) -> DataFrame:
    """One row per key: lowest priority number, then the tie columns."""
    return top_k_per_group(df, key, [priority.asc(), *earliest_first(*ties)], 1)


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows overall; every task keeps only its own first ``k``."""
    return df.orderBy(*order).limit(k)


_PLACE = "__place"


def range_number() -> Column:
    """The range of a row of :func:`in_order`."""
    return F.shiftright(F.col(_PLACE), 33)


def in_order(df: DataFrame, keys: Sequence[str], order: str, ranges: int | None = None) -> DataFrame:
    """Rows cut into ranges of (keys, order) and written, each with its place, which counts up within and across ranges.

    The number of ranges is that of shuffle partitions, small ones merged, unless given. Rows alike in keys and order
    share a range.
    """
    by = [*map(F.col, keys), F.col(order).asc_nulls_last()]
    ranged = df.repartitionByRange(ranges, *by) if ranges else df.repartitionByRange(*by)
    return written(ranged.sortWithinPartitions(*by).withColumn(_PLACE, F.monotonically_increasing_id()), "ordered")


def _edges(placed: DataFrame, keys: Sequence[str], steps: int) -> tuple[DataFrame, DataFrame]:
    """(heads, tails): the first and last ``steps`` rows of the keys that go on over a bound between two ranges.

    A bound cuts one key at most, so both have ``steps`` rows per range at most.
    """
    whole, by_range = F.struct(*keys), Window.orderBy("__range")
    ends = placed.groupBy(range_number().alias("__range")).agg(F.min(whole).alias("__first"), F.max(whole).alias("__last"))
    cut = ends.select("__range", "__first", "__last",
                      F.col("__first").eqNullSafe(F.lag("__last").over(by_range)).alias("__from_before"),
                      F.col("__last").eqNullSafe(F.lead("__first").over(by_range)).alias("__goes_on"))
    near = placed.withColumn("__range", range_number()).join(F.broadcast(cut), "__range")  # a row per range
    heads = near.where(F.col("__from_before") & whole.eqNullSafe(F.col("__first")))
    tails = near.where(F.col("__goes_on") & whole.eqNullSafe(F.col("__last")))
    return (top_k_per_group(heads, "__range", [F.col(_PLACE).asc()], steps).select(*placed.columns),
            top_k_per_group(tails, "__range", [F.col(_PLACE).desc()], steps).select(*placed.columns))


def with_prev(df: DataFrame, key: Sequence[str] | str, order: str, columns: dict[str, str],
              steps: int = 1, ranges: int | None = None) -> DataFrame:
    """Value of an earlier ROW of the same key (not of an earlier calendar period).

    A key of any size is the work of many tasks: rows are compared inside ranges of (key, order). Where a key goes on
    in the next range, the last ``steps`` rows before the bound are carried over to the first ones behind it.
    """
    keys = [key] if isinstance(key, str) else list(key)
    placed = in_order(df, keys, order, ranges)
    result = [*df.columns, *columns]

    def lagged(rows: DataFrame, *within: Column | str) -> DataFrame:
        spec = Window.partitionBy(*within).orderBy(_PLACE)
        return rows.withColumns({new: F.lag(old, steps).over(spec) for new, old in columns.items()})

    if not placed.agg(F.max(range_number())).first()[0]:  # one range
        return lagged(placed, *keys).select(*result)
    heads, tails = _edges(placed, keys, steps)
    tails = tails.join(heads.select(_PLACE), _PLACE, "left_anti")
    near = heads.withColumn("__head", F.lit(True)).unionByName(tails.withColumn("__head", F.lit(False)))
    carried = lagged(near, *keys).where("__head").select(
        F.col(_PLACE).alias("__at"), F.struct(*columns).alias("__carried"))
    inside = lagged(placed, range_number(), *keys).join(F.broadcast(carried), F.col(_PLACE) == F.col("__at"), "left")
    return inside.withColumns({
        new: F.when(F.col("__at").isNotNull(), F.col(f"__carried.`{new}`")).otherwise(F.col(f"`{new}`")) for new in columns
    }).select(*result)


def yoy(df: DataFrame, key: str, order: str, value: str, steps: int = 12, ranges: int | None = None) -> DataFrame:
    """Adds the value ``steps`` rows earlier as ``<value>_12m_ago``."""
    return with_prev(df, key, order, {f"{value}_{steps}m_ago": value}, steps, ranges)


def yoy_calendar(df: DataFrame, key: str, month: str, value: str, months: int = 12) -> DataFrame:
    """As :func:`yoy`, but against the month exactly ``months`` earlier, NULL if that is missing."""
    earlier = df.select(
        F.col(key).alias("__key"),
        F.timestamp_add("MONTH", F.lit(months), F.col(month)).alias("__month"),
        F.col(value).alias(f"{value}_{months}m_ago"),
    )
    same = (F.col(key) == F.col("__key")) & (F.col(month) == F.col("__month"))
    return df.join(earlier, same, "left").drop("__key", "__month")
