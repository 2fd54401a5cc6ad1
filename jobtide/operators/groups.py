"""Aggregations. All counts and percentiles are exact."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.functions.dates import month_start
from jobtide.functions.text import not_blank
from jobtide.operators.joins import Keys, as_list, join_null_safe
from jobtide.operators.windows import in_order, range_number, top_k_per_group
from jobtide.session import written

# How INT values are cut into buckets, see exact_percentiles: by the bits above these.
_LOW_BITS = 16


def group_stats(df: DataFrame, keys: Keys, **specs: Column) -> DataFrame:
    """Named aggregates per key in one pass."""
    return df.groupBy(*as_list(keys)).agg(*[c.alias(n) for n, c in specs.items()])


def having(df: DataFrame, condition: Column) -> DataFrame:
    """Filter on finished aggregates."""
    return df.where(condition)


def distinct_count(df: DataFrame, keys: Keys, column: str | Column, name: str) -> DataFrame:
    """Distinct non-NULL values per key, counted over spread (key, value) pairs.

    Two of these joined on the key cost two map-side combined shuffles, where two distinct counts
    in one aggregate would copy every row once per count first.
    """
    keys = as_list(keys)
    value = F.col(column) if isinstance(column, str) else column
    pairs = df.select(*keys, value.alias("__v")).where(F.col("__v").isNotNull()).distinct()
    return group_stats(pairs, keys, **{name: F.count(F.lit(1))})


def dense_ids(values: DataFrame, value: str, parts: int = 64) -> DataFrame:
    """(value, id) of the distinct non-NULL values, ids from 0 without gaps.

    Values are numbered within parts by hash and the parts one after another, so no task has all of them; take as many
    parts that one fits a task.
    """
    once = values.select(F.col(value).alias("value")).where(F.col("value").isNotNull()).distinct()
    dealt = once.withColumn("__part", F.pmod(F.xxhash64("value"), F.lit(parts)))
    placed = dealt.withColumn("__at", F.row_number().over(Window.partitionBy("__part").orderBy("value")))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row per part
    sizes = dealt.groupBy("__part").agg(F.count("*").alias("__n"))
    starts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return placed.join(F.broadcast(starts), "__part").select("value", (F.col("__start") + F.col("__at") - 1).alias("id"))


def distinct_bitmaps(df: DataFrame, keys: Keys, value: str, ids: DataFrame) -> DataFrame:
    """(keys, bucket, bits): which values of ``ids`` (value, id) each key has, as bitmaps of 32,768 ids.

    Unlike counts of distinct values, bitmaps add up: :func:`merge_bitmaps` gives those of fewer keys, or of more
    rows, without the values.
    """
    keys = as_list(keys)
    pairs = df.select(*keys, F.col(value).alias("value")).where(F.col("value").isNotNull()).distinct()
    marked = pairs.join(ids, "value")
    return marked.groupBy(*keys, F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))


def merge_bitmaps(bitmaps: DataFrame, keys: Keys) -> DataFrame:
    """Bitmaps of ``keys``, some of those that the given ones have."""
    return bitmaps.groupBy(*as_list(keys), "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bitmap_counts(bitmaps: DataFrame, keys: Keys, name: str) -> DataFrame:
    """The exact number of distinct values per key."""
    return bitmaps.groupBy(*as_list(keys)).agg(F.sum(F.bitmap_count("bits")).alias(name))


def _with_buckets(counts: DataFrame, keys: list[str], kind: T.DataType) -> DataFrame:
    """counts (keys, __v, __n) with a ``__bucket`` that rises with the value within a group.

    Whole numbers of 32 bits have 65,536 buckets of as many values. Other numbers are sorted by group and value and
    written once; their buckets are the ranges of that order, which hold about as many rows each however the
    values lie and however many groups there are.
    """
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return counts.withColumn("__bucket", F.shiftright(F.col("__v").cast("int"), _LOW_BITS))
    return in_order(counts, keys, "__v").select(*counts.columns, range_number().alias("__bucket"))


def exact_percentiles(df: DataFrame, keys: Keys, value: str,
                      probabilities: dict[str, float]) -> DataFrame:
    """Exact, linearly interpolated percentiles of a numeric column, one row per key.

    ``percentile`` keeps all distinct values of a group in one buffer. Here no task ever holds
    a group: equal values are first counted (combined map-side, spread over (key, value)), a
    histogram over buckets of values finds those that hold the wanted ranks, and only they are
    ranked, each on its own. Values keep their type until they are ranked; results are DOUBLE.
    NaN ranks above all numbers. Groups without a value are absent.
    """
    keys = as_list(keys)
    kind = df.schema[value].dataType
    if not isinstance(kind, T.NumericType):
        raise TypeError(f"{value} is {kind.simpleString()}, not a number")
    counts = _with_buckets(
        df.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).alias("__v"))
        .agg(F.count(F.lit(1)).alias("__n")), keys, kind)

    by_group = Window.partitionBy(*keys)
    buckets = counts.groupBy(*keys, "__bucket").agg(F.sum("__n").alias("__in_bucket"))
    buckets = buckets.withColumns({
        "__total": F.sum("__in_bucket").over(by_group),
        "__before": F.sum("__in_bucket").over(
            by_group.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)),
    }).withColumn("__before", F.coalesce("__before", F.lit(0)))

    position = {name: (F.col("__total") - 1) * F.lit(float(p)) for name, p in probabilities.items()}
    rank = {}
    for name, at in position.items():
        rank[f"{name}__lo"] = F.floor(at)
        rank[f"{name}__hi"] = F.ceil(at)

    def holds(r: Column, start: Column, size: Column) -> Column:
        return (r >= start) & (r < start + size)

    wanted = reduce(
        Column.__or__,
        [holds(r, F.col("__before"), F.col("__in_bucket")) for r in rank.values()],
    )
    candidates = join_null_safe(
        counts, buckets.where(wanted).drop("__in_bucket"), [*keys, "__bucket"], "inner"
    )
    running = F.sum("__n").over(
        Window.partitionBy(*keys, "__bucket").orderBy("__v")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranked = candidates.withColumn("__start", F.col("__before") + running - F.col("__n"))
    found = ranked.groupBy(*keys).agg(
        F.first("__total").alias("__total"),
        *[F.max(F.when(holds(r, F.col("__start"), F.col("__n")), F.col("__v"))).cast("double").alias(n)
          for n, r in rank.items()],
    )

    def between(name: str, at: Column) -> Column:
        low, high, part = F.col(f"{name}__lo"), F.col(f"{name}__hi"), at - F.floor(at)
        return F.when(part == 0, low).otherwise(low + (high - low) * part).alias(name)

    return found.select(*keys, *[between(n, at) for n, at in position.items()])


def with_percentiles(stats: DataFrame, df: DataFrame, keys: Keys, value: str,
                     probabilities: dict[str, float]) -> DataFrame:
    """Aggregates of ``df`` completed by percentiles; NULL where a group has no value."""
    return join_null_safe(stats, exact_percentiles(df, keys, value, probabilities), keys)


def qualified(df: DataFrame, key: str, counted: str, at_least: int, total: str) -> DataFrame:
    """Keys with enough distinct values of ``counted``, and how many they have."""
    return having(
        group_stats(df, key, **{total: F.countDistinct(counted)}), F.col(total) >= at_least
    )


def qualified_sum(df: DataFrame, key: str, counts: str, at_least: int) -> DataFrame:
    """Keys whose already aggregated counts add up to enough."""
    summed = group_stats(df, key, __sum=F.sum(counts))
    return having(summed, F.col("__sum") >= at_least).select(key)


def rating_pivot(df: DataFrame, keys: Keys, scale: str, value: str,
                 names: dict[str, str]) -> DataFrame:
    """One column per rating scale (highest value); keys that miss a scale are dropped."""
    wide = df.groupBy(*as_list(keys)).pivot(scale, list(names)).max(value)
    for code, name in names.items():
        wide = wide.withColumnRenamed(code, name)
    return wide.dropna(subset=list(names.values()))


def category_pivot(df: DataFrame, keys: Keys, category: str, value: str,
                   names: dict) -> DataFrame:
    """One summed column per category, 0 where a key has none."""
    wide = df.groupBy(*as_list(keys)).pivot(category, list(names)).sum(value)
    return wide.select(
        *as_list(keys),
        *[F.coalesce(F.col(f"`{c}`"), F.lit(0.0)).alias(n) for c, n in names.items()],
    )


def agg_sorted_distinct(df: DataFrame, keys: Keys, value: Column, name: str,
                        sep: str = ", ") -> DataFrame:
    """Distinct values per key as one sorted, joined string.

    Repeats are removed by a spread ``distinct`` first, so a task gathers only what ends up in
    its output strings.
    """
    items = agg_distinct_list(df, keys, value, name)
    return items.withColumn(name, F.array_join(name, sep))


def agg_distinct_list(df: DataFrame, keys: Keys, value: Column, name: str) -> DataFrame:
    """Distinct non-NULL values per key as a sorted array."""
    keys = as_list(keys)
    pairs = df.select(*keys, value.alias(name)).where(F.col(name).isNotNull()).distinct()
    return pairs.groupBy(*keys).agg(F.array_sort(F.collect_list(name)).alias(name))


def value_ranks(df: DataFrame, key: str, columns: Sequence[str], k: int) -> DataFrame:
    """The ``k`` most frequent values of several columns per key, from one scan.

    Ties go to the alphabetically first value.
    """
    long = df.unpivot([key], list(columns), "kind", "value").where(not_blank(F.col("value")))
    counted = long.groupBy(key, "kind", "value").agg(F.count(F.lit(1)).alias("n"))
    order = [F.col("n").desc(), F.col("value").asc()]
    return top_k_per_group(counted, [key, "kind"], order, k, rank="rank")


def top_names(kind: str, k: int, sep: str = ", ") -> Column:
    """Aggregate over :func:`value_ranks`: the first ``k`` values of one column, best first."""
    entry = F.when((F.col("kind") == kind) & (F.col("rank") <= k), F.struct("rank", "value"))
    names = F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["value"])
    return F.when(F.size(names) > 0, F.array_join(names, sep))


def most_common(kind: str) -> Column:
    """Aggregate over :func:`value_ranks`: the most frequent value of one column."""
    return F.max(F.when((F.col("kind") == kind) & (F.col("rank") == 1), F.col("value")))


def frequent_values(df: DataFrame, keys: Keys, column: str, k: int, buckets: int = 4096) -> DataFrame:
    """(keys, value, n, rank): the ``k`` most frequent values per key, as :func:`value_ranks` gives them.

    Values are first counted by hash bucket, which bounds their counts from above and shuffles a few numbers however
    many different values there are. The values of each key's ``k`` fullest buckets are counted; the ``k``-th of these
    counts bounds the result from below, and only buckets that reach it are counted as well. Rare names, usually most
    of all, are never shuffled. Ties go to the smaller value.
    """
    keys = as_list(keys)
    rows = df.select(*keys, F.col(column).alias("value")).where(not_blank(F.col("value"))).withColumn(
        "__bucket", F.pmod(F.xxhash64("value"), F.lit(buckets)))
    at_most = written(rows.groupBy(*keys, "__bucket").agg(F.count("*").alias("__most")), "buckets")
    order = [F.col("n").desc(), F.col("value").asc()]

    def counted(chosen: DataFrame) -> DataFrame:
        picked = join_null_safe(rows, chosen.select(*keys, "__bucket"), [*keys, "__bucket"], "left_semi")
        return picked.groupBy(*keys, "value").agg(F.count("*").alias("n"))

    full = top_k_per_group(at_most, keys, [F.col("__most").desc(), F.col("__bucket").asc()], k, rank="__at")
    first = written(counted(full), "counted")
    bound = top_k_per_group(first, keys, order, k, rank="__at").where(F.col("__at") == k).select(*keys, F.col("n").alias("__least"))
    reach = join_null_safe(at_most, bound, keys).select(*at_most.columns, "__least")
    # Without a bound a key has fewer than k values in its fullest buckets, and all its buckets count.
    reach = reach.where(F.coalesce(F.col("__most") >= F.col("__least"), F.lit(True)))
    rest = join_null_safe(reach, full.select(*keys, "__bucket"), [*keys, "__bucket"], "left_anti")
    return top_k_per_group(first.unionByName(counted(rest)), keys, order, k, rank="rank")


def mode_per_group(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    best = value_ranks(df, key, [value], 1)
    return best.select(key, F.col("value").alias(name))


def agg_top_names(df: DataFrame, key: str, value: str, k: int, name: str) -> DataFrame:
    """The ``k`` most frequent values per key as one string."""
    return value_ranks(df, key, [value], k).groupBy(key).agg(top_names(value, k).alias(name))


def monthly(df: DataFrame, date: str, keys: Keys, value: str,
            fn: Callable[[str], Column]) -> DataFrame:
    """One aggregated value per month and key; rows without a date are left out."""
    dated = df.where(F.col(date).isNotNull()).withColumn("report_month", month_start(F.col(date)))
    return group_stats(dated, ["report_month", *as_list(keys)], **{value: fn(value)})


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(model, rows) of several tables."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("model"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
