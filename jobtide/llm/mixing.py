"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is cut into blocks by the hash of its documents, a random permutation that every rerun
repeats. Its target says how many block instances it gives: whole epochs of all blocks, then one more
epoch of the documents that, in the order of the blocks, still fit: a document too long for what is
left is passed over, and later ones fill the gap, or the same once more where all are in. A binary tree deals the instances out to
the output shards: a node splits in half, and how many of each source's instances go left is drawn
from the multivariate hypergeometric law, as if the node's blocks had been shuffled one by one. The
draw of many sources is itself a tree: the sources split in half, one hypergeometric draw says how
much of the left part comes from the first half, and so on down. So each level is one join of small
tables, no list of sources or blocks is collected, and the quotas of each source add up exactly.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from jobtide.llm.common import WORD, release, saved

UNIT = ["unit_a", "unit_b"]
GROUP = 4096  # blocks whose running sums one window task takes


def _uniform(*columns) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 53)) / float(1 << 53)


def _unit(doc_id: str, source: str, text: str) -> tuple[Column, Column]:
    return F.xxhash64(doc_id, source, text), F.xxhash64(text, F.lit("unit"), source, doc_id)


def ranked(df: DataFrame, order: Column, name: str) -> DataFrame:
    """df with its rank from 0 in the given order: a range sort, and the sizes of its partitions summed up."""
    cut = saved(df.repartitionByRange(order).sortWithinPartitions(order)
                .withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (cut.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
             .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))
    return (cut.withColumn("_part", part).join(F.broadcast(sizes), "_part")
            .withColumn("rank", F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)).drop("_at", "_part", "_before"))


def targets(sizes: DataFrame, weights: tuple[float, ...], most: float = 3.0) -> DataFrame:
    """(source, source_size, rank, target) of sizes (source, source_size).

    Sources in code-point order, null last, take the weights in turn and share the sum of all sizes. A target
    stops at ``most`` times its source's size; what is over goes to the others by weight, until none is above.
    Only sums come to the driver.
    """
    listed = ranked(sizes, F.col("source").asc_nulls_last(), "sources").withColumn(
        "weight", F.array(*[F.lit(float(w)) for w in weights])[F.pmod("rank", F.lit(len(weights))).cast("int")])
    listed = saved(listed.withColumn("cap", F.col("source_size") * F.lit(float(most))), "weighted")
    total = listed.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        over = F.col("weight") * level > F.col("cap") if capped >= 0 else F.lit(False)
        held, free, n = listed.agg(F.sum(F.when(over, F.col("cap")).otherwise(0.0)),
                                   F.sum(F.when(over, 0.0).otherwise(F.col("weight"))),
                                   F.sum(F.when(over, 1).otherwise(0))).first()
        if n == capped or not free:
            break
        level, capped = (total - held) / free, n
    return listed.select("source", "source_size", "rank",
                         F.least("cap", F.col("weight") * level).alias("target"))


def hypergeometric(df: DataFrame) -> DataFrame:
    """df (population, marked, drawn, u) with ``got``: how many of the drawn are marked, by inverting the law at u.

    The probabilities are built up by their ratios from the mode outwards, as far as they count in a double.
    """
    ratio_up = "(marked - k) * double(drawn - k) / ((k + 1) * double(population - marked - drawn + k + 1))"
    ratio_down = "k * double(population - marked - drawn + k) / ((marked - k + 1) * double(drawn - k + 1))"

    def walk(ks: str, ratio: str, aim: str) -> str:
        return (f"aggregate({ks}, named_struct('p', 1D, 'sum', 0D, 'got', -1L), (s, k) -> named_struct("
                f"'p', s.p * ({ratio}), 'sum', s.sum + s.p, 'got', if(s.got < 0 AND s.sum + s.p > {aim}, k, s.got)))")

    bounds = (df.withColumn("low", F.expr("greatest(0L, drawn - (population - marked))"))
              .withColumn("high", F.expr("least(drawn, marked)"))
              .withColumn("mode", F.expr("least(high, greatest(low, bigint(floor("
                                         "(drawn + 1D) * (marked + 1D) / (population + 2D)))))"))
              .withColumn("reach", F.expr("bigint(ceil(12 * sqrt(drawn * double(marked) * (population - marked)"
                                          " / greatest(1D, double(population) * population)) + 40))"))
              .withColumn("low", F.expr("greatest(low, mode - reach)"))
              .withColumn("high", F.expr("least(high, mode + reach)")))
    ups = "sequence(mode, high)"
    downs = "if(mode > low, reverse(sequence(low, mode - 1)), array())"
    # The first term below the mode, relative to the mode's.
    first = "if(mode > low, mode * double(population - marked - drawn + mode)" \
            " / ((marked - mode + 1) * double(drawn - mode + 1)), 0D)"
    sums = (bounds.withColumn("first", F.expr(first))
            .withColumn("above", F.expr(walk(ups, ratio_up, "1e300") + ".sum"))
            .withColumn("below", F.expr("first * " + walk(downs, ratio_down, "1e300") + ".sum"))
            .withColumn("aim", F.expr("u * (above + below)")))
    return (sums.withColumn("got", F.expr(
        f"if(aim < above, {walk(ups, ratio_up, 'aim')}.got, {walk(downs, ratio_down, '((aim - above) / first)')}.got)"))
        .withColumn("got", F.expr("if(got < 0, if(aim < above, high, low), got)"))
        .drop("low", "high", "mode", "reach", "first", "above", "below", "aim"))


def split_quotas(counts: DataFrame, sources: int, depth: int, seed: int) -> DataFrame:
    """(shard, rank, n): the instances of each source (rank, n) that each of 2**depth shards gets."""
    quotas = saved(counts.select(F.lit(0).cast("bigint").alias("shard"), "rank", "n"), "quotas")
    levels = max(1, math.ceil(math.log2(max(sources, 2))))
    for level in range(depth):
        here = (quotas.groupBy("shard").agg(F.sum("n").alias("population"))
                .select("shard", F.lit(0).cast("bigint").alias("part"), "population",
                        F.expr("population div 2").alias("drawn")))
        for step in range(levels - 1, -1, -1):
            first = (quotas.groupBy("shard", F.expr(f"shiftright(rank, {step})").alias("half")).agg(F.sum("n").alias("marked"))
                     .where("half % 2 = 0").select("shard", F.expr("half div 2").alias("part"), "marked"))
            split = (here.join(first, ["shard", "part"], "left").fillna(0, ["marked"])
                     .withColumn("u", _uniform(F.lit(seed), F.lit(level), F.lit(step), "shard", "part")))
            split = hypergeometric(split)
            here = split.select("shard", F.explode(F.expr(
                "array(struct(part * 2 AS part, marked AS population, got AS drawn),"
                " struct(part * 2 + 1 AS part, population - marked AS population, drawn - got AS drawn))")).alias("h")) \
                .select("shard", "h.*").where("population > 0")
        quotas = saved(here.select(F.explode(F.expr(
            "array(struct(shard * 2 AS shard, part AS rank, drawn AS n),"
            " struct(shard * 2 + 1 AS shard, part AS rank, population - drawn AS n))")).alias("q"))
            .select("q.*").where("n > 0"), "quotas")
    return quotas


def placements(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
               weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0, block_words: int = 1 << 16,
               shard_words: int = 1 << 24, seed: int = 17, near: float = 0.001,
               ) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(units, targets, last, placed): documents with size and block, the sources' targets, and where the blocks go.

    units: (unit_a, unit_b, source, rank, size, rows, block); rows alike in id, source and text are one unit.
    last: the units of the last epochs, which have part of the documents; they end when every source is within
    ``near`` of its target or has no document that fits. placed: (rank, block, epoch, shard, part): part tells the
    last epochs from the whole ones.
    """
    unit_a, unit_b = _unit(doc_id, source, text)
    size = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")
    sized = (docs.select(unit_a.alias("unit_a"), unit_b.alias("unit_b"), F.col(source).alias("source"), size.alias("size"))
             .groupBy(*UNIT, "source").agg(F.max("size").alias("size"), F.count("*").alias("rows")))
    sized = saved(sized, "sized")
    total = F.sum(F.col("size") * F.col("rows")).cast("bigint")
    aims = saved(targets(sized.groupBy("source").agg(total.alias("source_size")), weights, most), "targets")
    sources, words = aims.agg(F.count("*"), F.sum("source_size")).first()
    plan = (aims.withColumn("epochs", F.expr("bigint(if(source_size > 0, floor(target / source_size), 0))"))
            .withColumn("rest", F.expr("target - epochs * source_size"))
            .withColumn("blocks", F.expr(f"greatest(1L, bigint(ceil(source_size / {block_words})))")))
    units = saved(_with_source(sized, plan, sources).withColumn(
        "block", F.floor(_uniform(F.lit(seed), *UNIT) * F.col("blocks"))).drop("blocks"), "units")

    last = saved(fitting(units, plan, near, most), "last")
    whole = plan.where("epochs > 0").select("rank", F.explode(F.expr("sequence(0L, epochs - 1)")).alias("epoch"))
    given = (units.select("rank", "block").distinct().join(whole, "rank").withColumn("part", F.lit(False)).unionByName(
        last.select("rank", "block", "epoch").distinct().withColumn("part", F.lit(True))))
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    # The place of each instance in its source's random order, again by groups.
    given = given.withColumn("order", F.xxhash64(F.lit(seed + 1), "rank", "epoch", "block"))
    given = saved(given, "given")
    instances = given.count()
    bins = max(1, math.ceil(instances / GROUP))
    given = given.withColumn("bin", F.floor((F.col("order") / float(1 << 64) + 0.5) * bins))
    bin_sizes = (given.groupBy("rank", "bin").agg(F.count("*").alias("n"))
                 .withColumn("ahead", F.coalesce(F.sum("n").over(before("rank").orderBy("bin")), F.lit(0))).drop("n"))
    place = F.row_number().over(Window.partitionBy("rank", "bin").orderBy("order", "epoch", "block")) - 1
    order = given.join(bin_sizes, ["rank", "bin"]).withColumn("place", place + F.col("ahead"))

    depth = max(0, math.ceil(math.log2(max(1, (words or 0) / shard_words))))
    quotas = split_quotas(given.groupBy("rank").agg(F.count("*").alias("n")), sources, depth, seed + 2)
    # A row per place, so that an instance finds its shard by an equal key.
    begin = F.sum("n").over(Window.partitionBy("rank").orderBy("shard")) - F.col("n")
    spots = quotas.where("n > 0").withColumn("begin", begin).select(
        "rank", "shard", F.explode(F.expr("sequence(begin, begin + n - 1)")).alias("place"))
    placed = saved(order.join(spots, ["rank", "place"]).select("rank", "block", "epoch", "shard", "part"), "placed")
    release(docs.sparkSession)
    return units, aims, last, placed


def _with_source(sized: DataFrame, plan: DataFrame, sources: int) -> DataFrame:
    """sized with the rank and the number of blocks of its source; a null source is a source."""
    known = plan.select(F.col("source").alias("_source"), "rank", "blocks")
    return sized.join(F.broadcast(known) if sources <= 10_000 else known,
                      F.col("source").eqNullSafe(F.col("_source"))).drop("_source")


def _fit_in_order(units: DataFrame, need: DataFrame) -> DataFrame:
    """Of the units that are no longer than what their source needs (rank, need): in the order of the blocks, those
    that fit together."""
    fits = units.join(need, "rank").where("words <= need")
    blocks = fits.groupBy("rank", "block").agg(F.sum("words").alias("here"), F.first("need").alias("need"))
    grouped = saved(blocks.withColumn("group", F.floor(F.col("block") / GROUP)), "blocks")
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    # Words before each block of its source, by groups of blocks first.
    groups = (grouped.groupBy("rank", "group").agg(F.sum("here").alias("there"))
              .withColumn("ahead", F.coalesce(F.sum("there").over(before("rank").orderBy("group")), F.lit(0))).drop("there"))
    ahead = F.col("ahead") + F.coalesce(F.sum("here").over(before("rank", "group").orderBy("block")), F.lit(0))
    running = grouped.join(groups, ["rank", "group"]).withColumn("ahead", ahead).where("ahead < need")
    whole, cut = running.where("ahead + here <= need"), running.where("ahead + here > need")
    end = F.sum("words").over(Window.partitionBy("rank", "block").orderBy(*UNIT))
    # One block per source is cut: its units in order, as many as fit.
    within = fits.drop("need").join(cut.select("rank", "block", (F.col("need") - F.col("ahead")).alias("upto")), ["rank", "block"])
    within = within.withColumn("end", end).where("end <= upto")
    return fits.join(whole.select("rank", "block"), ["rank", "block"]).select(*UNIT, "rank", "block", "words").unionByName(
        within.select(*UNIT, "rank", "block", "words"))


def fitting(units: DataFrame, plan: DataFrame, near: float, most: float) -> DataFrame:
    """(unit_a, unit_b, rank, block, words, epoch): the documents of the epochs that are not whole.

    Every round leaves out what is longer than the words still needed and takes the others in order while they fit;
    so what stopped one round is left out of the next. When none is left that fits, those that do come again, up to
    ``most`` times in all. At the end one more document may come in, if the source is nearer to its target with it
    than without.
    """
    rest = units.withColumn("words", F.col("size") * F.col("rows")).where("words > 0").select(*UNIT, "rank", "block", "words")
    columns = [*UNIT, "rank", "block", "words", "epoch"]
    need = plan.select("rank", "target", "epochs", F.col("rest").alias("need"))

    def taken_now(candidates: DataFrame, short: DataFrame, extra: int) -> DataFrame:
        chosen = _fit_in_order(candidates, short.select("rank", "need")).join(short.select("rank", "epochs"), "rank")
        return saved(chosen.withColumn("epoch", F.col("epochs") + extra).select(*columns), "fitting")

    extra = 0
    first = taken_now(rest, need, extra)
    here, taken = first, first
    while True:
        got = taken.groupBy("rank").agg(F.sum("words").alias("got"))
        left = saved(need.join(got, "rank", "left").select(
            "rank", "target", "epochs", (F.col("need") - F.coalesce("got", F.lit(0))).alias("need")), "left")
        short = left.where((F.col("need") > near * F.col("target")) & (F.col("epochs") + extra + 1 <= most))
        if short.isEmpty():
            break
        more = taken_now(rest.join(here.select(*UNIT), UNIT, "left_anti"), short, extra)
        if more.isEmpty():  # all that fit are in: once more from the beginning
            extra, here = extra + 1, more
            continue
        here, taken = here.unionByName(more), taken.unionByName(more)
    others = rest.join(taken.select(*UNIT), UNIT, "left_anti").join(
        left.where((F.col("need") > near * F.col("target")) & (F.col("epochs") + 1 <= most)), "rank").where("words < 2 * need")
    best = others.groupBy("rank", "epochs").agg(F.min(F.struct("words", *UNIT, "block")).alias("b"))
    return taken.unionByName(best.select("b.unit_a", "b.unit_b", "rank", "b.block", "b.words", F.col("epochs").alias("epoch")))


def drawn(units: DataFrame, last: DataFrame, placed: DataFrame) -> DataFrame:
    """(unit_a, unit_b, epoch, shard, place): every copy of a document that the mix takes, and its place in the shard."""
    whole = units.join(placed.where("NOT part"), ["rank", "block"]).select(*UNIT, "epoch", "shard")
    copies = whole.unionByName(last.join(placed.where("part"), ["rank", "block", "epoch"]).select(*UNIT, "epoch", "shard"))
    return copies.withColumn("place", F.xxhash64("shard", "epoch", *UNIT))


def mixed_sizes(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
                **how) -> DataFrame:
    """One row per document row: (doc_id, source, size, source_size, target, taken), taken in words, repeats counted.

    A null text has size 0; a null source is a source, last in order. A document is taken whole, as often as its
    source's epochs and the rest say, never more than ``most`` times. Rows alike in id, source and text are taken
    together. A source without words has target 0. An empty table gives an empty result; other columns are not read.
    """
    units, aims, last, placed = placements(docs, doc_id, source, text, **how)
    copies = drawn(units, last, placed).groupBy(UNIT).agg(F.count("*").alias("copies"))
    unit_a, unit_b = _unit(doc_id, source, text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
                       unit_a.alias("unit_a"), unit_b.alias("unit_b"))
    taken = units.join(copies, UNIT, "left").select(*UNIT, "rank", "size", F.coalesce("copies", F.lit(0)).alias("copies"))
    taken = taken.join(aims.select("rank", "source_size", "target"), "rank")
    return rows.join(taken, UNIT).select("doc_id", "source", "size", "source_size", "target",
                                         (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", **how) -> DataFrame:
    """The mixed documents, repeats included, columns as they are: dealt to the shards and shuffled within each.

    Nulls, empty texts and repeated rows are taken as in ``mixed_sizes``; a text without words comes as often as
    its source's epochs.
    """
    units, _, last, placed = placements(docs, doc_id, source, text, **how)
    copies = drawn(units, last, placed).toDF("_llm_a", "_llm_b", "_llm_epoch", "_llm_shard", "_llm_place")
    unit_a, unit_b = _unit(doc_id, source, text)
    keyed = docs.withColumns({"_llm_a": unit_a, "_llm_b": unit_b})
    return (keyed.join(copies, ["_llm_a", "_llm_b"]).repartition("_llm_shard")
            .sortWithinPartitions("_llm_shard", "_llm_place").select(*docs.columns))
