"""How far the sources of a language diverge in their words, from count-level bitmaps.

Each language keeps the terms of at least 30 of its documents. The terms that a (language, source) group has the same
number of times have the same smoothed share there, so a group is a few levels, each a bitset of term ids. For two
groups AND and popcount of a level of each give the number of terms in that joint cell, which is multiplied by the
difference of the two shares; terms a group lacks are the complement of its levels.

Ids are dense within chunks of about 512 terms of like frequency, and bitsets are words of 64 ids, so that a word has
few levels. A task handles one chunk of two blocks of about 32 groups, so it holds a bounded part of any language,
however many sources and terms that has.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.common import saved

TERM = re.compile(rb"[a-z\x80-\xff]+")  # of lower-cased UTF-8: all but ASCII without its letters
SCALE, ADDED = 1_000_000_000, 5
CHUNK, BLOCK = 512, 32
_FLUSH = 1 << 17  # terms that a task counts before it passes them on


def term_counts(docs: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    """(lang, source, term, count, docs): occurrences and documents of each term in each group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict = defaultdict(lambda: (Counter(), Counter()))

        def passed_on() -> Iterator[pa.RecordBatch]:
            for (one, other), (counts, there) in found.items():
                terms = list(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(one, pa.string()), len(terms)), pa.repeat(pa.scalar(other, pa.string()), len(terms)),
                     pa.array(terms, pa.binary()).cast(pa.string()), pa.array(counts.values(), pa.int64()),
                     pa.array(map(there.__getitem__, terms), pa.int64())], ["lang", "source", "term", "count", "docs"])
            found.clear()

        held = 0
        for batch in batches:
            for one, other, body in zip(*(batch.column(i).to_pylist() for i in range(3))):
                counts, there = found[one, other]
                before, terms = len(counts), TERM.findall(body.lower())
                counts.update(terms)
                there.update(set(terms))
                held += len(counts) - before
                if held > _FLUSH:
                    yield from passed_on()
                    held = 0
        yield from passed_on()

    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    picked = docs.select(filled(lang).alias("lang"), filled(source).alias("source"), filled(text).cast("binary").alias("text"))
    parts = picked.mapInArrow(run, "lang string, source string, term string, count bigint, docs bigint")
    return parts.groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def share(count: str, total: str, terms: str) -> Column:
    """The smoothed share 1 + floor(SCALE * (count + ADDED) / (total + ADDED * terms)) in whole numbers; 1 without terms."""
    return F.expr(f"coalesce((cast({count} + {ADDED} as decimal(20, 0)) * {SCALE})"
                  f" div nullif(cast({total} + {ADDED} * {terms} as decimal(20, 0)), 0), 0) + 1")


def kept_terms(counts: DataFrame, least_docs: int) -> DataFrame:
    """(lang, term, total, chunk, place): the kept terms, each with its place in a chunk of terms of like frequency."""
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("count").alias("total"))
    kept = kept.where(F.col("docs") >= least_docs).withColumn("size", F.length(F.bin("total")))
    sizes = kept.groupBy("lang", "size").agg(F.ceil(F.count("*") / CHUNK).alias("parts"))
    dealt = kept.join(sizes, ["lang", "size"]).withColumn(
        "chunk", F.col("size") * F.lit(1 << 40) + F.pmod(F.xxhash64("term"), F.col("parts")))
    place = F.row_number().over(Window.partitionBy("lang", "chunk").orderBy("term")) - 1
    return dealt.select("lang", "term", "total", "chunk", place.alias("place"))


def level_bitsets(group: np.ndarray, rows: dict, n: int, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """(bitsets, shares) of the levels of all groups in a chunk of n terms, by group, word of 64 terms and level.

    The last level has the terms that a group lacks, the complement of its others.
    """
    words = -(-n // 64)
    here = rows["word"] >= 0
    at, word, p = group[here], rows["word"][here], rows["p"][here]
    order = np.lexsort((p, word, at))
    place = (at * words + word)[order]
    nth = np.arange(len(place)) - np.searchsorted(place, place)  # of the levels in its group and word
    levels = int(nth.max(initial=-1)) + 2
    bits, shares = np.zeros((groups, words, levels), np.uint64), np.zeros((groups, words, levels), np.int64)
    bits[at[order], word[order], nth] = rows["bits"][here][order].view(np.uint64)
    shares[at[order], word[order], nth] = p[order]
    whole = np.full(words, ~np.uint64(0))
    if n % 64:
        whole[-1] = np.uint64((1 << n % 64) - 1)
    bits[:, :, -1] = whole & ~np.bitwise_or.reduce(bits[:, :, :-1], axis=2)
    shares[group[~here], :, -1] = rows["p"][~here][:, None]
    return bits, shares


def _tile(table: pa.Table) -> pa.Table:
    """The part of one chunk in the distances between the groups of two blocks (or within one)."""
    rows = {c: table.column(c).to_numpy() for c in ("p", "word", "bits", "block")}
    names, group = np.unique(np.array(table.column("source").to_pylist(), object), return_inverse=True)
    n = int(rows["bits"][rows["word"] < 0][0])  # a row without a word tells the share of absent terms and n
    bits, shares = level_bitsets(group, rows, n, len(names))
    block = np.zeros(len(names), np.int64)
    block[group] = rows["block"]
    lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
    found = []
    for i in np.flatnonzero(block == lo):
        others = np.flatnonzero(block == hi)
        others = others[others > i] if lo == hi else others
        if not len(others):
            continue
        # All joint cells of a level of one group and a level of another, and the difference of their shares.
        cells = np.bitwise_count(bits[i][None, :, :, None] & bits[others][:, :, None, :])
        apart = np.abs(shares[i][None, :, :, None] - shares[others][:, :, None, :])
        found += zip([names[i]] * len(others), names[others], np.einsum("owij,owij->o", cells, apart, dtype=np.int64).tolist())
    lang = table.column("lang")[0].as_py()
    return pa.table({"lang": pa.array([lang] * len(found), pa.string()), "source": pa.array([f[0] for f in found], pa.string()),
                     "item": pa.array([f[1] for f in found], pa.string()), "value": pa.array([f[2] for f in found], pa.int64())})


def pair_distances(levels: DataFrame, groups: DataFrame, chunks: DataFrame) -> DataFrame:
    """(lang, source, item, value) of all ordered pairs of groups of a language."""
    blocks = groups.groupBy("lang").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    dealt = saved(groups.join(blocks, "lang").withColumn("block", F.pmod(F.xxhash64("source"), F.col("blocks"))), "groups")
    absent = dealt.join(chunks, "lang").select(
        "lang", "source", "chunk", share("0", "n", "v").alias("p"), F.lit(-1).cast("bigint").alias("word"),
        F.col("terms").alias("bits"), "block", "blocks")
    rows = absent.unionByName(levels.join(dealt.select("lang", "source", "block", "blocks"), ["lang", "source"]).select(
        "lang", "source", "chunk", "p", "word", "bits", "block", "blocks"))
    tiles = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))).select(
        "lang", "chunk", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
        "source", "block", "p", "word", "bits")
    parts = tiles.groupBy("lang", "chunk", "lo", "hi").applyInArrow(_tile, "lang string, source string, item string, value bigint")
    once = saved(parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")), "pairs")
    # Languages without terms: no chunk, every distance is 0.
    bare = dealt.where("v = 0").select("lang", "source")
    zero = bare.join(bare.withColumnRenamed("source", "item"), "lang").where("source <> item")
    return once.unionByName(once.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")) \
        .unionByName(zero.withColumn("value", F.lit(0).cast("bigint")))


def source_divergence(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
                      least_docs: int = 30, top: int = 50) -> DataFrame:
    """(lang, source, part, item, value, rank): distances between the sources of a language, and their own terms.

    Terms are runs of letters and non-ASCII characters, A-Z lower-cased; a language keeps those of ``least_docs`` of
    its document rows or more. A group's share of a term is :func:`share` of its count. Part 'pair' has every other
    source of the language with the sum of the differences of shares over the kept terms, nearest last; part 'term'
    the ``top`` terms whose share is furthest above the language's. Ties go to the smaller item in UTF-8 order. Null
    languages, sources and texts count as ''; a group without terms still has its pairs; repeated rows count each
    time; an empty table gives an empty result; other columns are not read.
    """
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    counts = saved(term_counts(docs, lang, source, text), "counts")
    terms = saved(kept_terms(counts, least_docs), "terms")
    cells = saved(counts.drop("docs").join(terms, ["lang", "term"]), "cells")
    langs = terms.groupBy("lang").agg(F.sum("total").alias("lang_n"), F.count("*").alias("v"))
    sums = cells.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = docs.select(filled(lang).alias("lang"), filled(source).alias("source")).distinct()
    groups = saved(groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0), "groups")
    shares = cells.join(groups, ["lang", "source"]).withColumn("p", share("count", "n", "v"))
    levels = saved(shares.groupBy("lang", "source", "chunk", "count", "p", F.expr("bigint(place div 64)").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, place % 64)")).alias("bits")), "levels")
    chunks = terms.groupBy("lang", "chunk").agg(F.count("*").alias("terms"))
    pairs = pair_distances(levels, groups, chunks)
    over = shares.withColumn("value", F.col("p") - share("total", "lang_n", "v")).where("value > 0")
    over = over.select("lang", "source", F.col("term").alias("item"), "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = over.withColumn("rank", rank).where(F.col("rank") <= top).withColumn("part", F.lit("term"))
    return ranked.unionByName(pairs.withColumn("rank", rank).withColumn("part", F.lit("pair"))).select(
        "lang", "source", "part", "item", "value", "rank")
