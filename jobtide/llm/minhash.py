"""MinHash near-duplicates: circulant signatures, banding, exact Jaccard similarity.

A document's set holds its distinct shingles, as 64-bit hashes folded to positions of a universe of 2^22. Two
permutations of that universe make the whole signature: the first scatters the positions, the second is read at
position + 0, + 1, ..., so coordinate k is the least value of the second one shifted by k. With the shifts side by
side in memory, a shingle costs one contiguous slice. 48 bands of 8 coordinates: a pair at similarity 0.85 shares no
band with probability 2.3e-7. Folding only ever adds candidates, and the sets of 64-bit hashes decide every link.

No band is paired off. First each text is held against the smallest of each of its bands. Where texts of a band are
then still in different classes, their shingles are put in one order, rare ones first; a pair at the wanted
similarity meets in the first few of them, near enough to their beginnings. Each list of texts under such a shingle
has its first 1, then 32, 1024, ... texts held against those of other classes, which decides these for good and takes
them out; lists of one class are closed. A pair becomes a row only if the parities of two sets' shingles over 512 hash
buckets differ in no more places than the sets may: each shingle that one set alone has turns one parity round, so
this never loses a link. A group of near copies so costs rows in proportion to its size.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobtide.llm.common import components, release, row_key, saved, worker_state
from jobtide.llm.simhash import SEED, shingles

BANDS, IN_BAND = 48, 8
COORDINATES = BANDS * IN_BAND
UNIVERSE = 1 << 22
GROWTH = 32  # how many times more texts of a list each round tries
PARITIES = 8  # longs of parities
_AT = 1 << 10  # shingles at a time: bounds the memory of a long text
_MIX = np.random.default_rng(SEED).integers(1, 1 << 63, (BANDS, IN_BAND + 1), np.uint64) * np.uint64(2) + np.uint64(1)


def permutations() -> tuple[np.ndarray, np.ndarray]:
    """The first permutation, and all windows of the second one continued in a circle; made once per worker."""
    state = worker_state()
    if "circulant" not in state:
        draw = np.random.default_rng(SEED)
        first = draw.permutation(UNIVERSE).astype(np.int32)
        second = draw.permutation(UNIVERSE).astype(np.int32)
        circle = np.concatenate([second, second[:COORDINATES - 1]])
        state["circulant"] = first, sliding_window_view(circle, COORDINATES)
    return state["circulant"]


def hash_set(text: str | None, shingle: int) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted."""
    return np.unique(np.array([xxhash.xxh64_intdigest(x, SEED) for x in shingles(text, shingle)], np.uint64))


def signature(hashes: np.ndarray) -> np.ndarray:
    """The COORDINATES least values of a set that is not empty."""
    first, windows = permutations()
    places = first[(hashes & np.uint64(UNIVERSE - 1)).astype(np.int64)]
    least = np.full(COORDINATES, UNIVERSE, np.int32)
    for begin in range(0, len(places), _AT):
        np.minimum(least, windows[places[begin:begin + _AT]].min(axis=0), out=least)
    return least


def band_keys(hashes: np.ndarray) -> list[int]:
    """One signed 64-bit key per band; none for an empty set."""
    if not len(hashes):
        return []
    coordinates = signature(hashes).astype(np.uint64).reshape(BANDS, IN_BAND)
    return ((coordinates * _MIX[:, 1:]).sum(axis=1, dtype=np.uint64) + _MIX[:, 0]).view(np.int64).tolist()


def signed(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """One row (doc_id, row, node, n, keys) per document row; node names its set, null where that is empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [hash_set(t.as_py(), shingle) for t in batch.column(2)]
            nodes = [blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(nodes, pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([band_keys(s) for s in sets], pa.list_(pa.int64()))],
                ["doc_id", "row", "node", "n", "keys"])

    picked = docs.select(F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("row"), F.col(text).alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"doc_id {kind}, row string, node binary, n bigint, keys array<bigint>")


def parities(hashes: np.ndarray) -> np.ndarray:
    """How many hashes fall into each of 64 * PARITIES buckets, modulo 2, as signed 64-bit integers."""
    odd = np.bincount((hashes >> np.uint64(40)).astype(np.int64) % (64 * PARITIES), minlength=64 * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def hash_sets(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """The sets (node, hashes, odd) of the wanted nodes (node, row), odd their parities."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [hash_set(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                 pa.array([parities(s) for s in sets], pa.list_(pa.int64()))], ["node", "hashes", "odd"])

    texts = docs.select(row_key(doc_id, text).alias("row"), F.col(text).alias("text"))
    texts = texts.join(wanted, "row").dropDuplicates(["node"]).select("node", "text")
    return texts.mapInArrow(run, "node binary, hashes array<bigint>, odd array<bigint>")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are alike: 100 times their intersection is ``percent`` times their union or more.

    A text with very many partners is a hot key of the join, which adaptive execution splits by its size.
    """
    both = pairs
    for at in ("a", "b"):
        both = both.join(sets.select(F.col("node").alias(at), F.col("hashes").alias(f"set_{at}")), at)
    shared = F.size(F.array_intersect("set_a", "set_b"))
    both = both.select("a", "b", shared.alias("shared"), (F.size("set_a") + F.size("set_b")).alias("together"))
    return both.where(F.col("shared") * (100 + percent) >= F.col("together") * percent).select("a", "b")


def _pair(left: str, right: str) -> list:
    return [F.greatest(left, right).alias("a"), F.least(left, right).alias("b")]


def first_shingles(sets: DataFrame, percent: int) -> DataFrame:
    """Lists (token, node, n, odd, at): the shingles of each set, rarest first, that a similar set must share one of.

    ``at`` is the place of the shingle in its set, from 0. Shingles of one set alone are left out.
    """
    tokens = sets.select("node", F.size("hashes").alias("n"), F.explode("hashes").alias("token"))
    common = tokens.groupBy("token").agg(F.count("*").alias("df"))
    rare_first = Window.partitionBy("node").orderBy("df", "token")
    placed = tokens.join(common, "token").withColumn("at", F.row_number().over(rare_first) - 1)
    # n - at shingles are left from there, and percent of n must be shared.
    near = placed.where(f"df > 1 AND 100 * (n - at) >= {percent} * n").select("token", "node", "n", "at")
    # More of them, if no set in the list is so small that it could be as alike as that.
    smallest = near.groupBy("token").agg(F.min("n").alias("smallest"))
    near = near.join(smallest, "token").where(
        f"{100 + percent} * (n - at) >= {percent} * (n + greatest(smallest, ceil({percent} * n / 100.0)))").drop("smallest")
    return near.join(sets.select("node", "odd"), "node").select("token", "node", "n", "odd", "at")


def links(nodes: DataFrame, docs: DataFrame, doc_id: str, text: str, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) between nodes (node, row, n, keys) that join the same classes as all similar pairs would."""
    bands = nodes.select("node", "row", "n", F.explode("keys").alias("key"))
    firsts = bands.groupBy("key").agg(F.min(F.struct("node", "n")).alias("first"), F.count("*").alias("size"))
    star = saved(bands.join(firsts.where("size > 1").drop("size"), "key"), "bands")
    sets = saved(hash_sets(docs, star.select("node", "row").distinct(), doc_id, text, shingle), "sets")
    star = star.where("node <> first.node")
    alike = f"100 * least(n, first.n) >= {percent} * greatest(n, first.n)"
    tried = star.where(alike).select(*_pair("node", "first.node")).distinct()
    linked = saved(verified(tried, sets, percent), "linked")
    roots = components(linked)

    # Texts of a band that its first one left in different classes.
    placed = star.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    mixed = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    undecided = saved(placed.join(mixed, "key", "left_semi").select("node").distinct(), "undecided")
    lists = saved(first_shingles(sets.join(undecided, "node", "left_semi"), percent), "lists")
    tries = 1
    # What only one of two sets has: a similar pair has few of these, and as many or fewer parities differ.
    apart = " + ".join(f"bit_count(l.odd[{i}] ^ r.odd[{i}])" for i in range(PARITIES))
    while True:
        lists = lists.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        mixed = lists.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
        lists = saved(lists.join(mixed, "token", "left_semi"), "lists")
        if lists.isEmpty():
            break
        rank = F.row_number().over(Window.partitionBy("token").orderBy("at", "node"))
        tested = saved(lists.withColumn("rank", rank).where(F.col("rank") <= tries).drop("rank"), "tested")
        met = lists.alias("l").join(tested.alias("r"), F.expr(
            "l.token = r.token AND l.root <> r.root"
            f" AND 100 * least(l.n, r.n) >= {percent} * greatest(l.n, r.n)"
            f" AND {100 + percent} * least(l.n - l.at, r.n - r.at) >= {percent} * (l.n + r.n)"
            f" AND {100 + percent} * ({apart}) <= {100 - percent} * (l.n + r.n)"))
        more = saved(verified(met.select(*_pair("l.node", "r.node")).distinct(), sets, percent), "more")
        if not more.isEmpty():
            linked = linked.unionByName(more)
            roots = components(linked)
        lists = lists.join(tested, ["token", "node"], "left_anti").drop("root")
        tries *= GROWTH
    return linked


def minhash_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 5,
                    percent: int = 85) -> DataFrame:
    """Near-duplicate classes: (doc_id, row, n, component_id), one row per document row.

    Words are cut at ASCII white space after lower-casing A-Z; a text with fewer words than a shingle is one shingle.
    Texts are linked whose sets of distinct shingles have ``percent`` of their union in common; component_id is the
    smallest doc_id of all rows reachable, null ids aside (null where a class has no other). A text without words
    (empty, null) has n = 0, is linked with nothing and keeps its own id. Repeated rows stay and share their class,
    texts with equal sets are one node; an empty table gives an empty result; other columns are not read.
    """
    rows = saved(signed(docs, doc_id, text, shingle), "signed")
    nodes = saved(rows.where("n > 0").groupBy("node").agg(
        F.min("row").alias("row"), F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("keys").alias("keys")),
        "nodes")
    roots = components(links(nodes, docs, doc_id, text, shingle, percent))
    placed = nodes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = saved(placed.join(ids, "root").select("node", "component_id"), "classes")
    release(docs.sparkSession)
    return rows.join(classes, "node", "left").select(
        "doc_id", "row", "n", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
