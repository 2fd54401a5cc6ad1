"""SimHash near-duplicates: 64-bit fingerprints, linked through a pigeonring filter.

A fingerprint is cut into a ring of 4 segments of 16 bits. If two differ in at most 3 bits, the
ring has a segment from which every chain of 1, 2, 3 and 4 consecutive segments differs in at
most 0, 1, 2 and 3 bits (a quarter of the whole budget per segment, rounded down). The first two
steps of the chain are the join key: the first segment as it is, the second with at most one bit
changed, 32 bits in all. Every fingerprint is stored under its 4 keys and asks for 4 x 17 of
them, so work grows with the number of different fingerprints. The third step and then the full
Hamming distance are checked inside the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import components, release, row_key, saved

SEED = 42
SEGMENTS = 4
WIDTH = 16
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_COLUMN = (np.arange(8) * 256)[None, :]


def shingles(text: str | None, shingle: int) -> list[bytes]:
    """All shingles of a text in order; fewer words than a shingle are one, no words none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return []
    whole = b" ".join(words)
    if len(words) <= shingle:
        return [whole]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:-shingle].tolist()]
    return [whole[a:b] for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())]


def fingerprint_of_hashes(hashes: list[int]) -> int:
    """The signed 64-bit fingerprint of shingle hashes; 0 where there are none."""
    if not hashes:
        return 0
    by_byte = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    counts = np.bincount((by_byte + _COLUMN).ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int(np.packbits(2 * counts.ravel() > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint_of(text: str | None, shingle: int = 3) -> int:
    """The signed 64-bit fingerprint of one text; 0 where it has no words."""
    return fingerprint_of_hashes([xxhash.xxh64_intdigest(x, SEED) for x in shingles(text, shingle)])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """One row (doc_id, row, fp) per document row; row is its key by id and text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = pa.array((fingerprint_of(t.as_py(), shingle) for t in batch.column(2)), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), fps], ["doc_id", "row", "fp"])

    picked = docs.select(F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("row"), F.col(text).alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"doc_id {kind}, row string, fp bigint")


def _segment(fp: str, at: int) -> str:
    return f"(shiftrightunsigned({fp}, {WIDTH * (at % SEGMENTS)}) & {2**WIDTH - 1})"


def links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """Pairs (a, b), a > b, of different fingerprints of fps (fp) at most ``max_bits`` <= 3 bits apart."""
    if not 0 <= max_bits < SEGMENTS:
        raise ValueError(f"max_bits must be from 0 to {SEGMENTS - 1}")

    def key(at: int, second: str) -> str:
        return f"{at}L << {2 * WIDTH} | {_segment('fp', at)} << {WIDTH} | {second}"

    stored = [key(at, _segment("fp", at + 1)) for at in range(SEGMENTS)]
    asked = [f"{at}L << {2 * WIDTH} | {_segment('fp', at)} << {WIDTH} | ({_segment('fp', at + 1)} ^ {change}L)"
             for at in range(SEGMENTS) for change in (0, *(1 << bit for bit in range(WIDTH)))]
    here = fps.select(F.expr(f"explode(array({', '.join(stored)}))").alias("key"), F.col("fp").alias("b"))
    ask = fps.select(F.expr(f"explode(array({', '.join(asked)}))").alias("key"), F.col("fp").alias("a"))
    third = " ".join(f"WHEN {at} THEN bit_count({_segment('(a ^ b)', at + 1)}) + bit_count({_segment('(a ^ b)', at + 2)})"
                     for at in range(SEGMENTS))
    joined = ask.alias("l").join(here.alias("r"), F.expr(
        f"l.key = r.key AND a > b AND CASE int(shiftright(l.key, {2 * WIDTH})) {third} END <= 2"
        f" AND bit_count(a ^ b) <= {max_bits}"))
    return joined.select("a", "b").distinct()


def simhash_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                    max_bits: int = 3) -> DataFrame:
    """Near-duplicate classes of documents: (doc_id, row, fp, component_id), one row per document row.

    Words are cut at ASCII white space after lower-casing A-Z; a text with fewer words than a
    shingle is one shingle, one without words (empty, null) has fingerprint 0 and links like any
    other. component_id is the smallest doc_id of all rows reachable over links, null ids aside
    (null where a class has no other). Repeated rows stay and share their class; an empty table
    gives an empty result; other columns are not read. Links are sought between different
    fingerprints only, so copies cost nothing.
    """
    rows = saved(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    nodes = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(links(nodes.select("fp"), max_bits))
    by_fp = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = by_fp.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = saved(by_fp.join(ids, "root").select("fp", "root", "component_id"), "classes")
    release(docs.sparkSession)
    return rows.join(classes, "fp").select("doc_id", "row", "fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                         max_bits: int = 3) -> DataFrame:
    """The documents with one row of each class: the smallest doc_id, among its rows the smallest row key.

    Columns stay as they are. A null id ranks last; rows alike in id and text count as one.
    """
    classes = simhash_classes(docs, doc_id, text, shingle, max_bits)
    first = classes.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
    kept = first.select(F.col("first.row").alias("_llm_row")).distinct()
    keyed = docs.withColumn("_llm_row", row_key(doc_id, text))
    return keyed.join(kept, "_llm_row", "left_semi").dropDuplicates(["_llm_row"]).drop("_llm_row")
