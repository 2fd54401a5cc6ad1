"""Exact repeated spans: a compacted de Bruijn graph over word k-mers.

An edge is a window of k consecutive words. Edges that follow one another in a text and share
the place of their smallest inner m-mer (the minimizer, chosen from the window's words alone) form
a piece, a path that is compacted before any shuffle. Equal windows have equal minimizers at equal
offsets, so a window that repeats lies in two pieces of one minimizer, and pieces are the rows that
Spark moves:

1. Pieces are counted by (minimizer, content). A minimizer that occurs once holds no repeated
   window; its pieces end here.
2. Where all pieces of a minimizer have the same content, the path does not branch: the piece
   repeats as a whole if it occurs twice.
3. Where a minimizer has different pieces, the path branches. One occurrence of each content is
   opened at its source coordinates into single edges, which are counted again within the minimizer.
4. A join brings the repeated edges back to the coordinates of all pieces, and neighbouring
   edges of a document compact into its spans.

Contents are compared by SHA-256 (128 bits of it) of the words at their source coordinates, so
two spans count as equal only if their words are. Rolling hashes serve the minimizers alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import release, row_hash, saved

CHUNK = 1 << 20  # words that the rolling hashes take at a time
_MULTIPLIER = 0x9E3779B97F4A7C15
_RANDOM = np.random.default_rng(7).integers(0, 2**64, 256, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(max(n - 1, 0), base, np.uint64))))


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The polynomial hash of values[start:end] for all spans at once, modulo 2**64."""
    n = len(values)
    total = np.concatenate(([np.uint64(0)], np.cumsum(values * _powers(_MULTIPLIER, n), dtype=np.uint64)))
    back = _powers(pow(_MULTIPLIER, -1, 2**64), n + 1)
    return (total[ends] - total[starts]) * back[starts]


class Words:
    """The words of one text: their bytes joined by one space, and where each begins and ends."""

    def __init__(self, text: str | None):
        words = (text or "").encode("utf-8", "surrogatepass").split()
        self.whole = b" ".join(words)
        self.ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        self.starts = np.concatenate(([0], self.ends[:-1] + 1)).astype(np.int64) if words else self.ends

    def __len__(self) -> int:
        return len(self.ends)

    def hashes(self, begin: int, end: int) -> np.ndarray:
        """A 64-bit hash of each word from begin to end."""
        low = int(self.starts[begin])
        content = np.frombuffer(self.whole, np.uint8)[low:int(self.ends[end - 1])]
        return _mixed(_sums(_RANDOM[content], self.starts[begin:end] - low, self.ends[begin:end] - low))

    def digest(self, begin: int, end: int) -> bytes:
        return hashlib.sha256(self.whole[int(self.starts[begin]):int(self.ends[end - 1])]).digest()[:16]


def pieces(words: Words, k: int, m: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(minimizer, first window, windows) of the pieces of a text; chunks bound the memory, and cut no window."""
    windows = len(words) - k + 1
    for begin in range(0, windows, CHUNK):
        count = min(CHUNK, windows - begin)
        hashed = words.hashes(begin, begin + count + k - 1)
        at = np.arange(len(hashed) - m + 1)
        least = _mixed(_sums(hashed, at, at + m))
        inner, span, place = k - m + 1, 1, at
        while span < inner:  # the leftmost least of `span` neighbours, doubled as far as it goes
            step = min(span, inner - span)
            right = least[step:] < least[:-step]
            least, place = np.where(right, least[step:], least[:-step]), np.where(right, place[step:], place[:-step])
            span += step
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(place)) + 1, [count]))
        yield least[cuts[:-1]].view(np.int64), cuts[:-1] + begin, np.diff(cuts)


def _piece_rows(docs: DataFrame, k: int, m: int) -> DataFrame:
    """(minimizer, content_a, content_b, row_a, row_b, first, windows): every piece of docs (row_a, row_b, text)."""
    names = ["minimizer", "content_a", "content_b", "row_a", "row_b", "first", "windows"]

    def table(parts: list[tuple]) -> pa.RecordBatch:
        lengths = [len(p[2]) for p in parts]
        content = np.frombuffer(b"".join(p[3] for p in parts), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([p[2] for p in parts])), pa.array(content[:, 0].copy()), pa.array(content[:, 1].copy()),
            pa.array(np.repeat([p[0] for p in parts], lengths)), pa.array(np.repeat([p[1] for p in parts], lengths)),
            pa.array(np.concatenate([p[4] for p in parts]).astype(np.int32)),
            pa.array(np.concatenate([p[5] for p in parts]).astype(np.int32))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for row_a, row_b, text in zip(*(batch.column(i) for i in range(3))):
                words = Words(text.as_py())
                for minimizer, first, count in pieces(words, k, m):
                    starts, ends = words.starts[first].tolist(), words.ends[first + count + k - 2].tolist()
                    whole, digest = words.whole, hashlib.sha256
                    content = b"".join([digest(whole[a:b]).digest()[:16] for a, b in zip(starts, ends)])
                    parts.append((row_a.as_py(), row_b.as_py(), minimizer, content, first, count))
                    held += len(first)
                    if held > 100_000:
                        yield table(parts)
                        parts, held = [], 0
        if parts:
            yield table(parts)

    return docs.select("row_a", "row_b", "text").mapInArrow(
        run, "minimizer bigint, content_a bigint, content_b bigint, row_a bigint, row_b bigint, first int, windows int")


def _opened(texts: DataFrame, k: int) -> DataFrame:
    """(piece, n, at, edge_a, edge_b): the single edges of the pieces listed with each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, listed in zip(batch.column(0), batch.column(1)):
                words = Words(text.as_py())
                out = [((*p["piece"].values(), p["n"], at), words.digest(p["first"] + at, p["first"] + at + k))
                       for p in listed.as_py() for at in range(p["windows"])]
                for begin in range(0, len(out), 50_000):
                    keys, edges = zip(*out[begin:begin + 50_000])
                    edges = np.frombuffer(b"".join(edges), np.int64).reshape(-1, 2)
                    yield pa.RecordBatch.from_arrays(
                        [*map(pa.array, np.array(keys, np.int64).T.copy()), *map(pa.array, edges.T.copy())],
                        ["minimizer", "content_a", "content_b", "n", "at", "edge_a", "edge_b"])

    return texts.mapInArrow(run, "minimizer bigint, content_a bigint, content_b bigint, n bigint, at bigint,"
                                 " edge_a bigint, edge_b bigint")


def repeated_pieces(docs: DataFrame, k: int = 35, m: int = 16) -> DataFrame:
    """(row_a, row_b, marks) of docs (row_a, row_b, text): the pieces of a text with repeated windows, as (first, mask).

    Bit i of a mask stands for the window that begins i words after ``first``.
    """
    piece, row = ["minimizer", "content_a", "content_b"], ["row_a", "row_b"]
    counted = saved(_piece_rows(docs, k, m).groupBy(piece).agg(F.count("*").alias("n")), "pieces")
    release(docs.sparkSession)
    met = (counted.groupBy("minimizer").agg(F.sum("n").alias("all"), F.count("*").alias("contents"))
           .where("all > 1").drop("all"))
    known = saved(counted.join(met, "minimizer"), "known")
    placed = saved(_piece_rows(docs, k, m).join(known, piece), "placed")
    release(docs.sparkSession)

    branching = (placed.where("contents > 1").groupBy(piece)
                 .agg(*[F.first(c).alias(c) for c in ("n", *row, "first", "windows")])
                 .groupBy(row).agg(F.collect_list(F.struct(
                     F.struct(piece).alias("piece"), "n", "first", "windows")).alias("listed")))
    sources = docs.join(branching, row).dropDuplicates(row).select("text", "listed")
    edges = saved(_opened(sources, k), "edges")
    release(docs.sparkSession)
    edge = ["minimizer", "edge_a", "edge_b"]
    twice = edges.groupBy(edge).agg(F.sum("n").alias("all")).where("all > 1").drop("all")
    parts = edges.join(twice, edge, "left_semi").groupBy(piece).agg(F.sum(F.expr("shiftleft(1L, int(at))")).alias("mask"))
    whole = known.where("contents = 1").select(*piece, F.lit(-1).cast("bigint").alias("mask"))
    repeated = saved(whole.unionByName(parts), "repeated")
    release(docs.sparkSession)
    mask = F.expr("mask & (shiftleft(1L, windows) - 1)").alias("mask")
    return (placed.join(repeated, piece).select(*row, "first", mask)
            .groupBy(row).agg(F.collect_set(F.struct("first", "mask")).alias("marks")))


def covered(n_words: int, marks: list[dict], k: int) -> np.ndarray:
    """Which words a repeated window covers."""
    change = np.zeros(n_words + 1, np.int64)
    if marks:
        bits = (np.array([m["mask"] for m in marks])[:, None] >> np.arange(62)) & 1
        piece, at = np.nonzero(bits)
        starts = np.array([m["first"] for m in marks])[piece] + at
        np.add.at(change, starts, 1)
        np.add.at(change, starts + k, -1)
    return np.cumsum(change[:-1]) > 0


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 35, m: int = 16) -> DataFrame:
    """Remove words covered by a window of k words that also starts anywhere else, same text included.

    One row per document row: (doc_id, n_words, n_removed, kept, spans); kept holds the words left,
    joined by one space; spans the removed stretches as (first word, end), compacted. Words are cut at
    ASCII white space and compared as they are; windows are judged on the input. A null or empty text
    has no words and gives kept "". Repeated rows are copies of each other like any other two rows. An
    empty table gives an empty result; other columns are not read.
    """
    if not 0 < m <= k < m + 62:
        raise ValueError("m must be from k - 61 to k")
    row_a, row_b = row_hash(doc_id, text)
    keyed = docs.select(F.col(doc_id).alias("doc_id"), row_a.alias("row_a"), row_b.alias("row_b"),
                        F.col(text).alias("text"))
    marks = repeated_pieces(keyed, k, m)
    kind = keyed.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_kept(t.as_py(), m.as_py() or [], k) for t, m in zip(batch.column(1), batch.column(2))]
            n_words, n_removed, kept, spans = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.string()),
                 pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))],
                ["doc_id", "n_words", "n_removed", "kept", "spans"])

    return (keyed.join(marks, ["row_a", "row_b"], "left").select("doc_id", "text", "marks")
            .mapInArrow(run, f"doc_id {kind}, n_words bigint, n_removed bigint, kept string,"
                             " spans array<struct<first: bigint, end: bigint>>"))


def _kept(text: str | None, marks: list[dict], k: int) -> tuple[int, int, str, list[dict]]:
    words = (text or "").encode("utf-8", "surrogatepass").split()
    gone = covered(len(words), marks, k)
    edge = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
    spans = [{"first": a, "end": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]
    left = [w for w, g in zip(words, gone.tolist()) if not g] if spans else words
    return len(words), len(words) - len(left), b" ".join(left).decode("utf-8", "surrogatepass"), spans
