"""Toxicity by compression distance: which of two zstandard dictionaries shortens a window more.

Two dictionaries are trained on a bounded sample of labelled texts: one on the windows that ordinary
texts are made of, one on those that stand out in toxic texts (many different contexts there, few in
ordinary ones). A window is one word between blanks, with a run of one byte on either side: every
compressor shortens the runs alike and without a dictionary, so that the block is always a compressed
one and the word's bytes alone make the difference. The distance of a window is its length under the
ordinary dictionary less that under both; toxic stems make it positive, also inside words never seen. Each
distance weighs what its share in toxic texts says against that in ordinary ones, so the many words
without any weigh a little for an ordinary text, and chance finds in a long one make no difference. The
evidence of a text is the sum of these weights over the root of its number of words, and its score a
logistic curve around a threshold. Weights and threshold come from labelled texts that the dictionaries
have not seen.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.llm.common import saved, worker_state

CACHED_WORDS = 600_000  # distances a worker remembers; only speed depends on it
STEMS = (4, 5, 6)       # leading characters that may give a toxic stem
HEADER = 256            # bytes before a trained dictionary's content, at most
BEFORE, AFTER = b"\0" * 24, b"\0" * 16


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...] = tuple(float(d) for d in range(9))  # by distance, the last one for all above
    threshold: float = 1.0
    steepness: float = 4.0


class Distance:
    """The distance of a word, remembered."""

    def __init__(self, model: Model):
        import zstandard as zs

        def compressor(content: bytes):
            how = zs.ZstdCompressionParameters(
                window_log=17, hash_log=17, chain_log=17, search_log=5, target_length=0, min_match=4,
                strategy=zs.STRATEGY_DFAST, write_content_size=False, write_checksum=False, write_dict_id=False,
                format=zs.FORMAT_ZSTD1_MAGICLESS)
            held = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(compression_params=how)
            return zs.ZstdCompressor(dict_data=held, compression_params=how).compress

        self.ordinary, self.both = compressor(model.ordinary), compressor(model.ordinary + model.toxic)
        self.known = worker_state().setdefault(f"distances-{zlib.crc32(model.ordinary)}-{zlib.crc32(model.toxic)}", {})

    def __call__(self, word: str) -> int:
        found = self.known.get(word)
        if found is None:
            if len(self.known) > CACHED_WORDS:
                self.known.clear()
            window = BEFORE + f" {word} ".encode("utf-8", "surrogatepass") + AFTER
            found = self.known[word] = len(self.ordinary(window)) - len(self.both(window))
        return found


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def distances(distance: Distance, text: str | None, most: int) -> np.ndarray:
    """How many words of a text have each distance from 0 to ``most``; lower and higher ones count at the ends."""
    found = np.fromiter(map(distance, words_of(text)), np.int64)
    return np.bincount(np.clip(found, 0, most), minlength=most + 1)


def evidence(counts: np.ndarray, weights: tuple[float, ...]) -> float:
    """The weighted distances of a text, over the root of its number of words."""
    return float(counts @ np.array(weights) / np.sqrt(counts.sum() + 1))


def probability(model: Model, found: float) -> float:
    return float(1 / (1 + np.exp(np.clip(model.steepness * (model.threshold - found), -500, 500))))


def _contexts(texts: list[str]) -> tuple[Counter, int]:
    """In how many different contexts (the word before) each word or stem stands, and how many there are."""
    pairs = set()
    for text in texts:
        words = words_of(text)
        pairs.update(zip(["", *words], words))
    counts = Counter(word for _, word in pairs)
    for n in STEMS:
        counts.update(f"{word[:n]}\0" for _, word in pairs if len(word) > n)
    return counts, max(1, len(pairs))


def train(toxic: list[str], ordinary: list[str], bytes_ordinary: int = 32768, bytes_toxic: int = 4096) -> Model | None:
    """Both dictionaries; None where the texts give no window that stands out, or too little to train on."""
    import zstandard as zs

    (here, n_here), (there, n_there) = _contexts(toxic), _contexts(ordinary)

    def stands_out(key: str) -> bool:
        a, b = here[key], there[key]
        p = (a + b) / (n_here + n_there)
        spread = (p * (1 - p) * (1 / n_here + 1 / n_there)) ** 0.5
        return a >= 3 and a / n_here > 4 * b / n_there and (a / n_here - b / n_there) > 5 * spread

    chosen = {key for key in here if stands_out(key)}
    picks = lambda w: w in chosen or any(f"{w[:n]}\0" in chosen for n in STEMS)
    loud = sorted((w for t in toxic for w in words_of(t) if picks(w)), key=lambda w: zlib.crc32(w.encode("utf-8", "replace")))
    # Neighbours in the order of a hash would be equal words; a stride mixes them.
    step = max(1, int(len(loud) ** 0.5))
    loud = [w for i in range(step) for w in loud[i::step]]
    plain = [w for t in ordinary for w in words_of(t) if not picks(w)]
    pack = lambda words: [" ".join(["", *words[i:i + 8], ""]).encode("utf-8", "surrogatepass") for i in range(0, len(words), 8)]
    try:
        base = zs.train_dictionary(bytes_ordinary, pack(plain), d=6, k=50).as_bytes()[HEADER:]
    except zs.ZstdError:
        return None
    try:
        extra = zs.train_dictionary(bytes_toxic, pack(loud), d=6, k=32).as_bytes()[HEADER:]
    except zs.ZstdError:  # too few windows to choose among: all of them are the dictionary
        extra = " ".join(["", *sorted(set(loud)), ""]).encode("utf-8", "surrogatepass")[:bytes_toxic]
    return Model(base, extra) if chosen and len(base) > 200 else None


def calibrate(model: Model, toxic: list[str], ordinary: list[str], words: int = 400) -> Model:
    """Weights, the threshold that tells the texts apart best by balanced accuracy, and the steepness around it.

    A weight is the logarithm of the ratio of a distance's shares in toxic and ordinary texts, in which a text counts
    as one of ``words`` words at most; larger distances never weigh less. Of equally good thresholds the one in the
    middle of the widest gap counts.
    """
    distance, most = Distance(model), len(model.weights) - 1
    counts = [[distances(distance, t, most) for t in texts] for texts in (ordinary, toxic)]
    shares = []
    for texts in counts:
        total = sum((c / c.sum() * min(c.sum(), words) for c in texts if c.sum()), np.zeros(most + 1)) + 0.5
        shares.append(total / total.sum())
    model.weights = tuple(np.maximum.accumulate(np.log(shares[1] / shares[0])).tolist())
    low, high = (np.sort([evidence(c, model.weights) for c in texts]) for texts in counts)
    values = np.unique(np.concatenate((low, high)))
    right = lambda a, b: round(np.mean(low <= a) + np.mean(high >= b), 9)
    cuts = [(right(a, b), b - a, (a + b) / 2) for a, b in zip(values[:-1], values[1:])]
    if cuts:
        model.threshold = max(0.01, float(max(cuts)[2]))
    model.steepness = float(4 / max(0.05, np.median(high) - model.threshold)) if len(high) else model.steepness
    return model


def held_out(doc_id: str) -> Column:
    """Rows kept from learning: the crc32 of the id as text is divisible by 5; a null id is not among them."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        per_class: int = 2400, most_chars: int = 40_000) -> Model | None:
    """Learn from at most ``per_class`` labelled texts of each class, of at most ``most_chars`` characters each.

    The sample is that of the smallest hashes of ids among the rows not held out: two thirds train the dictionaries,
    one third calibrates. Rows labelled twice count as toxic if one label says so; null labels do not count.
    """
    known = (labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & ~held_out(doc_id))
             .groupBy(F.col(doc_id).alias("_id")).agg((F.max(label) > 0).alias("bad")))
    lengths = docs.where(F.length(text) <= most_chars).select(F.col(doc_id).alias("_id")).distinct()
    listed = saved(known.join(lengths, "_id"), "labelled")
    picked = [listed.where(F.col("bad") == bad).orderBy(F.xxhash64("_id"), "_id").limit(per_class) for bad in (True, False)]
    sample = saved(picked[0].unionByName(picked[1]), "picked")
    texts = saved(docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("text")).where(F.length("text") <= most_chars)
                  .join(F.broadcast(sample), "_id").groupBy("_id").agg(F.max("bad").alias("bad"), F.min("text").alias("text")), "sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r["_id"] if isinstance(r["_id"], int) else str(r["_id"]), r["bad"], r["text"])
                      for b in batches for r in b.to_pylist())
        part = {(bad, use): [t for i, (_, x, t) in enumerate(rows) if x == bad and (i % 3 == 2) == use]
                for bad in (True, False) for use in (True, False)}
        model = train(part[True, False], part[False, False]) if part[True, False] and part[False, False] else None
        if model is not None and part[True, True] and part[False, True]:
            model = calibrate(model, part[True, True], part[False, True])
        yield pa.RecordBatch.from_pylist([] if model is None else [vars(model)], pa.schema(
            [("ordinary", pa.binary()), ("toxic", pa.binary()), ("weights", pa.list_(pa.float64())),
             ("threshold", pa.float64()), ("steepness", pa.float64())]))

    made = texts.coalesce(1).mapInArrow(
        run, "ordinary binary, toxic binary, weights array<double>, threshold double, steepness double").collect()
    return Model(bytes(made[0][0]), bytes(made[0][1]), tuple(made[0][2]), made[0][3], made[0][4]) if made else None


def score(docs: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: (doc_id, evidence, score), over whole texts.

    A null or empty text has no windows and evidence 0; without a model all scores are 0. Repeated rows each get their score;
    an empty table gives an empty result; only id and text are read.
    """
    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distance, most = (Distance(model), len(model.weights) - 1) if model else (None, 0)
        for batch in batches:
            found = [evidence(distances(distance, t.as_py(), most), model.weights) if model else 0.0 for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.float64()),
                 pa.array([probability(model, e) if model else 0.0 for e in found], pa.float64())],
                ["doc_id", "evidence", "score"])

    return picked.mapInArrow(run, f"doc_id {kind}, evidence double, score double")
