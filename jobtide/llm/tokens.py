"""Token files: Parquet with one list of token ids per document, in document order.

The ids are a list column, dictionary-encoded (version 2 pages fall back to delta encoding where a
dictionary grows too large); the small columns beside it are read without touching it. Row groups and
pages have a given size, and Parquet's page indexes let a reader with a filter on doc_id skip pages.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from jobtide.llm.common import shared_path, worker_state

CACHED_WORDS = 400_000  # words of one generation that a worker remembers; only speed depends on it
FLUSH_IDS = 1 << 20     # ids in an Arrow batch, more only within one document


# A-Z before UTF-8 that begins no letter of the Latin, Greek, Cyrillic blocks and no general punctuation.
_MARKED = re.compile(rb"[A-Z](?:[\xcc\xcd\xd2\xd6-\xe1\xe3-\xf4]|\xe2(?!\x80))")
_TAIL = b".,;:!?)]}\"#$%&*"  # punctuation cut from the end of a word of letters


class _Letters(dict):
    """What a tokenizer's normalizer and pre-tokenizer make of a letter within a word; a table of ``str.translate``.

    Below the Hangul jamo no two letters compose, so that letters stand for themselves. Raises ValueError for
    one that they cut off, drop or turn into more than letters.
    """

    def __init__(self, tokenizer):
        super().__init__()
        self.normal, self.cut = tokenizer.normalizer, tokenizer.pre_tokenizer
        # An added token that begins with a letter may be found anywhere in a word.
        self.known = self.cut is not None and not any(
            t.content[:1].isalpha() for t in tokenizer.get_added_tokens_decoder().values())

    def __missing__(self, code: int) -> str:
        pieces = []
        if self.known and code < 0x1100:
            text = "a" + chr(code)
            text = text if self.normal is None else self.normal.normalize_str(text)
            pieces = self.cut.pre_tokenize_str(text) if text.isalpha() else []
        if len(pieces) != 1 or pieces[0][0][:1] != "a" or len(pieces[0][0]) < 2:
            raise ValueError(code)
        self[code] = pieces[0][0][1:]
        return self[code]


class _Words(dict):
    """The ids of words as the bytes of 32-bit integers, learned from the tokenizer when first looked up.

    A word of letters alone goes to the tokenizer's model at once; in all others the whole tokenizer runs.
    """

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.model, self.letters, self.older = tokenizer, tokenizer.model, _Letters(tokenizer), {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            core = word.rstrip(_TAIL)
            piece = self._piece(core)
            if piece is None:
                ids = self.whole(word.decode())
            elif len(core) < len(word):
                ids = self[core] + self[word[len(core):]]
            else:
                found = self.model.tokenize(piece)
                ids = struct.pack(f"<{len(found)}I", *[t.id for t in found])
        self[word] = ids
        return ids

    def _piece(self, core: bytes) -> str | None:
        text = core.decode()
        try:
            return text.translate(self.letters) if text.isalpha() else None
        except ValueError:
            return None

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def trim(self) -> None:
        """What was met since the last time stays, the rest goes."""
        if len(self) > CACHED_WORDS:
            self.older.clear()
            self.older.update(self)
            self.clear()


class Encoder:
    """Encodes texts word by word and remembers the ids of words.

    In a tokenizer that drops white space and splits letters from punctuation, no token spans a blank or
    the place where a word of letters ends and its punctuation begins. The ids of a text are then those
    of its words (cut at ASCII white space) in a row, with A-Z in lower case first where the tokenizer
    does so too. ``whole`` is for tokenizers for which this does not hold.
    """

    def __init__(self, config: str, whole: bool = False):
        from tokenizers import Tokenizer

        key = f"encoder-{zlib.crc32(config.encode())}-{len(config)}"
        if key not in worker_state():
            worker_state()[key] = _Words(Tokenizer.from_str(config))
        self.words, self.whole = worker_state()[key], whole

    def __call__(self, text: str, end_id: int | None) -> np.ndarray:
        return np.frombuffer(self.stored(text, end_id), "<u4")

    def stored(self, text: str, end_id: int | None) -> bytes:
        """The ids as the bytes of little-endian 32-bit integers."""
        end = b"" if end_id is None else end_id.to_bytes(4, "little")
        if self.whole:
            return self.words.whole(text) + end
        raw = text.encode("utf-8", "replace")
        # Special tokens keep their case, and letters that a mark may follow are left to the tokenizer: lower-casing
        # them before it composes the two could give another letter.
        words = (raw if b"<|" in raw or _MARKED.search(raw) else raw.lower()).split()
        ids = b"".join([*map(self.words.__getitem__, words), end])
        self.words.trim()
        return ids


def write_tokens(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                 end_id: int | None = 1, whole: bool = False, row_group_bytes: int = 64 << 20,
                 page_bytes: int = 256 << 10) -> None:
    """Encode every whole text with a tokenizers file and write the ids at ``path`` in ascending doc_id order.

    ``tokenizer`` is the file's place on the driver; its content goes with the tasks. A null or empty text has
    only the end id. Null ids come first; rows of one id follow in the order of their texts, repeated rows stay.
    An empty table gives files without rows; other columns are not read. Columns: shard, first (ids before the
    document in its shard), doc_id, n_tokens, ids; shards are numbered in document order.
    """
    context = docs.sparkSession.sparkContext
    config = context.broadcast(Path(tokenizer).read_text())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard, first = Encoder(config.value, whole), TaskContext.get().partitionId(), 0

        def table(ids: pa.Array, held: list[bytes]) -> pa.RecordBatch:
            sizes, values = np.array([len(x) // 4 for x in held], np.int64), b"".join(held)
            offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
            values = pa.Array.from_buffers(pa.int32(), len(values) // 4, [None, pa.py_buffer(values)])
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(held), shard, np.int32)), pa.array(first + offsets[:-1].astype(np.int64)),
                 ids, pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets), values)],
                ["shard", "first", "doc_id", "n_tokens", "ids"])

        for batch in batches:
            ids, held, count, last = batch.column(0), [], 0, batch.num_rows - 1
            for i, t in enumerate(batch.column(1)):
                held.append(encode.stored(t.as_py() or "", end_id))
                count += len(held[-1]) // 4
                if count >= FLUSH_IDS or i == last:
                    yield table(ids.slice(i + 1 - len(held), len(held)), held)
                    first, held, count = first + count, [], 0

    picked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    # Rows of one id are spread by text and position, so that no id fills a task.
    order = ["doc_id", "_text", "_at"]
    ordered = (picked.withColumns({"_text": F.xxhash64("text"), "_at": F.monotonically_increasing_id()})
               .repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text"))
    (ordered.mapInArrow(run, f"shard int, first bigint, doc_id {kind}, n_tokens bigint, ids array<int>")
     .write.option("compression", "zstd").option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.enable.dictionary", "true").option("parquet.block.size", row_group_bytes)
     .option("parquet.page.size", page_bytes).option("parquet.dictionary.page.size", 1 << 20)
     .parquet(path))


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, shard, first, start, n_tokens) of a token file; the ids are not read."""
    rows = spark.read.parquet(path).select("doc_id", "shard", "first", "n_tokens")
    return rows.join(_shard_starts(rows), "shard").withColumn("start", F.col("before") + F.col("first")).drop("before")


def _shard_starts(rows: DataFrame) -> DataFrame:
    """(shard, before): ids in the shards before; as many rows as write tasks."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return rows.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read back from a token file: lengths and CRC-32 of the ids as stored."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            values, ends = lists.flatten().to_numpy().astype("<u4"), np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            crcs = [zlib.crc32(values[a:b].tobytes()) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), pa.array(np.diff(ends, prepend=0).astype(np.int64)),
                 pa.array(crcs, pa.int64())], ["doc_id", "shard", "first", "n_tokens", "ids_crc32"])

    stored = spark.read.parquet(path)
    kind = stored.schema["doc_id"].dataType.simpleString()
    read = stored.select("doc_id", "shard", "first", "ids").mapInArrow(
        run, f"doc_id {kind}, shard int, first bigint, n_tokens bigint, ids_crc32 bigint")
    return (read.join(F.broadcast(_shard_starts(stored)), "shard")
            .select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"))


def tokenized(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """Write the token files of docs in the shared folder and read them back as ``checksums``."""
    path = shared_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, doc_id, text, **how)
    return checksums(docs.sparkSession, path)
