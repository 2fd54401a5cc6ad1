"""A deterministic sharded WARC writer and its reader.

Rows are put in the order of their ids, and the running sum of their payload bytes in that order cuts
them into shards, so the same rows give the same shards however Spark laid them out. A task writes a
shard's records one gzip member each and begins a new file when the compressed size passes a limit.
Headers, record ids and digests are regenerated from the row alone. A file is written under a temporary
name of its attempt and renamed when it is whole; only files in the manifest, a table that Spark commits
at the end, belong to the archive. A repeated attempt makes the same bytes under the same names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from jobtide.llm.common import release, saved, shared_path

DATE = "2020-01-01T00:00:00Z"  # of all records: the rows have none
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK = 1 << 20
MANIFEST = "file string, shard bigint, records bigint, bytes bigint, sha256 string"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder's URI and the path in it."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def digest(content: bytes) -> str:
    return base64.b32encode(hashlib.sha1(content).digest()).decode()


def _record_id(page: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, page)}>"


def _record(kind: str, record_id: str, block: bytes, headers: dict[str, str]) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {DATE}",
             *[f"{k}: {v}" for k, v in headers.items()], f"WARC-Block-Digest: sha1:{digest(block)}",
             f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n", mtime=0)


def page_record(page_id: int | None, url: str | None, payload: bytes, of: int | None, revisit: bool, place: int) -> bytes:
    """The record of a row; ``place`` tells rows apart that are alike in id and url."""
    name = f"page:{page_id}"
    uri = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url) if url else f"urn:{name}"
    headers = {"WARC-Target-URI": uri, "WARC-Payload-Digest": f"sha1:{digest(payload)}",
               "Content-Type": "application/http; msgtype=response", "Page-ID": "" if page_id is None else str(page_id)}
    if revisit:
        headers |= {"WARC-Profile": PROFILE, "Refers-To-Page-ID": "" if of is None else str(of)}
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return _record("revisit" if revisit else "response", _record_id(f"{name}:{uri}:{place}"),
                   http if revisit else http + payload, headers)


class _Shard:
    """The files of one shard: appended to, rolled by compressed size, renamed when whole."""

    def __init__(self, folder: str, shard: int, roll_bytes: int):
        self.fs, self.path = file_system(folder)
        self.shard, self.roll_bytes, self.number, self.out, self.listed = shard, roll_bytes, 0, None, []

    def add(self, record: bytes) -> None:
        if self.out is None:
            self.name = f"part-{self.shard:06d}-{self.number:05d}.warc.gz"
            self.temporary = f"{self.path}/.{self.name}.{TaskContext.get().taskAttemptId()}"
            self.out, self.size, self.records, self.sha = self.fs.open_output_stream(self.temporary, compression=None), 0, 0, hashlib.sha256()
            self._write(_record("warcinfo", _record_id(self.name), b"format: WARC File Format 1.1\r\n",
                                {"WARC-Filename": self.name, "Content-Type": "application/warc-fields"}))
        self._write(record)
        self.records += 1
        if self.size >= self.roll_bytes:
            self.close()

    def _write(self, member: bytes) -> None:
        self.out.write(member)
        self.sha.update(member)
        self.size += len(member)

    def close(self) -> None:
        if self.out is None:
            return
        self.out.close()
        target = f"{self.path}/{self.name}"
        if self.fs.get_file_info(target).type == pafs.FileType.NotFound:
            self.fs.move(self.temporary, target)
        else:  # an earlier attempt ended the same file
            self.fs.delete_file(self.temporary)
        self.listed.append((self.name, self.shard, self.records, self.size, self.sha.hexdigest()))
        self.number, self.out = self.number + 1, None


def _boundaries(known: DataFrame, shard_bytes: int) -> np.ndarray:
    """The first id of each shard, for rows (page_id, size, n): as many numbers as there are shards.

    Bytes before an id: those of the ranges of a sort before its own, and of smaller ids in its range.
    """
    total = F.sum(F.col("size") * F.col("n"))
    ids = known.where(F.col("page_id").isNotNull()).groupBy("page_id").agg(total.cast("bigint").alias("bytes"))
    ids = saved(ids.repartitionByRange("page_id").sortWithinPartitions("page_id")
                .withColumn("at", F.monotonically_increasing_id()), "ids")
    part = F.shiftright("at", 33).alias("part")
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = ids.groupBy(part).agg(F.sum("bytes").alias("bytes")).select(
        "part", F.coalesce(F.sum("bytes").over(ahead), F.lit(0)).alias("ahead"))
    within = F.sum("bytes").over(Window.partitionBy("part").orderBy("at")) - F.col("bytes")
    shards = (ids.select("page_id", "bytes", "at", part).withColumn("within", within).join(F.broadcast(parts), "part")
              .groupBy(F.floor((F.col("ahead") + F.col("within")) / shard_bytes).alias("shard")).agg(F.min("page_id").alias("id")))
    return np.array(sorted(r.id for r in shards.collect()) or [0], np.int64)


def write_archive(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                  min_revisit_bytes: int = 0, shard_bytes: int = 1 << 30, roll_bytes: int = 1 << 30) -> DataFrame:
    """Write one record per row to WARC files below ``folder``; returns the manifest, also written there.

    A shard takes whole ids up to about ``shard_bytes`` of payload; rows without an id are in the last one.
    The payload is the html in UTF-8, a null one is empty. Among rows with equal payloads of at least
    ``min_revisit_bytes`` the smallest id is the response and the others revisit it; smaller payloads are all
    responses. A null id ranks last. Rows alike in id and payload keep one response among them, the first by url;
    the others revisit it. An empty table gives an archive without files; other columns are not read.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).alias("url"),
                        F.coalesce(F.col(html), F.lit("")).alias("html"))
    size, key = F.octet_length("html").cast("bigint"), F.unhex(F.sha2("html", 256))
    known = saved(rows.select("page_id", key.alias("key"), size.alias("size")).groupBy("page_id", "key").agg(
        F.max("size").alias("size"), F.count("*").alias("n")), "sizes")
    first_of_shard = _boundaries(known, shard_bytes)
    # What the writer must know beside a row itself: the response of payloads that several rows have.
    first = (known.where(F.col("size") >= min_revisit_bytes).groupBy("key")
             .agg(F.min("page_id").alias("of"), F.sum("n").alias("alike")).where("alike > 1").drop("alike"))
    shared = known.join(first, "key").select("page_id", F.lit(None).cast("string").alias("url"),
                                             F.lit(None).cast("string").alias("html"), "key", "of", F.lit(0).alias("kind"))
    payload = rows.select("page_id", "url", "html", key.alias("key"), F.lit(None).cast("bigint").alias("of"), F.lit(1).alias("kind"))
    last_shard = len(first_of_shard) - 1

    @F.pandas_udf("int")
    def shard_of(ids: pd.Series) -> pd.Series:
        known_ids = ids.fillna(0).astype("int64").to_numpy()
        found = np.searchsorted(first_of_shard, known_ids, side="right") - 1
        return pd.Series(np.where(ids.isna(), last_shard, found).clip(0).astype("int32"))

    # Payloads are shuffled once; what several rows share comes before the rows it is about.
    placed = (shared.unionByName(payload).withColumn("shard", shard_of("page_id")).repartition("shard")
              .sortWithinPartitions("shard", F.col("page_id").asc_nulls_last(), "key", "kind", F.col("url").asc_nulls_last())
              .select("shard", "page_id", "url", "html", "key", "of", "kind"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_shard, last, place, response, listed = None, None, 0, None, []
        for batch in batches:
            for shard, page, link, html, key, of, kind in zip(*(batch.column(i) for i in range(7))):
                shard, page, key = shard.as_py(), page.as_py(), key.as_py()
                if kind.as_py() == 0:
                    response = page, key, of.as_py()
                    continue
                if open_shard is None or open_shard.shard != shard:
                    if open_shard is not None:
                        open_shard.close()
                        listed += open_shard.listed
                    open_shard = _Shard(folder, shard, roll_bytes)
                place = place + 1 if last == (page, key) else 0
                last = (page, key)
                shared = response is not None and response[:2] == (page, key)
                revisit = shared and (page != response[2] or place > 0)
                payload = html.as_py().encode("utf-8", "surrogatepass")
                open_shard.add(page_record(page, link.as_py(), payload, response[2] if shared else None, revisit, place))
        if open_shard is not None:
            open_shard.close()
            listed += open_shard.listed
        yield pa.RecordBatch.from_pylist([dict(zip(("file", "shard", "records", "bytes", "sha256"), x)) for x in listed],
                                         pa.schema([("file", pa.string()), ("shard", pa.int64()), ("records", pa.int64()),
                                                    ("bytes", pa.int64()), ("sha256", pa.string())]))

    system, path = file_system(folder)
    system.create_dir(path, recursive=True)
    placed.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    release(spark)
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, one whole record at a time."""
    left = b""
    while True:
        inflate, parts = zlib.decompressobj(31), []
        while not inflate.eof:
            left = left or stream.read(CHUNK)
            if not left:
                if parts:
                    raise ValueError("a record is cut off")
                return
            parts.append(inflate.decompress(left))
            left = inflate.unused_data
        yield b"".join(parts)


def _parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = record.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    block = rest[:int(headers["Content-Length"])]
    if f"sha1:{digest(block)}" != headers["WARC-Block-Digest"]:
        raise ValueError(f"{headers['WARC-Record-ID']}: the block does not match its digest")
    return headers, block


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) of an archive's records.

    Only files of the manifest are read, a task to a file and a record at a time. Block and payload digests are
    checked. A revisit has the size and digest of the full payload, and no payload of its own.
    """
    listed = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    files = max(1, listed.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
        table = lambda rows: pa.RecordBatch.from_arrays(
            [pa.array(x, kind) for x, kind in zip(zip(*rows), kinds)], names)
        number = lambda text: int(text) if text else None
        system, path = file_system(folder)
        for batch in batches:
            for name, records in zip(batch.column(0), batch.column(1)):
                rows, held, count = [], 0, 0
                with system.open_input_stream(f"{path}/{name.as_py()}", compression=None) as stream:
                    for headers, block in map(_parsed, _members(stream)):
                        if headers["WARC-Type"] == "warcinfo":
                            continue
                        count += 1
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
                        said, revisit = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"] == "revisit"
                        if not revisit and (digest(payload) != said or len(payload) != size):
                            raise ValueError(f"{headers['WARC-Record-ID']}: the payload does not match its digest")
                        rows.append((number(headers["Page-ID"]), headers["WARC-Target-URI"], size, said, headers["WARC-Type"],
                                     number(headers.get("Refers-To-Page-ID")), None if revisit else payload))
                        held += len(payload)
                        if held > 4 * CHUNK or len(rows) >= 2000:
                            yield table(rows)
                            rows, held = [], 0
                if count != records.as_py():
                    raise ValueError(f"{name}: {count} records, {records} in the manifest")
                if rows:
                    yield table(rows)

    return listed.select("file", "records").repartition(files).mapInArrow(
        run, "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string,"
             " refers_to bigint, payload binary")


def archived(pages: DataFrame, **how) -> DataFrame:
    """Write pages as an archive in the shared folder and read its records back."""
    folder = shared_path(pages.sparkSession, "warc")
    write_archive(pages, folder, **how)
    return read_archive(pages.sparkSession, folder)
