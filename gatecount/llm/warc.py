"""Deterministic, sharded WARC archives.

Pages are dealt by ranges of their id to shards of near equal bytes; the ranges follow from
exact byte counts, not from a sample, so a rerun writes the same files. Each task sorts its
shard, writes one gzip member a record, rolls files by compressed size, and gives every
record new headers and digests. A file is written under a temporary name and renamed
when it is whole; it counts once the manifest, which Spark commits last, lists it.

Of records with equal payloads of at least ``revisit_bytes`` the one with the largest page_id is
the response, the others are revisits of it. Decisions travel as extra rows of the one shuffle
that moves the pages.

Defined results: a null page is an empty payload; a null url is written as ``urn:page:<id>``; rows
without a page_id are archived last, are all responses and come back without one; rows that repeat the largest page_id are all
responses; an empty table gives an empty manifest. Columns other than the three named are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import arrow_place, folder, saved

_CELLS, _PARTS = 4096, 64
MANIFEST = "shard int, file string, bytes long, sha256 string, records long, first_id long, last_id long"
RECORDS = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"
_READ = 1 << 16


def record_id(name: object) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(f'page {name}'.encode()).digest()[:16], version=5)}>"


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    digest = base64.b32encode(hashlib.sha1(block).digest()).decode()
    fields = [*fields, ("WARC-Block-Digest", f"sha1:{digest}"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(head.encode() + block + b"\r\n\r\n") + press.flush()


def page_record(page_id: int | None, url: str, payload: bytes, date: str, refers_to: int | None = None, nth: int = 0) -> bytes:
    """One compressed response record, or a revisit record without the payload.

    Its id says page and payload, so a revisit can name the record it refers to; the ``nth`` record of the same page and
    payload, counted from 0, has an id of its own.
    """
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    clean = "".join(c for c in url if c > " ") or f"urn:page:{page_id}"
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(f"{f'none {clean}' if page_id is None else page_id} {digest}" + (f" {nth}" if nth else ""))),
        ("WARC-Date", date),
        ("WARC-Target-URI", clean),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("X-Page-ID", "-" if page_id is None else str(page_id)),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", record_id(f"{refers_to} {digest}")), ("X-Refers-To-Page-ID", str(refers_to))]
        payload = b""
    return _record(fields, block + payload)


class _Roll:
    """Files of one shard: the open one under a temporary name, the whole ones renamed."""

    def __init__(self, out: str, shard: int, roll_bytes: int, date: str):
        self.fs, self.top = arrow_place(out)
        self.shard, self.roll_bytes, self.date, self.number, self.sink = shard, roll_bytes, date, 0, None
        self.attempt = TaskContext.get().taskAttemptId() if TaskContext.get() else 0

    def _open(self) -> None:
        self.name = f"part-{self.shard:06d}-{self.number:05d}.warc.gz"
        self.temporary = f"{self.top}/_temporary/{self.name}.{self.attempt}"
        self.fs.create_dir(f"{self.top}/_temporary", recursive=True)
        self.sink = self.fs.open_output_stream(self.temporary, compression=None)
        self.sum, self.size, self.records, self.first, self.last = hashlib.sha256(), 0, 0, None, None
        info = f"format: WARC File Format 1.1\r\nisPartOf: {self.name}\r\n".encode()
        self._put(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(-2 - self.shard)), ("WARC-Date", self.date), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], info))

    def _put(self, data: bytes) -> None:
        self.sink.write(data)
        self.sum.update(data)
        self.size += len(data)

    def write(self, page_id: int, data: bytes) -> Iterator[tuple]:
        if self.sink is None:
            self._open()
        self._put(data)
        self.records += 1
        self.first = page_id if self.first is None else self.first
        self.last = page_id
        if self.size >= self.roll_bytes:
            yield from self.close()

    def close(self) -> Iterator[tuple]:
        if self.sink is not None:
            self.sink.close()
            self.fs.move(self.temporary, f"{self.top}/{self.name}")
            yield (self.shard, self.name, self.size, self.sum.hexdigest(), self.records, self.first, self.last)
            self.sink, self.number = None, self.number + 1


def _edges(facts: DataFrame, shard_bytes: int) -> np.ndarray:
    """The least ids of all shards but the first, so that each but for one of a single id holds about ``shard_bytes``.

    Exact bytes are counted in cells of the id range; a cell that holds more than a shard is cut into ``_PARTS`` and
    counted again, so ids far from the others cost a round and no more. A hundred thousand shards at most.
    """
    low, high, total = facts.agg(F.min("page_id"), F.max("page_id"), F.coalesce(F.sum(F.col("bytes") + 512), F.lit(0))).first()
    if low is None:
        return np.zeros(0, np.int64)
    aim = max(shard_bytes, total // 100_000)
    starts = sorted({low + (high - low + 1) * k // _CELLS for k in range(_CELLS)})
    while True:
        cells = np.array(starts, np.int64)

        def cell_of(ids: pa.Array) -> pa.Array:  # runs before the next round binds other cells
            return pa.array(np.searchsorted(cells, ids.to_numpy(zero_copy_only=False), "right") - 1, pa.int64())

        counted = dict(facts.filter("page_id is not null").groupBy(F.arrow_udf(cell_of, "long")("page_id").alias("cell")).agg(F.sum(F.col("bytes") + 512)).collect())
        more = set()
        for k, size in counted.items():
            a, b = starts[k], starts[k + 1] if k + 1 < len(starts) else high + 1
            if size > aim and b - a > 1:
                more |= {a + (b - a) * x // _PARTS for x in range(_PARTS)} - {a}
        if not more:
            break
        starts = sorted({*(starts[k] for k in counted), *(starts[k + 1] for k in counted if k + 1 < len(starts)), *more, low})
    edges, held = [], 0
    for k in sorted(counted):
        held += counted[k]
        if held >= aim and k + 1 < len(starts):
            edges.append(starts[k + 1])
            held = 0
    return np.array(edges, np.int64)


def write_archive(pages: DataFrame, *, revisit_bytes: int = 1000, shard_bytes: int = 16 << 20, roll_bytes: int = 32 << 20, date: str = "2024-01-01T00:00:00Z") -> tuple[str, DataFrame]:
    """(folder, manifest) of the archive of ``pages`` (page_id, url, html) in the shared folder."""
    spark = pages.sparkSession
    out = folder(spark, "warc")
    page_id = F.col("page_id").cast("long")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    facts = saved(pages.select(page_id.alias("page_id"), F.length(payload).cast("long").alias("bytes"), F.sha1(payload).alias("digest")), "warc-facts")
    edge_array = _edges(facts, shard_bytes)

    def shard_of(ids: pa.Array) -> pa.Array:
        at = np.searchsorted(edge_array, ids.fill_null(0).to_numpy(zero_copy_only=False), "right")
        return pa.array(np.where(np.asarray(ids.is_null()), len(edge_array), at), pa.int32())

    shard = F.arrow_udf(shard_of, "int")
    large = facts.filter(F.col("bytes") >= revisit_bytes)
    kept = large.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least")).filter("refers_to > least").select("digest", "refers_to")
    revisits = large.join(kept, "digest").filter("page_id < refers_to").select("page_id", F.lit(0).alias("kind"), "digest", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "refers_to").distinct()
    rows = pages.select(page_id.alias("page_id"), F.lit(1).alias("kind"), F.sha1(payload).alias("digest"), "url", "html", F.lit(None).cast("long").alias("refers_to"))
    rows = rows.unionByName(revisits).withColumn("shard", shard(F.col("page_id")))
    rows = rows.repartitionById(len(edge_array) + 1, F.col("shard")).sortWithinPartitions("shard", F.col("page_id").asc_nulls_last(), "kind", "digest", "url")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, known, at, last, nth = None, {}, False, None, 0
        done: list[tuple] = []
        for batch in batches:
            for row in batch.to_pylist():
                if files is None or files.shard != row["shard"]:
                    done += files.close() if files else []
                    files = _Roll(out, row["shard"], roll_bytes, date)
                if at is False or row["page_id"] != at:
                    known, at, last = {}, row["page_id"], None
                if row["kind"] == 0:
                    known[row["digest"]] = row["refers_to"]
                    continue
                last, nth = row["digest"], nth + 1 if row["digest"] == last else 0
                done += files.write(at, page_record(at, row["url"] or "", (row["html"] or "").encode(), date, known.get(last), nth))
        done += files.close() if files else []
        if done:
            yield pa.RecordBatch.from_pylist([dict(zip((x.split()[0] for x in MANIFEST.split(", ")), d, strict=True)) for d in done], schema=pa.schema([("shard", pa.int32()), ("file", pa.string()), ("bytes", pa.int64()), ("sha256", pa.string()), ("records", pa.int64()), ("first_id", pa.int64()), ("last_id", pa.int64())]))

    target, place = arrow_place(out)
    target.create_dir(place, recursive=True)
    rows.mapInArrow(write, MANIFEST).write.parquet(f"{out}/_manifest")
    return out, spark.read.schema(MANIFEST).parquet(f"{out}/_manifest")


def members(file: memoryview) -> Iterator[bytes]:
    """The gzip members of a file, one after the other, read in small steps."""
    at = 0
    while at < len(file):
        unpack, parts = zlib.decompressobj(31), []
        while not unpack.eof:
            piece = file[at : at + _READ]
            if not len(piece):
                raise ValueError("a gzip member is cut short")
            parts.append(unpack.decompress(piece))
            at += len(piece)
        at -= len(unpack.unused_data)
        yield b"".join(parts)


def parse_record(data: bytes) -> dict | None:
    """A page record's row (see RECORDS); None for other records. Digests are checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if len(rest) != len(block) + 4 or fields["WARC-Block-Digest"] != "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode():
        raise ValueError("a record is damaged")
    if fields["WARC-Type"] not in ("response", "revisit"):
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
    if fields["WARC-Type"] == "response" and (len(payload) != size or hashlib.sha1(payload).digest() != digest):
        raise ValueError("a payload is damaged")
    refers = fields.get("X-Refers-To-Page-ID")
    return {"page_id": None if fields["X-Page-ID"] == "-" else int(fields["X-Page-ID"]), "url": fields["WARC-Target-URI"], "payload": payload if refers is None else None, "payload_bytes": size, "payload_digest": digest.hex(), "record_type": fields["WARC-Type"], "refers_to": None if refers is None else int(refers)}


def read_archive(spark: SparkSession, out: str, manifest: DataFrame, *, payloads: bool = True) -> DataFrame:
    """The page records (see RECORDS) of the files that the manifest lists; files of other sizes or sums are refused."""
    listed = manifest.select(F.col("file"), F.col("sha256"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.warc.gz").load(out)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content").join(F.broadcast(listed) if listed.count() <= 100_000 else listed, "file")
    kinds = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                file = memoryview(batch.column(0)[k].as_buffer())
                if hashlib.sha256(file).hexdigest() != batch.column(1)[k].as_py():
                    raise ValueError("a file differs from its manifest")
                rows, held = [], 0
                for data in members(file):
                    if (row := parse_record(data)) is not None:
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        held += len(row["payload"] or b"") + 200
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=kinds)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    return files.select("content", "sha256").mapInArrow(parse, RECORDS)
