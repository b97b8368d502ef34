"""WARC records in seekable Zstandard bundles.

A bundle is a file of independent frames, each with some records, and a seek table in a
skippable frame at its end (the public seekable format). An index maps every record's
identifier, which no other record has, to its bundle, its frame and its place inside the
frame, so that one record is read by decompressing one frame.

Every task writes bundles of its own, named after its attempt. Only what the index names
counts: files of attempts that failed are never read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.store import saved

#: Bytes of records in a frame and of a bundle, about.
FRAME, BUNDLE = 1 << 20, 64 << 20
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
INDEX = (
    "record_id string, bundle string, record long, page_id long, record_type string, frame long, offset long, length long"
)
RECORDS = "record_id string, page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    """The folder as Arrow reaches it, by its URI or as an absolute path."""
    return fs.FileSystem.from_uri(folder)


def _record_id(name: str) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, name).urn}>"


def _named(page_id: int, digest: str) -> str:
    """The identifier of the one record with this page and payload: others can work it out."""
    return _record_id(f"page:{page_id}:{digest}")


def _line(text: str) -> str:
    """Text as the value of a header: line breaks and percent signs are escaped."""
    return text.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _unline(text: str) -> str:
    return text.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(
    record_id: str,
    page_id: int | None,
    url: str | None,
    payload: bytes,
    refers_to: int | None,
    revisit: bool,
    date: str,
    refers_to_record: str | None = None,
) -> bytes:
    """One WARC record: a response with its payload, or a revisit with HTTP headers only."""
    digest = _digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        if refers_to_record is not None:
            head.append(f"WARC-Refers-To: {refers_to_record}")
        head.append(f"X-Refers-To-Page: {refers_to}")
    if page_id is not None:
        head.append(f"X-Page: {page_id}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict, int]:
    """The record that starts at `at`, and where the next one starts. The digest of a
    response is checked."""
    end = data.index(b"\r\n\r\n", at)
    lines = data[at:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError(f"no WARC record at {at}")
    head = dict(line.split(": ", 1) for line in lines[1:])
    start, size = end + 4, int(head["Content-Length"])
    block = data[start : start + size]
    http = block.index(b"\r\n\r\n") + 4
    kind = head["WARC-Type"]
    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
    payload = block[http:] if kind == "response" else None
    if payload is not None and _digest(payload) != digest:
        raise ValueError(f"the payload of record {head['WARC-Record-ID']} is damaged")
    found = {
        "record_id": head["WARC-Record-ID"],
        "page_id": int(head["X-Page"]) if "X-Page" in head else None,
        "url": _unline(head["WARC-Target-URI"]) if "WARC-Target-URI" in head else None,
        "record_type": kind,
        "refers_to": int(head["X-Refers-To-Page"]) if "X-Refers-To-Page" in head else None,
        "payload_digest": digest,
        "payload_bytes": int(re.search(rb"(?i)\r\nContent-Length: (\d+)", block[:http])[1]),
        "payload": payload,
    }
    return found, start + size + 4


class _Bundle:
    """A bundle while it is written."""

    def __init__(self, place: fs.FileSystem, folder: str, name: str, frame: int):
        self.name, self.limit = name, frame
        self.out = place.open_output_stream(f"{folder}/{name}", compression=None)
        self.frames: list[tuple[int, int]] = []
        self.waiting: list[bytes] = []
        self.filled = self.written = 0
        self.rows: list[tuple] = []
        self.packer = zstandard.ZstdCompressor(level=3, write_checksum=True)

    def next_id(self) -> str:
        """An identifier for the next record, after its place: bundle names are not used twice."""
        return _record_id(f"{self.name}#{len(self.rows)}")

    def add(self, record_id: str, page_id: int | None, kind: str, data: bytes) -> None:
        if self.filled and self.filled + len(data) > self.limit:
            self.flush()
        self.rows.append((record_id, self.name, len(self.rows), page_id, kind, len(self.frames), self.filled, len(data)))
        self.waiting.append(data)
        self.filled += len(data)

    def flush(self) -> None:
        if self.waiting:
            packed = self.packer.compress(b"".join(self.waiting))
            self.out.write(packed)
            self.frames.append((len(packed), self.filled))
            self.written += len(packed)
            self.waiting, self.filled = [], 0

    def close(self) -> pa.RecordBatch:
        """Writes the seek table; gives the index rows."""
        self.flush()
        table = b"".join(struct.pack("<II", *sizes) for sizes in self.frames)
        table += struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        columns = [pa.array([r[i] for r in self.rows], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in INDEX.split(", ")])


def seek_table(file: pa.NativeFile) -> list[tuple[int, int]]:
    """(start, compressed size) of each frame of a bundle, from the table at its end."""
    size = file.size()
    file.seek(size - 9)
    count, descriptor, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("the file has no seek table")
    entry = 12 if descriptor & 0x80 else 8
    file.seek(size - 9 - count * entry)
    table = file.read(count * entry)
    frames, at = [], 0
    for i in range(count):
        packed, _ = struct.unpack_from("<II", table, i * entry)
        frames.append((at, packed))
        at += packed
    return frames


def _frame(file: pa.NativeFile, start: int, size: int) -> bytes:
    file.seek(start)
    return zstandard.ZstdDecompressor().decompress(file.read(size))


def _batch(found: list[dict]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
    names = [f.split()[0] for f in RECORDS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in found], k) for n, k in zip(names, kinds, strict=True)], names)


def write(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = 0,
    date: str = "2000-01-01T00:00:00Z",
    frame: int = FRAME,
    bundle: int = BUNDLE,
) -> DataFrame:
    """Writes a record for every row of `pages` into bundles below `folder`, a shared folder
    given as URI or absolute path, and the index as Parquet in `folder`/index. Returns the index.

    The payload is the html in UTF-8, null as empty. Of records with equal payloads of
    `least_bytes` or more (by SHA-256), that with the largest page_id is a response and
    the others are revisits that refer to it; smaller payloads are all responses. Rows that
    repeat the largest id are responses too, and rows without an id never refer or are
    referred to. A null url leaves its header out. Other columns are ignored; an empty
    table gives an empty index.

    No two records have the same identifier. It comes from page and payload where revisits refer
    to the record and it is the only one with both, else from bundle and number.
    Revisits of a page whose record is there more than once name the page, but no record.

    Groups of equal payloads are counted before they are joined, and only groups of two
    and more are; adaptive execution splits the join where one payload has many rows. A
    task holds one frame and the index rows of one bundle.
    """
    spark = pages.sparkSession
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("key", F.when(F.octet_length("payload") >= least_bytes, F.sha2("payload", 256)))
    same = rows.where("key is not null and page_id is not null").groupBy("key", "page_id").agg(F.count("*").alias("n"))
    groups = same.groupBy("key").agg(
        F.max("page_id").alias("response"), (F.max_by("n", "page_id") == 1).alias("single"), F.count("*").alias("pages")
    )
    # Written, so that the planner knows their size: if they are few they go to the rows, and
    # no payload is shuffled.
    groups = saved(groups.where("pages > 1").select("key", "response", "single"), "same-payload")
    refers_to = F.when(F.col("page_id") != F.col("response"), F.col("response"))
    # Revisits and the record they refer to, if it can be told by page and payload.
    named = F.coalesce(F.col("single") & F.col("page_id").isNotNull(), F.lit(False))
    records = rows.join(groups, "key", "left").select(
        "page_id", "url", "payload", refers_to.alias("refers_to"), named.alias("named")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, now = TaskContext.get(), 0, None
        place, path = _place(folder)
        place.create_dir(path, recursive=True)
        for batch in batches:
            for i in range(batch.num_rows):
                if now is None:
                    name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{made:04d}.warc.zst"
                    now, made = _Bundle(place, path, name, frame), made + 1
                page, address, payload, refers, named = (batch.column(c)[i].as_py() for c in range(5))
                kind, own, other = "response" if refers is None else "revisit", now.next_id(), None
                if named and refers is None:
                    own = _named(page, _digest(payload))
                elif named:
                    other = _named(refers, _digest(payload))
                now.add(own, page, kind, record(own, page, address, payload, refers, kind == "revisit", date, other))
                if now.written >= bundle:
                    yield now.close()
                    now = None
        if now is not None:
            yield now.close()

    records.mapInArrow(work, INDEX).write.parquet(f"{folder}/index")
    return index(spark, folder)


def index(spark: SparkSession, folder: str) -> DataFrame:
    """The index of the bundles in `folder`."""
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """All records of the bundles that the index of `folder` names, read from the bundles:
    record_id, page_id, url, record_type, refers_to, payload_digest, payload_bytes (both of the whole
    payload) and payload (null for revisits)."""
    bundles = index(spark, folder).select("bundle").distinct()
    tasks = max(1, min(bundles.count(), 100_000))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, path = _place(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with place.open_input_file(f"{path}/{name}") as file:
                    for start, size in seek_table(file):
                        data, at, found = _frame(file, start, size), 0, []
                        while at < len(data):
                            one, at = parse(data, at)
                            found.append(one)
                        yield _batch(found)

    return bundles.repartition(tasks).mapInArrow(work, RECORDS)


def fetch(records: DataFrame, folder: str) -> DataFrame:
    """The records that rows of the index name, each by decompressing its frame only."""
    wanted = records.select("bundle", "frame", "offset")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, path = _place(folder)
        for batch in batches:
            rows = sorted(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            name = frames = at = data = None
            file, found = None, []
            for bundle, number, offset in rows:
                if bundle != name:
                    if file is not None:
                        file.close()
                    file = place.open_input_file(f"{path}/{bundle}")
                    name, frames, at = bundle, seek_table(file), None
                if number != at:
                    if found:
                        yield _batch(found)
                    at, data, found = number, _frame(file, *frames[number]), []
                found.append(parse(data, offset)[0])
            if file is not None:
                file.close()
            if found:
                yield _batch(found)

    return wanted.mapInArrow(work, RECORDS)
