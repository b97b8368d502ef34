"""Reversible line dedup: sharded cuckoo filters in front of exact reference counts.

An index holds, in tables of the shared folder:

* postings: which document holds which line. They are what lets a document go again.
* counts: for each line how many document rows hold it, and the first and last of their ids.
  Exact; a change is a new row of a later version, and the latest row of a line holds.
* filters: for each shard of lines a cuckoo filter of those in the counts. It answers
  "never seen" for sure, so only lines that may have been seen are looked up in the
  counts, and lines that are seen no more can be taken out, as counts reach zero.

A line is known by its key (ASCII white space off both ends, A-Z in lower case), and the
key by the first 128 bits of its SHA-256. Everything is keyed by line, and added up before
it is shuffled, so a line that a third of all documents hold is one row in the shuffle.
Every step writes a new version, which counts from its commit on; a job that dies in
between leaves the version before.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.store import saved

LENGTH = 10
#: White space that is stripped off lines.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Buckets of a filter's segment, each of four places of 16 bits.
BUCKETS, PLACES = 1 << 16, 4
#: Lines of a shard to begin with: two thirds of a segment.
SHARD_LINES = BUCKETS * PLACES * 2 // 3
ROUNDS = 200


class CuckooFilter:
    """Cuckoo filters of one shard: segments of the same size, the next one opened when
    the others have no room. Keys are rows of two unsigned 64-bit numbers."""

    def __init__(self, buckets: int = BUCKETS, segments: list[bytes] = ()):
        if buckets & (buckets - 1):
            raise ValueError("the number of buckets must be a power of two")
        self.buckets = buckets
        self.segments = [np.frombuffer(s, "<u2").reshape(buckets, PLACES).copy() for s in segments]

    def _marks(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bucket and mark (1 to 65535) of each key."""
        bucket = (keys[:, 0] & np.uint64(self.buckets - 1)).astype(np.int64)
        return bucket, (keys[:, 1] % np.uint64(65535) + np.uint64(1)).astype(np.uint16)

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """The other bucket of a mark, the same way back and forth."""
        return bucket ^ (mark.astype(np.int64) * 0x5BD1E995 >> 7 & self.buckets - 1)

    def has(self, keys: np.ndarray) -> np.ndarray:
        """False: surely never put in. True: put in, or one of few false alarms."""
        bucket, mark = self._marks(keys)
        other, found = self._other(bucket, mark), np.zeros(len(keys), bool)
        for segment in self.segments:
            for at in (bucket, other):
                found |= (segment[at] == mark[:, None]).any(axis=1)
        return found

    def put(self, keys: np.ndarray) -> None:
        """Different keys that are not in yet."""
        bucket, mark = self._marks(keys)
        at = 0
        while len(mark):
            if at == len(self.segments):
                self.segments.append(np.zeros((self.buckets, PLACES), np.uint16))
            bucket, mark = self._fill(self.segments[at], bucket, mark)
            at += 1

    def _fill(self, segment: np.ndarray, bucket: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marks for which there was no room, with their buckets: one of its two each."""
        draw, tried = np.random.default_rng(len(mark)), np.zeros(len(mark), np.int64)
        if (segment > 0).mean() > 0.95:
            return bucket, mark
        for _ in range(ROUNDS):
            if not len(mark):
                break
            order = np.argsort(bucket, kind="stable")
            bucket, mark, tried = bucket[order], mark[order], tried[order]
            nth = np.arange(len(bucket)) - np.searchsorted(bucket, bucket)
            free = segment[bucket] == 0
            # The n-th mark of a bucket gets its n-th free place.
            goes = nth < free.sum(axis=1)
            place = np.argmax(free.cumsum(axis=1) > nth[:, None], axis=1)
            segment[bucket[goes], place[goes]] = mark[goes]
            bucket, mark, tried = bucket[~goes], mark[~goes], tried[~goes]
            if not len(mark):
                break
            # The others go to their other bucket; from the second time on, the first of a
            # bucket takes a place there and what was in it moves on.
            first = np.append(True, bucket[1:] != bucket[:-1]) & (tried > 0)
            place = draw.integers(0, PLACES, int(first.sum()))
            taken = segment[bucket[first], place]
            segment[bucket[first], place] = mark[first]
            mark[first] = taken
            move = first | (tried == 0)
            bucket[move] = self._other(bucket[move], mark[move])
            tried += 1
        return bucket, mark

    def take(self, keys: np.ndarray) -> None:
        """Takes out different keys, all of which were put in."""
        bucket, mark = self._marks(keys)
        for segment in self.segments:
            flat = segment.reshape(-1)
            for either in range(2):
                at = self._other(bucket, mark) if either else bucket
                out, todo = np.zeros(len(mark), bool), np.arange(len(mark))
                while len(todo):
                    same = segment[at[todo]] == mark[todo][:, None]
                    here = same.any(axis=1)
                    todo, places = todo[here], (at[todo] * PLACES + np.argmax(same, axis=1))[here]
                    # Two keys of one mark and bucket each take a place of their own.
                    _, firsts = np.unique(places, return_index=True)
                    flat[places[firsts]] = 0
                    out[todo[firsts]] = True
                    todo = np.delete(todo, firsts)
                bucket, mark = bucket[~out], mark[~out]
        if len(mark):
            raise ValueError("keys to be taken out were never put in")

    def rows(self) -> list[bytes]:
        return [s.astype("<u2").tobytes() for s in self.segments]


def _numbers(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _digest(key: str) -> bytes:
    return hashlib.sha256(key.encode()).digest()[:16]


_LOWER = str.maketrans(UPPER, LOWER)


def postings(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH) -> DataFrame:
    """(doc_id, key): the different keys of at least `length` code points of every row."""
    lines = F.split(F.col(text).cast("string"), "\n")
    keys = F.array_distinct(F.filter(F.transform(lines, line_key), lambda key: F.length(key) >= length))
    rows = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), F.explode(keys).alias("key"))
    return rows.select("doc_id", F.substring(F.unhex(F.sha2("key", 256)), 1, 16).alias("key"))


def _added_up(rows: DataFrame) -> DataFrame:
    return rows.groupBy("key").agg(
        F.count("*").alias("rows"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last")
    )


COUNTS = "key binary, rows long, first long, last long, version int"
FILTERS = "shard int, segment int, places binary"


class LineIndex:
    """The lines of the documents put in so far. Objects are not changed: `insert` and
    `delete` return the index after the change, and this one can still be read.

    Only keys of at least `length` code points are indexed. Rows without an id are in no
    index. Rows of one id are one document.
    """

    def __init__(self, spark: SparkSession, root: str, version: int, shards: int | None, length: int, buckets: int):
        self.spark, self.root, self.version = spark, root, version
        self.shards, self.length, self.buckets = shards, length, buckets

    @classmethod
    def create(cls, spark: SparkSession, root: str, length: int = LENGTH, shards: int | None = None, buckets: int = BUCKETS) -> LineIndex:
        """An empty index in a new folder. `shards` is set by the first insert, from the
        number of its lines, if it is not given; a shard may grow without bound after."""
        index = cls(spark, root, 0, shards, length, buckets)
        index._commit()
        return index

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> LineIndex:
        """The latest version that was committed."""
        last = spark.read.schema("version int, shards int, length int, buckets int").parquet(f"{root}/commits")
        row = last.orderBy(F.desc("version")).first()
        return cls(spark, root, row.version, row.shards, row.length, row.buckets)

    def _commit(self) -> None:
        row = [(self.version, self.shards, self.length, self.buckets)]
        told = self.spark.createDataFrame(row, "version int, shards int, length int, buckets int")
        told.coalesce(1).write.mode("append").parquet(f"{self.root}/commits")

    def _at(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/at-{version}"

    def _next(self, shards: int | None) -> LineIndex:
        return LineIndex(self.spark, self.root, self.version + 1, shards, self.length, self.buckets)

    def _all(self, name: str, schema: str) -> DataFrame:
        """The rows of a table that all versions so far have added."""
        paths = [self._at(name, v) for v in range(1, self.version + 1)]
        read = self.spark.read.schema(schema)
        return read.parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def postings(self) -> DataFrame:
        """(doc_id, key) of the documents that are in."""
        rows = self._all("postings", "doc_id long, key binary, version int")
        gone = self._all("gone", "doc_id long, version int").groupBy("doc_id").agg(F.max("version").alias("until"))
        if self.version:
            rows = rows.join(gone, "doc_id", "left").where("until is null or version > until")
        return rows.select("doc_id", "key")

    def counts(self) -> DataFrame:
        """(key, rows, first, last) of the lines that some document holds."""
        now = self._all("counts", COUNTS).groupBy("key").agg(F.max(F.struct("version", "rows", "first", "last")).alias("now"))
        return now.select("key", "now.rows", "now.first", "now.last").where("rows > 0")

    def _filters(self) -> DataFrame:
        if not self.version:
            return self.spark.createDataFrame([], FILTERS)
        return self.spark.read.schema(FILTERS).parquet(self._at("filters", self.version))

    def _by_shard(self, keys: DataFrame, schema: str, work: Callable[[CuckooFilter, list[bytes], int], pa.Table]) -> DataFrame:
        """`work(filter, keys, shard)` for every shard."""
        buckets = self.buckets
        shard = F.pmod(F.xxhash64("key"), F.lit(self.shards)).cast("int")

        def both(keys: pa.Table, filters: pa.Table) -> pa.Table:
            held = sorted(zip(filters["segment"].to_pylist(), filters["places"].to_pylist(), strict=True))
            shard = (keys if keys.num_rows else filters)["shard"][0].as_py()
            return work(CuckooFilter(buckets, [places for _, places in held]), keys["key"].to_pylist(), shard)

        rows = keys.select(shard.alias("shard"), "key")
        return rows.groupBy("shard").cogroup(self._filters().groupBy("shard")).applyInArrow(both, schema)

    def seen(self, keys: DataFrame) -> DataFrame:
        """(key): those of the different `keys` that the filters have, with few false ones."""

        def work(known: CuckooFilter, keys: list[bytes], shard: int) -> pa.Table:
            found = known.has(_numbers(keys)) if keys else []
            return pa.table({"key": pa.array([k for k, yes in zip(keys, found, strict=True) if yes], pa.binary())})

        return self._by_shard(keys, "key binary", work)

    def _refiltered(self, keys: DataFrame, put: bool) -> DataFrame:
        """The filters after these keys were put in or taken out."""

        def work(known: CuckooFilter, keys: list[bytes], shard: int) -> pa.Table:
            if keys:
                (known.put if put else known.take)(_numbers(sorted(keys)))
            rows = known.rows()
            columns = [pa.array([shard] * len(rows), pa.int32()), pa.array(range(len(rows)), pa.int32()), pa.array(rows, pa.binary())]
            return pa.table(columns, ["shard", "segment", "places"])

        return self._by_shard(keys, FILTERS, work)

    def insert(self, docs: DataFrame, text: str = "text", doc_id: str = "doc_id", increments: int = 1) -> LineIndex:
        """The index with these documents as well, put in by as many increments. An id must
        not be in the index already; ids are dealt to increments by their hash."""
        found = postings(docs, text, doc_id, self.length).withColumn("step", F.pmod(F.xxhash64("doc_id"), F.lit(increments)).cast("int"))
        found = saved(found, "postings")
        now = self
        if now.shards is None:
            now = LineIndex(self.spark, self.root, self.version, max(1, math.ceil(found.count() / SHARD_LINES)), self.length, self.buckets)
        for step in range(increments):
            now = now._insert(found.where(F.col("step") == step).select("doc_id", "key"))
        return now

    def _insert(self, rows: DataFrame) -> LineIndex:
        after = self._next(self.shards)
        told = F.lit(after.version).alias("version")
        rows.select("doc_id", "key", told).write.mode("overwrite").parquet(self._at("postings", after.version))
        self.spark.createDataFrame([], "doc_id long, version int").write.mode("overwrite").parquet(self._at("gone", after.version))
        fresh = saved(_added_up(rows), "lines")
        if self.version:
            # Only what the filters may have seen is looked up.
            maybe = saved(self.seen(fresh.select("key")), "maybe")
            before = saved(
                self.counts().join(maybe, "key", "left_semi").select(
                    "key", F.col("rows").alias("rows_0"), F.col("first").alias("first_0"), F.col("last").alias("last_0")
                ),
                "before",
            )
            merged = fresh.join(before, "key", "left").select(
                "key",
                (F.col("rows") + F.coalesce("rows_0", F.lit(0))).alias("rows"),
                F.least("first", "first_0").alias("first"),
                F.greatest("last", "last_0").alias("last"),
            )
            new = fresh.join(before, "key", "left_anti").select("key")
        else:
            merged, new = fresh, fresh.select("key")
        merged.select("key", "rows", "first", "last", told).write.mode("overwrite").parquet(self._at("counts", after.version))
        self._refiltered(new, put=True).write.mode("overwrite").parquet(self._at("filters", after.version))
        after._commit()
        return after

    def delete(self, ids: DataFrame, doc_id: str = "doc_id") -> LineIndex:
        """The index without the documents of these ids. Ids that are not in change nothing."""
        after = self._next(self.shards)
        told = F.lit(after.version).alias("version")
        gone = ids.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id")).distinct()
        gone = saved(gone, "gone")
        gone.select("doc_id", told).write.mode("overwrite").parquet(self._at("gone", after.version))
        self.spark.createDataFrame([], "doc_id long, key binary, version int").write.mode("overwrite").parquet(self._at("postings", after.version))
        held = self.postings()
        lost = _added_up(held.join(gone, "doc_id", "left_semi")).select("key", F.col("rows").alias("fewer"), F.col("first").alias("lost_first"), F.col("last").alias("lost_last"))
        less = saved(lost.join(self.counts(), "key").withColumn("rows", F.col("rows") - F.col("fewer")), "less")
        # Where the first or last document went, what is left tells the new one.
        edge = less.where("rows > 0 and (lost_first = first or lost_last = last)").select("key")
        left = _added_up(held.join(gone, "doc_id", "left_anti").join(edge, "key", "left_semi"))
        left = left.select("key", F.col("first").alias("first_1"), F.col("last").alias("last_1"))
        moved = less.join(left, "key", "left").select(
            "key", "rows", F.coalesce("first_1", "first").alias("first"), F.coalesce("last_1", "last").alias("last"), told
        )
        moved.write.mode("overwrite").parquet(self._at("counts", after.version))
        none_left = less.where("rows = 0").select("key")
        if self.version and self.shards:
            filters = self._refiltered(none_left, put=False)
        else:
            filters = self._filters()
        filters.write.mode("overwrite").parquet(self._at("filters", after.version))
        after._commit()
        return after

    def kept(self, docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
        """(doc_id, kept, n_lines, n_dropped) of each row of `docs`: its text without the
        lines that a document of a smaller id in the index holds as well, how many lines it
        had, and how many went.

        Lines are parted by line feeds; null and empty texts are one empty line. Lines whose
        key is shorter than the index asks for stay, as do all lines of rows without an id
        and of ids that are not in the index. Repeated rows are treated alike. Other
        columns are ignored.
        """
        length = self.length
        # Written first, so that the join lies between two shuffles and a line of very many
        # documents can be dealt over tasks.
        shared = saved(self.counts().where("first <> last").select("key", "first"), "shared")
        drops = self.postings().join(shared, "key").where("doc_id <> first").groupBy("doc_id").agg(F.collect_set("key").alias("drops"))
        rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
        none = F.lit(None).cast("array<binary>").alias("drops")
        named = rows.where("doc_id is not null").join(drops, "doc_id", "left")
        both = named.select("doc_id", "text", "drops").union(rows.where("doc_id is null").select("doc_id", "text", none))

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    kept, lines, dropped = [], [], []
                    for whole, drops in zip(part.column(1), part.column(2), strict=True):
                        whole, drops = whole.as_py(), drops.as_py()
                        if not drops:
                            kept.append(whole)
                            lines.append(whole.count("\n") + 1)
                            dropped.append(0)
                            continue
                        drops, every = set(drops), whole.split("\n")
                        keys = (line.strip(BLANKS).translate(_LOWER) for line in every)
                        stay = [line for line, key in zip(every, keys, strict=True) if len(key) < length or _digest(key) not in drops]
                        kept.append("\n".join(stay))
                        lines.append(len(every))
                        dropped.append(len(every) - len(stay))
                    columns = [part.column(0), pa.array(kept, pa.string()), pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "kept", "n_lines", "n_dropped"])

        return both.mapInArrow(work, "doc_id long, kept string, n_lines long, n_dropped long")
