"""Starting streams. Each has a folder with its checkpoint and, for file sinks, its output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def _limited(reader, files_per_batch: int | None):
    return reader if files_per_batch is None else reader.option("maxFilesPerTrigger", files_per_batch)


def text_lines(
    spark: SparkSession, path: str, glob: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """New text files of a folder as a stream of lines (`value`)."""
    reader = _limited(spark.readStream, files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path)


def table_rows(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """New parquet files of a folder as a stream of rows.

    A limit of files a batch cuts the input into micro-batches, and what comes behind the
    watermark of the batch before is late. So a limit asks for files in the order of their
    times, as `in_time_order` writes them, or for a delay that covers their disorder.
    """
    return _limited(spark.readStream.schema(schema), files_per_batch).parquet(path)


def in_time_order(rows: DataFrame, folder: str, ts: str, files: int) -> str:
    """Writes `rows` to about `files` files, none of which overlaps another in `ts`, and gives
    the files modification times in that order, which is the order in which streams read
    them. However many files make a batch, no row is behind the watermark then. For
    replaying a table of any order as a stream; raises where the store keeps no such times.
    """
    rows.repartitionByRange(files, ts).sortWithinPartitions(ts).write.parquet(folder)
    jvm, conf = rows.sparkSession._jvm, rows.sparkSession._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(conf)

    def listed() -> list:
        found = [f for f in store.listStatus(path) if f.getPath().getName().startswith("part-")]
        return sorted(found, key=lambda f: f.getPath().getName())

    parts = listed()
    start = min((f.getModificationTime() for f in parts), default=0) // 1000 * 1000 - 1000 * len(parts)
    for i, part in enumerate(parts):
        store.setTimes(part.getPath(), start + 1000 * i, -1)
    times = [f.getModificationTime() for f in listed()]
    if any(a >= b for a, b in zip(times, times[1:])):
        raise ValueError(f"the store of {folder} does not keep modification times")
    return folder


def _until_done(writer, available_now: bool):
    return writer.trigger(availableNow=True) if available_now else writer


def into_files(
    stream: DataFrame, folder: str, split_by: list[str] | None = None, available_now: bool = False
) -> StreamingQuery:
    """Append to parquet, exactly once. `split_by` gives every value its own folder: the
    way to route log types, or to keep timeouts apart from successes."""
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", f"{folder}/checkpoint")
    if split_by:
        writer = writer.partitionBy(*split_by)
    return _until_done(writer.format("parquet").option("path", f"{folder}/data"), available_now).start()


def into_batches(
    stream: DataFrame,
    folder: str,
    result_of: Callable[[DataFrame], DataFrame],
    split_by: list[str] | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Append `result_of` every micro-batch to parquet: for what streams cannot do
    themselves, such as ranking windows that have closed.

    All rows of a window or block close in the same batch, so the result of the batch
    is the whole result. Each batch has its own folder, and replaces it when it is
    run again after a failure. `split_by` as in into_files.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # The folder appears under its name when it is whole, so readers never see a part.
        target = f"{folder}/data/batch_id={batch_id}"
        staged = f"{folder}/staged/batch_id={batch_id}"
        result_of(batch).write.mode("overwrite").partitionBy(*split_by or []).parquet(staged)
        _move(batch.sparkSession, staged, target)

    writer = stream.writeStream.outputMode("append").option("checkpointLocation", f"{folder}/checkpoint")
    return _until_done(writer.foreachBatch(write), available_now).start()


def _move(spark: SparkSession, source: str, target: str) -> None:
    """Puts a folder in the place of another, by one rename."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    here, there = (jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    store = here.getFileSystem(conf)
    store.mkdirs(there.getParent())
    store.delete(there, True)
    if not store.rename(here, there):
        raise OSError(f"cannot rename {source} to {target}")


def into_console(stream: DataFrame, folder: str, rows: int = 2**31 - 1, available_now: bool = False) -> StreamingQuery:
    """Print each batch, all of its rows unless the caller asks for fewer."""
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", f"{folder}/checkpoint")
    writer = writer.format("console").option("truncate", "false").option("numRows", rows)
    return _until_done(writer, available_now).start()


def apart_from_late(
    stream: DataFrame, folder: str, ts: str, closes: Column, delay_ms: int = 0, available_now: bool = False
) -> StreamingQuery:
    """Writes every row of `stream`, a stream without aggregates, to one of two tables:
    what an aggregate behind a watermark still takes (`in_time`), and what it would drop
    (`quarantined`).

    `closes` is when the last state that a row belongs to is closed, in epoch
    milliseconds, such as the end of its pane. As with a watermark of `delay_ms`, a row is late
    if that is not after the newest `ts` of the batches before, less the delay. Rows
    without a time are in time: no watermark drops them. So a stream with the same delay that
    reads `in_time` drops nothing, and both tables together are the input.

    A batch that is run again replaces its own rows and its own mark.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = None
        if batch_id:
            marks = spark.read.schema("newest bigint, batch_id bigint").parquet(f"{folder}/marks")
            mark = marks.where(F.col("batch_id") < batch_id).agg(F.max("newest")).first()[0]
        late = F.lit(False) if mark is None else F.coalesce(closes <= mark - delay_ms, F.lit(False))
        target, staged = f"{folder}/data/batch_id={batch_id}", f"{folder}/staged/batch_id={batch_id}"
        told = batch.withColumn("late", late)
        for side, name in ((~F.col("late"), "in_time"), (F.col("late"), "late")):
            told.where(side).drop("late").write.mode("overwrite").parquet(f"{staged}/kind={name}")
        written = spark.read.schema(batch.schema).parquet(f"{staged}/kind=in_time")
        newest = written.agg(F.max(F.unix_millis(ts)).alias("newest"))
        newest.write.mode("overwrite").parquet(f"{folder}/marks/batch_id={batch_id}")
        _move(spark, staged, target)

    writer = stream.writeStream.outputMode("append").option("checkpointLocation", f"{folder}/checkpoint")
    return _until_done(writer.foreachBatch(write), available_now).start()


def in_time(spark: SparkSession, folder: str, schema: str | StructType, files_per_batch: int | None = None) -> DataFrame:
    """The rows that `apart_from_late` has found in time, as a stream in the order of batches."""
    reader = _limited(spark.readStream.schema(schema), files_per_batch)
    return reader.parquet(f"{folder}/data/batch_id=*/kind=in_time")


def quarantined(spark: SparkSession, folder: str, schema: str | StructType) -> DataFrame:
    """The rows that came late, as a table."""
    return spark.read.schema(schema).parquet(f"{folder}/data/batch_id=*/kind=late")


class LateRows(Exception):
    """A bounded run dropped rows, or cannot tell whether it did."""


def late_rows(query: StreamingQuery) -> int:
    """Rows that the batches of this run dropped because they came behind the watermark.

    Raises if Spark has forgotten some of the batches: a count that leaves them out would
    look like none.
    """
    batches = {p["batchId"]: p["stateOperators"] for p in query.recentProgress}
    last = query.lastProgress
    if last is not None and batches and len(batches) >= _kept(query) and min(batches) > 0:
        raise LateRows("more batches ran than Spark keeps progress of")
    return sum(o["numRowsDroppedByWatermark"] for operators in batches.values() for o in operators)


def _kept(query: StreamingQuery) -> int:
    spark = SparkSession.active()
    return int(spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100"))


def finished(query: StreamingQuery, quarantine: DataFrame | None = None, most: int = 0) -> StreamingQuery:
    """Waits for a bounded run; fails if it failed or dropped rows as late, or if more than
    `most` rows are in its `quarantine`."""
    query.awaitTermination()
    if (late := late_rows(query)) > 0:
        raise LateRows(f"{late} rows came behind the watermark and were dropped")
    if quarantine is not None and (late := quarantine.count()) > most:
        raise LateRows(f"{late} rows came behind the watermark and are in quarantine")
    return query
