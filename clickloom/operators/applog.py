"""App logs: validity, kind of line, and flattening into one table per event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom import schemas
from clickloom.functions.once import once
from clickloom.functions.times import from_epoch_millis

# Thirteen digits, then the part up to the next `|`, in braces once whitespace and
# control characters around it are off.
VALID_LINE = r"^[0-9]{13}\|[\x00-\x20]*\{[^|]*\}[\x00-\x20]*(\||\z)"


def is_valid(line: Column) -> Column:
    return F.coalesce(line.rlike(VALID_LINE), F.lit(False))


def clean(lines: DataFrame) -> DataFrame:
    """Lines (`value`) that hold a time stamp and a braced body."""
    return lines.where(is_valid(F.col("value")))


def log_type(line: Column, by: str = "text") -> Column:
    """`start` or `event`. By default the word anywhere in the line decides; with
    by='event_name' only an event of that name does."""
    if by not in ("text", "event_name"):
        raise ValueError(f"log type goes by text or event_name, not {by!r}")
    hit = line.contains("start") if by == "text" else line.rlike('"en" *: *"start"')
    return F.when(hit, "start").otherwise("event")


def with_log_type(lines: DataFrame, by: str = "text") -> DataFrame:
    return lines.withColumn("log_type", log_type(F.col("value"), by))


def parse(lines: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Clean lines to time, app key, the common fields, and the event array. Only the common
    fields asked for are parsed; without `fields` all are."""
    stamp = F.substring_index("value", "|", 1)
    body = F.get(F.split("value", "\\|", 3), F.lit(1))
    log = once(F.from_json(body, schemas.app_log(schemas.COMMON_FIELDS if fields is None else fields)))
    return lines.select(from_epoch_millis(stamp).alias("log_time"), log.alias("log")).select(
        "log_time", F.col("log.ap").alias("ap"), "log.cm.*", F.col("log.et").alias("et")
    )


# The common fields that events carry on.
EVENT_COMMON = ["mid", "uid"]


def events(logs: DataFrame) -> DataFrame:
    """Parsed logs to one row per event, with its place in the line."""
    return logs.select("log_time", "ap", *EVENT_COMMON, F.posexplode("et").alias("position", "event")).select(
        "log_time",
        "ap",
        *EVENT_COMMON,
        "position",
        from_epoch_millis(F.col("event.ett")).alias("event_time"),
        F.col("event.en").alias("event_name"),
        F.col("event.kv").alias("kv"),
    )


def write_events(lines: DataFrame, folder: str) -> None:
    """Raw lines to a table of their events, a folder for each event name: the log is parsed
    once, and each of the event tables then reads its own folder only."""
    parsed = events(parse(clean(lines), EVENT_COMMON))
    parsed.write.mode("overwrite").partitionBy("event_name").parquet(folder)


def event_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of all event names, out of what `write_events` wrote."""
    written = spark.read.schema(WRITTEN).parquet(folder)
    return {name: event_table(written, name) for name in schemas.EVENT_FIELDS}


WRITTEN = """log_time timestamp, ap string, mid string, uid string, position int, event_time timestamp,
    kv string, event_name string"""


def event_table(events: DataFrame, name: str) -> DataFrame:
    """The events of one name, their fields as typed columns."""
    fields = once(F.from_json("kv", schemas.EVENT_FIELDS[name])).alias("fields")
    return (
        events.where(F.col("event_name") == name)
        .select("log_time", "uid", "position", "event_time", fields)
        .select("log_time", "uid", "position", "event_time", "fields.*")
    )
