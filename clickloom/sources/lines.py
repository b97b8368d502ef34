"""Delimited text lines to typed rows. Input has one text column, `value`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions import times
from clickloom.functions.once import once
from clickloom.functions.predicates import all_of


def _behavior_fields(lines: DataFrame) -> DataFrame:
    part = F.col("part")
    return lines.select("value", once(F.split("value", ",")).alias("part")).select(
        "value",
        F.get(part, F.lit(0)).try_cast("bigint").alias("user_id"),
        F.get(part, F.lit(1)).try_cast("bigint").alias("item_id"),
        F.get(part, F.lit(2)).try_cast("int").alias("category_id"),
        F.get(part, F.lit(3)).alias("behavior"),
        F.get(part, F.lit(4)).try_cast("bigint").alias("timestamp"),
    )


def _is_behavior() -> Column:
    typed = [F.col(c).isNotNull() for c in ("user_id", "item_id", "category_id", "behavior", "timestamp")]
    return all_of(typed)


def behaviors(lines: DataFrame) -> DataFrame:
    """`user,item,category,behavior,seconds` lines that parse, with event time `ts`."""
    return (
        _behavior_fields(lines)
        .where(_is_behavior())
        .drop("value")
        .withColumn("ts", times.from_epoch_seconds(F.col("timestamp")))
    )


def bad_behaviors(lines: DataFrame) -> DataFrame:
    """The other lines, as they came, for a quarantine output."""
    return _behavior_fields(lines).where(~_is_behavior()).select("value")


def requests(lines: DataFrame) -> DataFrame:
    """Access-log lines split on single blanks: ip, user, time, method, url. Lines whose
    time does not parse have no event time and are left out; see bad_requests."""
    return _request_fields(lines).where(F.col("ts").isNotNull() & F.col("url").isNotNull()).drop("value")


def bad_requests(lines: DataFrame) -> DataFrame:
    return _request_fields(lines).where(F.col("ts").isNull() | F.col("url").isNull()).select("value")


def routed_requests(lines: DataFrame) -> DataFrame:
    """Every line once, for one output with a folder for each `quality`: `good` lines with
    their fields and no `value`, `bad` ones as they came and without fields."""
    fields = _request_fields(lines)
    good = F.col("ts").isNotNull() & F.col("url").isNotNull()
    kept = [F.when(good, F.col(c)).alias(c) for c in fields.columns if c != "value"]
    return fields.select(
        F.when(good, "good").otherwise("bad").alias("quality"), *kept, F.when(~good, F.col("value")).alias("value")
    )


def _request_fields(lines: DataFrame) -> DataFrame:
    part = F.col("part")
    return lines.select("value", once(F.split("value", " ")).alias("part")).select(
        "value",
        F.get(part, F.lit(0)).alias("ip"),
        F.get(part, F.lit(1)).alias("user_id"),
        times.parse_access_time(F.get(part, F.lit(3))).alias("ts"),
        F.get(part, F.lit(5)).alias("method"),
        F.get(part, F.lit(6)).alias("url"),
    )
