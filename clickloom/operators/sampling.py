"""Stratified sample of sessions: even over days, by share within the hours of a day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from clickloom.functions import text, times
from clickloom.operators.ranking import bounded


# Hexadecimal digits of the draw that sessions are counted by before they are ranked.
DIGITS = 4


def _slots(sessions: DataFrame, seed: int = 0) -> DataFrame:
    draw = F.md5(F.concat(F.col("session_id"), F.lit(str(seed))))
    return sessions.select(
        "session_id",
        "start_time",
        times.day_text(F.col("start_time")).alias("date"),
        F.date_format("start_time", "HH").alias("hour"),
        draw.alias("draw"),
        F.substring(draw, 1, DIGITS).alias("prefix"),
    )


def hour_counts(sessions: DataFrame) -> DataFrame:
    """Sessions per date and hour of their start."""
    return _slots(sessions).groupBy("date", "hour").agg(F.count("session_id").alias("session_count"))


def day_counts(hours: DataFrame) -> DataFrame:
    """Sessions per date, from the hourly counts."""
    return hours.groupBy("date").agg(F.sum("session_count").alias("session_count"))


def quotas(hours: DataFrame, total: int) -> DataFrame:
    """How many sessions to draw per date and hour; hours that get none are left out.

    Every day gets total div days, an hour its share of that, cut down to a whole
    number. Each row left has a quota of one or more and they add up to no more
    than `total`, so this table never has more than `total` rows.
    """
    # Asking for the count keeps this on the very same hourly counts as below.
    in_use = F.when(F.col("session_count") > 0, F.col("date"))
    days = hours.agg(F.count_distinct(in_use).alias("days")).scalar()
    per_day = F.floor(F.lit(total) / F.nullif(days, F.lit(0)))
    in_day = F.sum("session_count").over(Window.partitionBy("date"))
    share = (F.col("session_count") / in_day * per_day).cast("bigint")
    return (
        hours.withColumn("quota", F.least("session_count", share))
        .where("quota > 0")
        .select("date", "hour", "quota")
    )


def sample_sessions(sessions: DataFrame, total: int = 100, seed: int = 42) -> DataFrame:
    """The drawn sessions with date, hour and position in the draw.

    The draw orders an hour's sessions by a seeded hash, so it repeats on every
    run and after every lost task. Sessions are counted by the first digits of the
    hash; only those whose digits can still be drawn are ranked. However many sessions an
    hour has, that is its quota and the sessions of one digit group more. Every group but
    the last of an hour fills a part of its quota, so there are at most 2 x `total` groups.
    """
    slotted = _slots(sessions, seed)
    groups = slotted.groupBy("date", "hour", "prefix").agg(F.count("session_id").alias("n"))
    hours = groups.groupBy("date", "hour").agg(F.sum("n").alias("session_count"))
    before = Window.partitionBy("date", "hour").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    open_groups = (
        groups.join(bounded(quotas(hours, total), total), ["date", "hour"])
        .withColumn("ahead", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .where("ahead < quota")
        .select("date", "hour", "prefix", "quota")
    )
    position = F.row_number().over(Window.partitionBy("date", "hour").orderBy("draw", "session_id"))
    return (
        slotted.join(bounded(open_groups, 2 * total), ["date", "hour", "prefix"])
        .withColumn("position", position)
        .where(F.col("position") <= F.col("quota"))
        .select("date", "hour", "session_id", "start_time", "position")
    )


def sample_actions(actions: DataFrame, sample: DataFrame, total: int) -> DataFrame:
    """Actions of the drawn sessions; the sample has at most `total` rows."""
    return actions.join(bounded(sample.select("session_id"), total), "session_id", "left_semi")


def sample_report(sampled_actions: DataFrame, task_id: int) -> DataFrame:
    """Drawn sessions with start time, keywords and clicked categories, from their own actions."""
    keyword = F.col("search_keyword")
    return (
        sampled_actions.withColumn("_time", times.as_timestamp(sampled_actions, "action_time"))
        .groupBy("session_id")
        .agg(
            times.time_text(F.min("_time")).alias("start_time"),
            text.joined_set(F.when(text.is_not_empty(keyword), keyword)).alias("search_keywords"),
            text.joined_set(F.col("click_category_id")).alias("click_category_ids"),
        )
        .select(F.lit(task_id).cast("bigint").alias("task_id"), "*")
    )
