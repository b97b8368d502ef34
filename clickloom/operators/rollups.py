"""Partial results by day, kept as tables: any range of dates is answered by merging them.

Every partial is made of minima, maxima, counts and sets, so those of several days, or of
several loads of one day, merge into what one pass over the raw rows would give. The raw
rows are read once, when their day is added; a report reads one row per day and session, or
per day, key and pane, of the dates it asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from clickloom.functions import predicates, text, times
from clickloom.operators import sessions, traffic
from clickloom.sources.tables import actions_between
from clickloom.sources.tasks import TaskParams

SESSION_DAYS = """date string, session_id string, user_id bigint, start_time timestamp, end_time timestamp,
       step_length bigint, keywords array<string>, category_ids array<bigint>"""


def session_days(actions: DataFrame) -> DataFrame:
    """One row per date and session: what `merged_sessions` needs of it.

    The sets are kept whole, null left out, so that filters on them can be asked later.
    Rows without a session id belong to no session; rows without a date have a day of
    their own, which no range holds.
    """
    return (
        actions.where(F.col("session_id").isNotNull())
        .withColumn("_time", times.as_timestamp(actions, "action_time"))
        .groupBy("date", "session_id")
        .agg(
            F.min("user_id").alias("user_id"),
            F.min("_time").alias("start_time"),
            F.max("_time").alias("end_time"),
            F.count("*").alias("step_length"),
            F.sort_array(F.collect_set("search_keyword")).alias("keywords"),
            F.sort_array(F.collect_set("click_category_id")).alias("category_ids"),
        )
    )


def _union(col: str) -> Column:
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list(col))))


def _listed(values: Column) -> Column:
    return F.array_join(F.transform(values, lambda v: v.cast("string")), ",")


def merged_sessions(days: DataFrame, params: TaskParams | None = None, lists: bool = False) -> DataFrame:
    """The same rows as `sessions.rollup` of the actions of these days, dates included in
    `params` applied. Without `lists` the sets are not moved: a filter on keywords or
    categories is asked of each day's set, and only its answer is merged.
    """
    params = params or TaskParams()
    marks = {}
    if params.keywords is not None:
        marks["keyword_hit"] = F.exists("keywords", lambda k: predicates.any_match(k, params.keywords))
    if params.category_ids is not None:
        marks["category_hit"] = F.exists("category_ids", lambda c: c.cast("string").isin(list(params.category_ids)))
    aggregates = [
        F.min("user_id").alias("user_id"),
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"),
        F.sum("step_length").alias("step_length"),
    ]
    aggregates += [F.bool_or(mark).alias(name) for name, mark in marks.items()]
    if lists:
        shown = F.filter(_union("keywords"), text.is_not_empty)
        aggregates += [
            _listed(shown).alias("search_keywords"),
            _listed(_union("category_ids")).alias("click_category_ids"),
        ]
    return (
        actions_between(days, params.start_date, params.end_date)
        .groupBy("session_id")
        .agg(*aggregates)
        .withColumn("visit_length", times.seconds_between(F.col("end_time"), F.col("start_time")))
    )


def select_sessions(days: DataFrame, users: DataFrame, params: TaskParams, lists: bool = False) -> DataFrame:
    """`sessions.select_sessions` out of days instead of actions."""
    merged = merged_sessions(days, params, lists).where(sessions.hit_filter(params))
    known = users.where(sessions.user_filter(params))
    return sessions.with_users(merged.drop("keyword_hit", "category_hit"), known)


def pane_days(events: DataFrame, key: str, length: int, slide: int, ts: str = "ts") -> DataFrame:
    """Events per date, key and pane. Days end at midnight of the session's time zone; a pane
    that midnight cuts, or that two loads share, has a row in each, and they add up."""
    panes = traffic.panes(events, key, length, slide, ts)
    return panes.withColumn("date", times.day_text(F.timestamp_millis("pane")))


def merged_windows(days: DataFrame, key: str, length: int, slide: int) -> DataFrame:
    """The same rows as `traffic.sliding_counts` of the events of these days."""
    return traffic.over_panes(days, key, length, slide)


def save(days: DataFrame, folder: str) -> None:
    """Puts days into the table in `folder`, a folder per date. The dates that occur in
    `days` are replaced whole, once all of them are written; all others stay, also those
    that have no rows now. Adaptive execution gives a date as many files as its size asks for.
    """
    rows = days.hint("rebalance", F.col("date"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(folder)


def load(spark: SparkSession, folder: str, schema: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """The days of an inclusive range; other dates' folders are not read."""
    return actions_between(spark.read.schema(schema).parquet(folder), start, end)
