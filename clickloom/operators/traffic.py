"""Sliding event-time counts and their rankings."""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.operators.ranking import top_n

MINUTE = 60_000
ITEM_WINDOW, ITEM_SLIDE, ITEM_TOP = 60 * MINUTE, 5 * MINUTE, 3
URL_WINDOW, URL_SLIDE, URL_TOP = MINUTE, 5_000, 5


def sliding_counts(events: DataFrame, key: str, length: int, slide: int, ts: str = "ts") -> DataFrame:
    """Events per key and window; windows are `length` long, start every `slide` (ms).

    Events are counted once into panes, the pieces that no window border cuts, and
    only the pane counts are handed to the windows over them. An event costs one
    hash update and not length / slide of them, and a hot key is small before it
    is copied.
    """
    return over_panes(panes(events, key, length, slide, ts), key, length, slide)


def panes(events: DataFrame, key: str, length: int, slide: int, ts: str = "ts") -> DataFrame:
    """Events per key and pane (its start, ms): key, pane, n. Counts of the same pane add up."""
    pane, ms = gcd(length, slide), F.unix_millis(ts)
    return (
        events.select(F.col(key), (ms - F.pmod(ms, F.lit(pane))).alias("pane"))
        .groupBy(key, "pane")
        .agg(F.count("*").alias("n"))
    )


def over_panes(panes: DataFrame, key: str, length: int, slide: int) -> DataFrame:
    """Events per key and window, out of the counts of the panes."""
    last = F.col("pane") - F.pmod(F.col("pane"), F.lit(slide))
    reach = F.col("pane") + (gcd(length, slide) - length)
    first = reach + F.pmod(-reach, F.lit(slide))
    starts = F.when(first <= last, F.sequence(first, last, F.lit(slide).cast("bigint")))
    return (
        panes.select(key, "n", F.explode(starts).alias("start"))
        .groupBy((F.col("start") + length).alias("window_end"), key)
        .agg(F.sum("n").alias("count"))
    )


def rank_windows(counts: DataFrame, key: str, n: int) -> DataFrame:
    """The `n` highest counts of every window; the key decides a tie."""
    return top_n(counts, n, [F.desc("count"), F.col(key)], keys=["window_end"])


def hot_items(behaviors: DataFrame) -> DataFrame:
    """Views per item over an hour, every five minutes."""
    return sliding_counts(behaviors.where("behavior = 'pv'"), "item_id", ITEM_WINDOW, ITEM_SLIDE)


def url_traffic(requests: DataFrame) -> DataFrame:
    """GET requests per url over a minute, every five seconds."""
    return sliding_counts(requests.where("method = 'GET'"), "url", URL_WINDOW, URL_SLIDE)


# Words and rulers of the printed reports. Items take one blank after
# the colon, urls two.
TIME_LABEL = "时间: "
ITEM_LABELS = (" 商品ID=", " 浏览量=")
URL_LABELS = ("  URL=", "  流量=")
ITEM_RULERS = ("=" * 40, "=" * 29)
URL_RULERS = ("=" * 36, "=" * 36)


def report(ranked: DataFrame, key: str, labels: tuple[str, str], rulers: tuple[str, str]) -> DataFrame:
    """One text per window: its time, then a line per rank. Takes ranked rows, so a few a window."""
    entry = F.concat(
        F.lit("No"), F.col("rank"), F.lit(":"), F.lit(labels[0]), F.col(key), F.lit(labels[1]), F.col("count")
    )
    lines = F.transform(F.array_sort(F.collect_list(F.struct("rank", entry.alias("line")))), lambda r: r.line)
    head, foot = rulers
    return (
        ranked.groupBy("window_end")
        .agg(F.array_join(lines, "\n").alias("lines"))
        .select(
            "window_end",
            F.concat_ws(
                "\n",
                F.lit(head),
                F.concat(F.lit(TIME_LABEL), _time_label(F.col("window_end"))),
                F.col("lines"),
                F.lit(foot + "\n\n"),
            ).alias("report"),
        )
    )


def _time_label(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd HH:mm:ss.S")
