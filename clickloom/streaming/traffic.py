"""Sliding counts and rankings on streams."""

from __future__ import annotations

from collections.abc import Iterator
from math import gcd

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from clickloom.operators import traffic
from clickloom.streaming.blocks import behind_watermark

MILLIS = "{} milliseconds"


def sliding_counts(
    events: DataFrame, key: str, length: int, slide: int, delay: str, ts: str = "ts", only: Column | None = None
) -> DataFrame:
    """Events per key and window, each window once, when the watermark passes its end.

    Use with append mode. Events are counted into panes first, the pieces that no
    window border cuts; a pane that is closed goes to the windows over it. So an event
    costs one update, and the state holds one number per key and open pane, and per key
    and open window of closed panes. Events that `only` leaves out are not counted but
    move the watermark. Rows for panes that are closed already are late and dropped.
    """
    pane = gcd(length, slide)
    marked = events.withWatermark(ts, delay)
    if only is not None:
        marked = marked.where(behind_watermark(only, ts))
    panes = marked.groupBy(F.window(ts, MILLIS.format(pane)).alias("pane"), key).agg(F.count("*").alias("n"))
    window = F.window(F.window_time("pane"), MILLIS.format(length), MILLIS.format(slide))
    return (
        panes.groupBy(window.alias("window"), key)
        .agg(F.sum("n").alias("count"))
        .select(F.unix_millis("window.end").alias("window_end"), key, "count")
    )


def pane_end(ts: str, length: int, slide: int) -> Column:
    """When the pane of a row closes, in epoch milliseconds: from then on it is late."""
    ms, pane = F.unix_millis(ts), gcd(length, slide)
    return ms - F.pmod(ms, F.lit(pane)) + pane


def ranked(counts: DataFrame, key: str, n: int) -> DataFrame:
    """The `n` highest counts of every window, with their rank, as a stream: the rows of
    `traffic.rank_windows`, ties to the smaller key, null first.

    Goes behind `sliding_counts` in one query, so the results can go straight to the
    exactly-once file sink. All counts of a window come out of their aggregate in one
    batch, the one whose watermark passes its end, so the ranking keeps no state. Every
    task cuts its counts to `n` a window before they are shuffled by window: it holds that
    many for each window that closes in the batch, and a window is ranked from at most `n`
    rows of each task, however many keys it has.
    """
    layout = counts.withColumn("rank", F.lit(0)).schema

    def highest(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
        """The first `n` of every window and their places."""
        orders = [("window_end", "ascending"), ("count", "descending"), (key, "ascending")]
        order = pc.sort_indices(table, sort_keys=orders, null_placement="at_start")
        table = table.take(order)
        ends = table["window_end"].to_numpy()
        starts = np.flatnonzero(np.r_[True, ends[1:] != ends[:-1]]) if len(ends) else np.zeros(0, int)
        places = np.arange(len(ends)) - np.repeat(starts, np.diff(np.r_[starts, len(ends)]))
        return table.filter(pa.array(places < n)), places[places < n]

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            kept = highest(table if kept is None else pa.concat_tables([kept, table]))[0]
        if kept is not None:
            yield from kept.combine_chunks().to_batches()

    def of_window(table: pa.Table) -> pa.Table:
        table, places = highest(table)
        return table.append_column("rank", pa.array(places + 1, pa.int32()))

    return counts.mapInArrow(of_task, counts.schema).groupBy("window_end").applyInArrow(of_window, layout)


def hot_items(behaviors: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """Views per item over an hour, every five minutes; behaviour comes in time order, or
    late by `delay` at most."""
    viewed = F.col("behavior") == "pv"
    return sliding_counts(behaviors, "item_id", traffic.ITEM_WINDOW, traffic.ITEM_SLIDE, delay, only=viewed)


def url_traffic(requests: DataFrame, delay: str = "10 seconds") -> DataFrame:
    """GET requests per url over a minute, every five seconds; rows may be late by `delay`."""
    fetched = F.col("method") == "GET"
    return sliding_counts(requests, "url", traffic.URL_WINDOW, traffic.URL_SLIDE, delay, only=fetched)
