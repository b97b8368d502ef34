"""Blocks of a key's timeline on a stream: handed on whole, once the watermark is past."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MICROS = "{} microseconds"


def is_home(us: str | Column, block: str | Column, width: int) -> Column:
    """True for a time inside the block, false for what belongs to its neighbours."""
    us, block = (F.col(c) if isinstance(c, str) else c for c in (us, block))
    return (us >= block) & (us < block + width)


def behind_watermark(condition: Column, ts: str) -> Column:
    """`condition`, for a filter that stays behind the watermark: rows that it drops move
    the watermark too. The optimizer would pull a filter in front of it that does not need
    the time; it does not look into a function over the time."""
    return F.exists(F.array(ts), lambda t: t.isNotNull() & condition)


def watermarked(events: DataFrame, key: str, delay: str | None) -> DataFrame:
    marked = events if delay is None else events.withWatermark("ts", delay)
    return marked.where(behind_watermark(F.col(key).isNotNull(), "ts"))


def closed_rows(
    events: DataFrame,
    key: str,
    fields: list[str],
    width: int,
    delay: str | None,
    before: int = 0,
    after: int = 0,
    edge: Column | None = None,
) -> DataFrame:
    """The rows of a block once it has closed: key, block, `us`, `fields`, how many such rows
    there were (`copies`), and `edge`.

    A sliding window that is longer than its slide gives each row to its own block and to
    the blocks it is near to. With `edge`, an aggregate that gives a struct of `us` and
    `fields`, only home rows come out one by one; what the neighbours hold comes as one row
    without `us` and with the `edge` over the rows that are not home. Without, the
    neighbours' rows come out as well.

    Every state value is of constant size: a row of a key is a group of its own, so the
    rows of a flooded key are spread over all tasks, and nothing is put into lists. A
    window leaves the state when the watermark passes its end. With `delay` None the events
    have a watermark already.
    """
    length, offset = before + width + after, -before % width
    window = F.window("ts", MICROS.format(length), MICROS.format(width), MICROS.format(offset))
    block = F.unix_micros("window.start") + before
    rows = (
        watermarked(events, key, delay)
        .withColumn("us", F.unix_micros("ts"))
        .select(window.alias("window"), key, "us", *fields)
        .withColumn("block", block)
    )
    if edge is None:
        held, beyond = [F.col(c) for c in ("us", *fields)], F.lit(None)
    else:
        home = is_home("us", "block", width)
        held, beyond = [F.when(home, F.col(c)).alias(c) for c in ("us", *fields)], F.when(F.col("us").isNull(), F.col("edge"))
    aggregates = [F.count("*").alias("copies")] + ([] if edge is None else [edge.alias("edge")])
    closed = rows.groupBy("window", key, *held).agg(*aggregates)
    return closed.select(key, block.alias("block"), "us", *fields, "copies", *([] if edge is None else [beyond.alias("edge")]))


def opened(closed: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Closed rows as single rows; `home` is false for the one that stands for the
    neighbours, which has the time it is at."""
    if "edge" not in closed.columns:
        single = closed.withColumn("home", F.lit(True))
    else:
        home = F.col("us").isNotNull()
        values = {c: F.when(home, F.col(c)).otherwise(F.col("edge")[c]) for c in ("us", *fields)}
        single = closed.where("us is not null or edge is not null").withColumns(
            {"copies": F.when(home, F.col("copies")).otherwise(1), "home": home, **values}
        )
    repeated = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return single.select(key, "block", "us", *fields, "home", repeated.alias("copy")).drop("copy")
