"""Event patterns per key: login bursts, back-to-back failures, order outcomes.

Times are epoch microseconds in `us`; `seq` orders rows of the same time. Each
pattern comes down to the nearest value before or after a row. Batch looks for it
in the whole key, streams in a block of time; what follows is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.operators.nearest import PIECE_ROWS, in_piece, nearest

SECOND = 1_000_000
LOGIN_LIMIT = 2 * SECOND
ORDER_LIMIT = 15 * 60 * SECOND


def known_rows(events: DataFrame, key: str) -> DataFrame:
    """Rows without key or time are in no pattern."""
    return events.where(F.col(key).isNotNull() & F.col("us").isNotNull())


# Login bursts


def failures_by_instant(logins: DataFrame) -> DataFrame:
    """Failures that share user and time as one row: how many, and the first of them."""
    return (
        known_rows(logins, "user_id")
        .where(F.col("event_type") == "fail")
        .groupBy("user_id", "us")
        .agg(F.count("*").alias("n"), F.min(F.struct("seq", "ip")).alias("head"))
    )


def burst_marks(instants: DataFrame, limit: int) -> DataFrame:
    """Each failure twice: as itself at its time, and as a probe sent back by `limit`.

    The anchor of a failure is the first failure at or after its probe. Walking
    backwards that is the last failure seen, so finding it is linear however dense
    a burst is.
    """
    time = F.col("us")
    failure = F.struct(time.alias("at"), F.lit(0).alias("probe"), time.alias("seen"))
    probe = F.struct((time - limit).alias("at"), F.lit(1).alias("probe"), F.lit(None).cast("bigint").alias("seen"))
    return instants.select(*instants.columns, F.inline(F.array(failure, probe)))


def _mark_order() -> list[Column]:
    """Backwards in time; a failure comes before a probe of the same time."""
    return [-F.col("at"), F.col("probe").cast("bigint")]


def bursts_from(marks: DataFrame, *keys: str) -> DataFrame:
    """Groups of failures with the same anchor, if more than one. `near` holds the anchor."""
    return (
        marks.where("probe = 1")
        .groupBy("user_id", *keys, F.col("near").alias("anchor"))
        .agg(F.sum("n").alias("failures"), F.min(F.struct("us", "head")).alias("first"))
        .where(F.col("failures") > 1)
        .select("user_id", *keys, "anchor", "first.head.ip", "first.us", "first.head.seq", "failures")
    )


def bursts_in_blocks(instants: DataFrame, limit: int) -> DataFrame:
    """Bursts per `block`, with their anchor."""
    marks = in_piece(burst_marks(instants, limit), ["user_id", "block"], _mark_order(), F.col("seen"))
    return bursts_from(marks, "block")


def login_bursts(logins: DataFrame, limit: int = LOGIN_LIMIT, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Groups of more than one failure of a user; the first failure of each.

    A failure stays pending until `limit` after the earliest pending one, which is
    the earliest within `limit` before it. Failures that share this anchor form a group.
    """
    marks = nearest(
        burst_marks(failures_by_instant(logins), limit),
        "user_id",
        _mark_order(),
        F.col("seen"),
        piece_rows,
    )
    return bursts_from(marks).drop("anchor")


# Back-to-back failures


def login_event() -> Column:
    return F.struct("us", "seq", "ip", "event_type")


def pairs_from(rows: DataFrame, limit: int) -> DataFrame:
    """Failures whose previous event, in `near`, is a failure less than `limit` before."""
    return (
        rows.where((F.col("event_type") == "fail") & (F.col("near.event_type") == "fail"))
        .where(F.col("us") - F.col("near.us") < limit)
        .select("user_id", F.col("near.ip").alias("first_ip"), F.col("ip").alias("second_ip"), "us", "seq")
    )


def previous_in_blocks(rows: DataFrame) -> DataFrame:
    """Rows that are `home` in their block; the one that is not is the last event before it."""
    found = in_piece(rows, ["user_id", "block"], [F.col("us"), F.col("seq")], login_event())
    return found.where("home")


def login_pairs(logins: DataFrame, limit: int = LOGIN_LIMIT, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """A failure directly followed by a failure of the same user less than `limit` later.
    Any other event in between breaks the pair."""
    rows = nearest(
        known_rows(logins, "user_id").select("user_id", "us", "seq", "ip", "event_type"),
        "user_id",
        [F.col("us"), F.col("seq")],
        login_event(),
        piece_rows,
    )
    return pairs_from(rows, limit)


# Order outcomes


def _pay_time() -> Column:
    return F.when(F.col("event_type") == "pay", F.col("us"))


def outcomes_from(rows: DataFrame, limit: int) -> DataFrame:
    """Status of every create from the time of its next pay, in `near`."""
    in_time = F.col("near") - F.col("us") < limit
    return rows.where(F.col("event_type") == "create").select(
        "order_id",
        "us",
        "seq",
        F.when(in_time, F.lit("success")).otherwise(F.lit("timeout")).alias("status"),
        F.when(in_time, F.col("near")).alias("pay_us"),
    )


def _backwards() -> list[Column]:
    return [-F.col("us"), -F.col("seq")]


def next_pay_in_blocks(rows: DataFrame) -> DataFrame:
    """Rows that are `home` in their block; the one that is not is the first pay after it."""
    found = in_piece(rows, ["order_id", "block"], _backwards(), _pay_time())
    return found.where("home")


def order_outcomes(orders: DataFrame, limit: int = ORDER_LIMIT, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Per create: `success` with the time of the first later pay if that is less than
    `limit` away, else `timeout`. One pay settles every create that is open.

    Only the next pay is looked up; no create is ever paired with all pays.
    """
    known = known_rows(orders, "order_id").where(F.col("event_type").isin("create", "pay"))
    rows = nearest(
        known.select("order_id", "us", "seq", "event_type"),
        "order_id",
        _backwards(),
        _pay_time(),
        piece_rows,
    )
    return outcomes_from(rows, limit)
