"""Login patterns on a stream of user_id, ip, event_type, ts, seq.

Each pattern is two steps: a stream that hands on closed blocks, and what to do
with a batch of them. The second step looks a block over the way the batch operator
looks a key over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.operators import patterns
from clickloom.operators.patterns import LOGIN_LIMIT
from clickloom.streaming.blocks import behind_watermark, closed_rows, is_home, opened, watermarked

# Short blocks: a stream has to answer soon.
LIMITS_PER_BLOCK = 1


def burst_blocks(logins: DataFrame, limit: int = LOGIN_LIMIT, delay: str = "0 seconds") -> DataFrame:
    """Failures by user and block; a block closes two limits after its start.

    Failures of one user and instant are counted together first, by an aggregate that
    combines before its shuffle. So a flood on one account reaches the block as one
    row per instant, a handful where event times are whole seconds.
    """
    failed = behind_watermark(F.col("event_type") == "fail", "ts")
    failures = watermarked(logins, "user_id", delay).where(failed)
    instants = failures.groupBy("user_id", "ts").agg(
        F.count("*").alias("n"), F.min(F.struct("seq", "ip")).alias("head")
    )
    return closed_rows(
        instants, "user_id", ["n", "head"], limit * LIMITS_PER_BLOCK, None, before=limit, after=limit
    )


def bursts_of(blocks: DataFrame, limit: int = LOGIN_LIMIT) -> DataFrame:
    """Bursts anchored in the blocks. The copies around a block only complete them."""
    found = patterns.bursts_in_blocks(opened(blocks, "user_id", ["n", "head"]).drop("home"), limit)
    return found.where(is_home("anchor", "block", limit * LIMITS_PER_BLOCK)).drop("anchor", "block")


PAIR_FIELDS = ["seq", "ip", "event_type"]


def pair_blocks(logins: DataFrame, limit: int = LOGIN_LIMIT, delay: str = "0 seconds") -> DataFrame:
    """All login events by user and block, with the last event of the limit before the
    block; a block closes at its end."""
    last = F.max(F.when(F.col("us") < F.col("block"), patterns.login_event()))
    return closed_rows(logins, "user_id", PAIR_FIELDS, limit * LIMITS_PER_BLOCK, delay, before=limit, edge=last)


def pairs_of(blocks: DataFrame, limit: int = LOGIN_LIMIT) -> DataFrame:
    """Pairs whose second failure is in the blocks."""
    return patterns.pairs_from(patterns.previous_in_blocks(opened(blocks, "user_id", PAIR_FIELDS)), limit)
