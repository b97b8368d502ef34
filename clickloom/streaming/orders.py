"""Order outcomes on a stream of order_id, event_type, ts, seq.

A join of creates with pays would hand out every pay of an order for every create.
Blocks look up the next pay only, and give each create exactly one outcome.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from clickloom.operators import patterns
from clickloom.operators.patterns import ORDER_LIMIT
from clickloom.streaming.blocks import behind_watermark, closed_rows, opened

# Three blocks a limit: an outcome is known at most a third of the limit after its deadline.
BLOCKS_PER_LIMIT = 3
FIELDS = ["seq", "event_type"]


def order_blocks(orders: DataFrame, limit: int = ORDER_LIMIT, delay: str = "0 seconds") -> DataFrame:
    """Creates and pays by order and block, with the time of the first pay up to a limit
    after the block."""
    width = limit // BLOCKS_PER_LIMIT
    known = behind_watermark(F.col("event_type").isin("create", "pay"), "ts")
    later = (F.col("us") >= F.col("block") + width) & (F.col("event_type") == "pay")
    return closed_rows(
        orders.withWatermark("ts", delay).where(known),
        "order_id",
        FIELDS,
        width,
        None,
        after=limit,
        edge=F.min(F.when(later, F.struct("us", *FIELDS))),
    )


def outcomes_of(blocks: DataFrame, limit: int = ORDER_LIMIT) -> DataFrame:
    """One outcome for every create in the blocks."""
    return patterns.outcomes_from(patterns.next_pay_in_blocks(opened(blocks, "order_id", FIELDS)), limit)
