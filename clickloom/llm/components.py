"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.store import saved


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour."""
    both = links.select("a", "b").union(links.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """The node and its smaller neighbours are tied to the smallest of them. `a > b` holds."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b")))


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the smallest node that each linked node can reach.

    Nodes are numbers, or structs of numbers. Links with a null end and from a node to itself tie nothing and are
    left out; repeated and reversed links count once. A node without links has no row.
    Every round at least halves the longest chain and writes its links to the shared
    folder; only two numbers a round reach the driver.
    """
    ends = links.select(F.col(a).alias("x"), F.col(b).alias("y"))
    now = saved(
        ends.where("x <> y")
        .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
        .distinct(),
        "links",
    )
    state = _state(now)
    while state[0]:
        now = saved(_small_star(_large_star(now).distinct()).distinct(), "links")
        before, state = state, _state(now)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
