"""Category popularity and the sessions behind it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.functions.text import as_id
from clickloom.operators.ranking import bounded, top_n

KINDS = ("click", "order", "pay")


def touches(actions: DataFrame) -> DataFrame:
    """One row per category an action clicks, orders or pays: kind and category id.

    The three id columns become one array that is exploded once, so the actions
    are read once and not three times. Empty and non-numeric tokens are left out.
    """
    ids = [
        F.array(F.col("click_category_id").cast("string")),
        F.split("order_category_ids", ","),
        F.split("pay_category_ids", ","),
    ]
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), i.alias("ids")) for k, i in zip(KINDS, ids)])
    return (
        actions.select("session_id", F.inline(kinds))
        .select("session_id", "kind", F.explode("ids").alias("id"))
        .select("session_id", "kind", as_id(F.col("id")).alias("category_id"))
        .where(F.col("category_id").isNotNull())
    )


def touched(actions: DataFrame) -> DataFrame:
    """The distinct categories that were clicked, ordered or paid."""
    return touches(actions).select("category_id").distinct()


def session_category_counts(actions: DataFrame) -> DataFrame:
    """Clicks, orders and pays per session and category.

    Both category reports start here. A session or category with very many actions
    shrinks to one row a pair before anything is joined.
    """
    return (
        touches(actions)
        .groupBy("session_id", "category_id")
        .agg(*[F.count_if(F.col("kind") == k).alias(f"{k}_count") for k in KINDS])
    )


def category_counts(pair_counts: DataFrame, sessions: DataFrame | None = None) -> DataFrame:
    """Clicks, orders and pays per category, of the given sessions or of all."""
    if sessions is not None:
        pair_counts = pair_counts.join(sessions.select("session_id"), "session_id", "left_semi")
    return pair_counts.groupBy("category_id").agg(*[F.sum(f"{k}_count").alias(f"{k}_count") for k in KINDS])


def rank_order() -> list[Column]:
    """Clicks, then orders, then pays, all descending; the id decides a tie."""
    return [*[F.desc(f"{k}_count") for k in KINDS], F.col("category_id")]


def top_categories(counts: DataFrame, n: int = 10) -> DataFrame:
    return top_n(counts, n, rank_order())


def category_session_clicks(pair_counts: DataFrame) -> DataFrame:
    """Clicks per category and session, where there are any.

    The first condition holds for every row. It keeps all three counts alive, so that
    this and the category counts read one and the same shuffle and not two.
    """
    any_touch = F.col("click_count") + F.col("order_count") + F.col("pay_count") > 0
    return pair_counts.where(any_touch & (F.col("click_count") > 0)).select(
        "category_id", "session_id", "click_count"
    )


def top_sessions(
    clicks: DataFrame, top: DataFrame, n: int = 10, sessions: DataFrame | None = None, categories: int = 10
) -> DataFrame:
    """The `n` sessions with the most clicks for each top category.

    `top` holds no more than `categories` rows, so it is broadcast; it goes first
    and leaves little to join or rank.
    """
    clicks = clicks.join(bounded(top.select("category_id"), categories), "category_id")
    if sessions is not None:
        clicks = clicks.join(sessions.select("session_id"), "session_id", "left_semi")
    return top_n(clicks, n, [F.desc("click_count"), F.col("session_id")], keys=["category_id"])


def top_session_actions(actions: DataFrame, ranked: DataFrame, rows: int = 100) -> DataFrame:
    """Actions of the ranked sessions, once each even if a session is in several lists.

    `rows` is the most that `ranked` can hold: sessions per category times categories.
    """
    return actions.join(bounded(ranked.select("session_id"), rows), "session_id", "left_semi")
