"""What the plans look like: pushed filters, early cuts, shared shuffles, no Python, split skew."""

import re

import pytest
from pyspark.sql import functions as F

from clickloom.operators import patterns, sessions
from clickloom.operators.ranking import bounded
from clickloom.plans import catalog
from clickloom.sources import retail

QUERIES = catalog.queries()


def planned(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    df.collect()
    return planned(df).split("== Initial Plan")[0]


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.endswith("_stream")])
def test_jvm_only_and_no_cross_join(spark, sf_dir, name):
    plan = planned(QUERIES[name](spark, sf_dir))
    assert not re.search("Python|Pandas|CartesianProduct|BroadcastNestedLoop", plan)


def test_dates_reach_the_scan(spark, sf_dir):
    plan = planned(catalog.session_filter(spark, sf_dir))
    assert "GreaterThanOrEqual(ts,2024-01-03" in plan
    assert "LessThan(ts,2024-01-28" in plan


def test_only_needed_columns_are_read(spark, sf_dir):
    plan = planned(catalog.session_aggr_stat(spark, sf_dir))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan


@pytest.mark.parametrize("name", ["hot_items_top3", "url_traffic_top5", "top10_session"])
def test_ranks_are_cut_before_the_shuffle(spark, sf_dir, name):
    plan = planned(QUERIES[name](spark, sf_dir))
    assert re.search(r"WindowGroupLimit .*Partial", plan)


def test_top_categories_never_sort_everything(spark, sf_dir):
    assert "TakeOrderedAndProject(limit=10" in planned(catalog.top10_category(spark, sf_dir))


def test_top_sessions_share_the_pair_counts(spark, sf_dir):
    assert re.search(r"ReusedExchange \[session_id#\d+, category_id", executed(catalog.top10_session(spark, sf_dir)))


def test_patterns_cut_keys_by_broadcast(spark, sf_dir):
    """Borders and the ends of pieces are small: rows are shuffled once, by key and piece."""
    orders = retail.orders(catalog._events(spark, sf_dir)).withColumn("us", F.unix_micros("ts"))
    plan = planned(patterns.order_outcomes(orders, piece_rows=100))
    assert plan.count("BroadcastHashJoin") >= 2
    assert re.search(r"Exchange hashpartitioning\(order_id#\d+L, piece#\d+", plan)
    assert "SortMergeJoin" not in plan


def test_broadcast_only_below_the_bound(spark, with_conf):
    with_conf(spark__sql__autoBroadcastJoinThreshold="-1")
    big = spark.range(1000)
    assert "BroadcastHashJoin" in planned(big.join(bounded(spark.range(5), 100), "id"))
    assert "BroadcastHashJoin" not in planned(big.join(bounded(spark.range(5), 10_000_000), "id"))


def test_a_hot_user_is_split_in_the_join(spark, with_conf):
    """A third of all sessions belongs to one user: the join splits that partition."""
    with_conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__shuffle__partitions="16",
    )
    rolled = spark.range(0, 200_000, 1, 16).select(
        F.concat(F.lit("s"), F.col("id")).alias("session_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("user_id"),
    )
    users = spark.range(500).select(
        F.col("id").alias("user_id"), F.lit(1).alias("age"), F.lit("p").alias("professional"),
        F.lit("c").alias("city"), F.lit("x").alias("sex"),
    )
    joined = sessions.with_users(rolled, users)
    joined.write.format("noop").mode("overwrite").save()
    plan = executed(joined)
    assert "skew=true" in plan
    assert joined.count() == 200_000
