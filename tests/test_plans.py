"""Physical plans of the named queries: no join without keys, no Python, no single-task window."""

from __future__ import annotations

import re

import pytest

from trialscope.plans.registry import QUERIES

PATH = "/root/testdata/sf0.001"
# These run jobs of their own while they are built.
EAGER = {
    "scan_tables", "sink_raw", "bulk_load", "row_count_reconcile", "refresh_materialized",
    "export_datasets", "assert_guards", "refresh_users_from_changes", "refresh_daily_from_changes",
    "distinct_users_sketch",
}
LAZY = sorted(name for name in set(QUERIES) - EAGER if not name.startswith("stream_"))


def physical(spark, name: str) -> str:
    return QUERIES[name](spark, PATH)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_plan(spark, name):
    plan = physical(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython"):
        assert operator not in plan
    lines = [re.sub(r"^[\s:|+\-*()\d]*", "", line) for line in plan.splitlines()]
    for upper, middle, lower in zip(lines, lines[1:], lines[2:]):
        if upper.startswith("Window") and middle.startswith("Sort"):
            assert not lower.startswith("Exchange SinglePartition"), plan


def test_scans_read_only_the_needed_columns(spark):
    plan = physical(spark, "experiment_summary")
    reads = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert sorted(sorted(c.split(":")[0] for c in read.split(",")) for read in reads) == [
        ["c_custkey"],
        ["o_custkey", "o_orderkey", "o_totalprice"],
    ]


@pytest.mark.parametrize("name", ["iqr_outliers", "outlier_impact", "winsorized_mean"])
def test_rows_are_not_dealt_by_arm_alone_when_nothing_is_broadcast(spark, name):
    from trialscope.streaming.replay import settings

    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    with settings(spark, off):
        plan = physical(spark, name)
    lines = [re.sub(r"^[\s:|+\-*()\d]*", "", line) for line in plan.splitlines()]
    for i, line in enumerate(lines):
        if re.match(r"Exchange hashpartitioning\(experiment_name#\d+, variant#\d+, \d+\)", line):
            # Only partial sums per arm may meet there.
            assert re.match(r"(Hash|ObjectHash|Sort)Aggregate.*partial_|.*Aggregate\(keys=", lines[i + 1]), plan


def test_unused_session_lookup_disappears(spark):
    from trialscope.sources import warehouse

    orders = warehouse.load(spark, PATH)["orders"].select("user_id", "order_value")
    assert "events.parquet" not in orders._jdf.queryExecution().executedPlan().toString()


def test_orders_are_folded_before_they_move(spark):
    plan = physical(spark, "revenue_summary")
    # The only exchange of orders carries partial sums per user.
    scan = plan.index("orders.parquet")
    moved = plan.rindex("Exchange hashpartitioning(user_id", 0, scan)
    assert "partial_sum" in plan[moved:scan] and plan[moved:scan].count("Exchange") == 1


def test_histogram_branches_share_their_exchanges(spark):
    df = QUERIES["winsorized_mean"](spark, PATH)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") == 2
    assert plan.count("orders.parquet") == plan.count("customer.parquet") == 1


def test_a_hot_session_is_split_over_tasks(spark):
    from pyspark.sql import functions as F

    from trialscope.operators import quality
    from trialscope.streaming.replay import settings

    start = F.lit("2024-01-01").cast("timestamp")
    events = spark.range(0, 200_000, 1, 16).select(
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 1000).alias("session_id"),
        F.lit(1).alias("user_id"),
        F.lit(1).alias("event_type_id"),
        F.timestamp_seconds(F.unix_timestamp(start) + F.col("id") % 3600).alias("event_timestamp"),
    )
    sessions = spark.range(0, 999).select(
        F.col("id").alias("session_id"),
        start.alias("session_start"),
        F.timestamp_seconds(F.unix_timestamp(start) + 3000).alias("session_end"),
    )
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    with settings(spark, small):
        checks = quality.dq_events(events, sessions)
        found = {r.check_name: r.violations for r in checks.collect()}
        plan = checks._jdf.queryExecution().executedPlan().toString()
    orphans = sum(1 for i in range(200_000) if i % 3 and i % 1000 == 999)
    outside = sum(1 for i in range(200_000) if i % 3600 > 3000 and not (i % 3 and i % 1000 == 999))
    assert (found["no_orphan_events"], found["event_within_session_window"]) == (orphans, outside)
    assert "skew=true" in plan.split("== Initial Plan ==")[0]
