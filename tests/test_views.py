from __future__ import annotations

from decimal import Decimal

import pytest

from tests.tiny import ROWS, assignment, at, one, order, session, tables
from pyspark.sql import functions as F

from trialscope.operators import frames, metrics, reporting, reports, segments, views
from trialscope.sources.tables import Tables


def test_summary_counts_users_once_and_leaves_out_the_holdout(spark):
    summary = views.experiment_summary(tables(spark))
    control = one(summary, experiment_name="A", variant="control")
    assert (control["total_users"], control["purchasers"], control["total_orders"]) == (2, 1, 2)
    assert control["total_revenue"] == Decimal("50.00")
    assert control["conversion_rate"] == 0.5
    assert control["average_order_value"] == 25.0
    assert control["experiment_start"].day == 1 and control["experiment_end"].day == 3
    # A user in two experiments counts in both; a holdout-only experiment does not appear.
    assert one(summary, experiment_name="B", variant="control")["purchasers"] == 1
    assert "only_holdout" not in {r.experiment_name for r in summary.collect()}


def test_repeated_assignment_counts_the_user_once_and_the_revenue_per_row(spark):
    rows = ROWS["experiments"] + [assignment("x9", "A", "control", "u1", 5)]
    control = one(
        views.experiment_summary(tables(spark, experiments=rows)),
        experiment_name="A", variant="control",
    )
    assert (control["total_users"], control["purchasers"]) == (2, 1)
    assert control["total_revenue"] == Decimal("100.00")


def test_no_completed_orders(spark):
    t = tables(spark, orders=[order("o1", "u1", "s1", at(1), "9.00", "pending")])
    control = one(views.experiment_summary(t), experiment_name="A", variant="control")
    assert control["purchasers"] == 0 and control["total_revenue"] == 0
    assert control["average_order_value"] == 0.0
    revenue = one(views.revenue_summary(t), experiment_name="A", variant="control")
    # Only arms with some order appear, without any sale their revenue is unknown.
    assert revenue["gross_revenue"] is None and revenue["revenue_per_visitor"] is None
    assert revenue["average_order_value"] == 0.0 and revenue["refund_rate"] == 0.0
    arms = {(r.experiment_name, r.variant) for r in views.revenue_summary(t).collect()}
    assert arms == {("A", "control"), ("B", "control")}


def test_daily_metrics_are_anchored_on_assignment_days(spark):
    daily = views.daily_metrics_view(tables(spark))
    first = one(daily, experiment_name="A", variant="control", metric_date=at(1).date())
    third = one(daily, experiment_name="A", variant="control", metric_date=at(3).date())
    # The sale of day 2 has no assignment on its day and is not shown.
    assert first["purchasing_users"] == 1 and third["cumulative_purchasers"] == 1
    assert third["cumulative_users"] == 2
    assert third["rolling_7d_conversion_rate"] == 0.5


def test_funnel_flags_need_no_order_of_steps(spark):
    funnel = one(views.funnel_steps_view(tables(spark)), experiment_name="A", variant="variant")
    assert [funnel[c] for c in ("landing_users", "product_users", "cart_users", "checkout_users",
                                "purchase_users")] == [1, 1, 0, 1, 1]
    assert funnel["cart_to_checkout_rate"] == 0.0
    assert funnel["overall_funnel_rate"] == 0.5


def test_session_metrics(spark):
    row = one(views.session_metrics_view(tables(spark)), experiment_name="A", variant="variant")
    assert (row["total_sessions"], row["unique_users"], row["bounced_sessions"]) == (3, 2, 1)
    assert row["avg_session_duration_seconds"] == 4800.0
    assert row["median_session_duration_seconds"] == 3600.0
    assert row["avg_pages_per_session"] == 2.67
    assert row["bounce_rate"] == 0.3333
    assert (row["sessions_per_user"], row["avg_sessions_per_user"]) == (0.667, 1.5)
    assert row["p95_duration_seconds"] == pytest.approx(10080.0)


def test_one_user_with_most_sessions(spark):
    many = [session(f"h{i}", "u2", at(4), at(4, 0, 1 + i % 3)) for i in range(500)]
    row = one(
        views.session_metrics_view(tables(spark, sessions=ROWS["sessions"] + many)),
        experiment_name="A", variant="variant",
    )
    assert (row["total_sessions"], row["unique_users"]) == (503, 2)
    assert row["median_session_duration_seconds"] == 120.0


def test_segments_and_ranks(spark):
    t = tables(spark)
    segment = views.segment_conversion(t)
    assert sum(r.total_users for r in segment.collect()) == 5
    device = one(reports.device_segment(t), experiment_name="A", variant="control",
                 device_type="desktop")
    assert device["conversion_rate"] == 1.0 and device["cr_rank"] == 1
    top = segments.conversion_by_country(segment, top_n=1).collect()
    assert {r.country_name for r in top} == {"Alfa"}


def test_rank_ties_share_a_rank(spark):
    rows = [r.cr_rank for r in reports.channel_segment(tables(spark, orders=[
        order("o1", "u1", "s1", at(1), "9.00", "pending")])).collect()]
    assert set(rows) == {1}


def test_missing_arm(spark):
    t = tables(spark)
    primary = metrics.primary_metric(views.experiment_summary(t)).collect()
    assert [r.experiment_name for r in primary] == ["A"]
    lifts = {(r.experiment_name, r.variant): r.lift_relative
             for r in reports.conversion_metrics(t).collect()}
    assert lifts == {("A", "control"): 0.0, ("A", "variant"): 0.0, ("B", "control"): 0.0}


def test_views_can_be_queried_by_name(spark):
    views.register_views(tables(spark))
    assert spark.sql("SELECT sum(total_users) AS n FROM experiment_summary").first().n == 5


def test_split_filter_and_merge_helpers(spark):
    t = tables(spark)
    control, variant = frames.split_by_variant(t["experiments"])
    assert (control.count(), variant.count()) == (5, 2)
    with pytest.raises(ValueError, match="found"):
        frames.split_by_variant(control)
    days = frames.filter_date_range(t["orders"], "order_timestamp", "2024-01-02")
    assert {r.order_id for r in days.collect()} == {"o2", "o4", "o5"}
    assert frames.filter_date_range(t["orders"], "order_timestamp").count() == 6
    with pytest.raises(ValueError, match="missing columns"):
        frames.filter_date_range(t["orders"], "absent")
    for how in ("inner", "left", "right", "outer"):
        counted = frames.merge_counts(t["users"], t["orders"], "user_id", how).first()
        joined = frames.safe_merge(t["users"], t["orders"], "user_id", how)
        assert counted.result_rows == joined.count()


def test_sampling(spark):
    t = tables(spark)
    assert reporting.user_level_data(t).count() == 5
    half = [r.user_id for r in reporting.user_level_data(t, 0.5, seed=1).collect()]
    assert sorted(half) == sorted(r.user_id for r in reporting.user_level_data(t, 0.5, seed=1).collect())
    assert len(half) <= 5
    for bad in (0, 1.5, -1):
        with pytest.raises(ValueError):
            reporting.user_level_data(t, bad)


def test_typed_read_leaves_unreadable_columns_as_they_are(spark):
    df = spark.createDataFrame([("1", "2", 3), ("x", "4", 5)], "total_users string, n string, k int")
    read = reporting.typed_read(df, {"total_users": "bigint", "n": "bigint", "k": "double"})
    assert [tuple(r) for r in read.collect()] == [("1", 2, 3.0), ("x", 4, 5.0)]


def test_an_arm_without_known_durations_keeps_its_sessions(spark):
    t = tables(spark)
    unknown = t.replacing(sessions=t["sessions"].withColumn("duration_seconds", F.lit(None).cast("int")))
    found = views.session_metrics_view(unknown).collect()
    assert len(found) == views.session_averages(unknown).count() > 0
    assert all(r.total_sessions > 0 and r.p95_duration_seconds is None for r in found)


def test_tables_are_built_once():
    built = []
    t = Tables({"a": lambda t: built.append(1) or "frame"})
    assert (t["a"], t["a"], len(t), list(t)) == ("frame", "frame", 1, ["a"])
    assert built == [1]
