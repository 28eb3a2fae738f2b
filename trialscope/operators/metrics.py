"""Primary, secondary and guardrail metrics: one row per experiment, arms side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialscope import schemas as S
from trialscope.functions.guards import assert_columns_exist
from trialscope.functions.ratios import ratio_or_zero


def arm_value(column: str, arm: str) -> Column:
    """Aggregate that picks one arm's value of a column; arm labels match in any case."""
    return F.max(F.when(F.lower("variant") == arm, F.col(column)))


def side_by_side(summary: DataFrame, **outputs: str) -> DataFrame:
    """``out='col'`` becomes ``control_out`` and ``variant_out``, one row per experiment."""
    assert_columns_exist(
        summary, ["experiment_name", "variant", *outputs.values()], "side_by_side"
    )
    picks = []
    for out, column in outputs.items():
        picks.append(arm_value(column, S.CONTROL).alias(f"control_{out}"))
        picks.append(arm_value(column, S.VARIANT).alias(f"variant_{out}"))
    return summary.groupBy("experiment_name").agg(*picks)


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0)).alias(name)


def primary_metric(summary: DataFrame) -> DataFrame:
    """Conversion of both arms with absolute and relative lift.

    Relative lift is 0 for a zero control rate.  Experiments that lack an arm are left out; the
    scalar original stops with an error there, which would hide the other experiments.
    """
    arms = side_by_side(summary, users="total_users", conversions="purchasers").where(
        F.col("control_users").isNotNull() & F.col("variant_users").isNotNull()
    )
    rated = arms.select(
        "*",
        ratio_or_zero(F.col("control_conversions"), F.col("control_users")).alias("control_rate"),
        ratio_or_zero(F.col("variant_conversions"), F.col("variant_users")).alias("variant_rate"),
    )
    lift = F.col("variant_rate") - F.col("control_rate")
    return rated.select(
        "*",
        lift.alias("absolute_lift"),
        (ratio_or_zero(lift, F.col("control_rate")) * 100).alias("relative_lift_pct"),
    )


def secondary_metrics(revenue: DataFrame, sessions: DataFrame) -> DataFrame:
    """Revenue per visitor, order value and session length per arm; missing values are 0."""
    money = side_by_side(revenue, rpv="revenue_per_visitor", aov="average_order_value")
    length = side_by_side(sessions, avg_session_seconds="avg_session_duration_seconds")
    return money.join(length, "experiment_name", "full").select(
        "experiment_name",
        _or_zero("control_rpv"),
        _or_zero("variant_rpv"),
        _or_zero("control_aov"),
        _or_zero("variant_aov"),
        _or_zero("control_avg_session_seconds"),
        _or_zero("variant_avg_session_seconds"),
    )


def checkout_abandonment(funnel: DataFrame) -> DataFrame:
    """Share of users who started a checkout and never purchased, per arm."""
    return funnel.select(
        "experiment_name",
        "variant",
        F.when(
            F.col("checkout_users") > 0,
            F.lit(1.0) - ratio_or_zero(F.col("purchase_users"), F.col("checkout_users")),
        ).alias("checkout_abandonment_rate"),
    )


def guardrail_metrics(sessions: DataFrame, funnel: DataFrame) -> DataFrame:
    """Bounce rate and checkout abandonment per arm with their differences."""
    bounce = side_by_side(sessions, bounce_rate="bounce_rate")
    abandoned = side_by_side(
        checkout_abandonment(funnel), checkout_abandonment="checkout_abandonment_rate"
    )
    filled = bounce.join(abandoned, "experiment_name", "full").select(
        "experiment_name",
        _or_zero("control_bounce_rate"),
        _or_zero("variant_bounce_rate"),
        _or_zero("control_checkout_abandonment"),
        _or_zero("variant_checkout_abandonment"),
    )
    return filled.select(
        "*",
        (F.col("variant_bounce_rate") - F.col("control_bounce_rate")).alias("bounce_rate_lift"),
        (
            F.col("variant_checkout_abandonment") - F.col("control_checkout_abandonment")
        ).alias("checkout_abandonment_lift"),
    )


def all_metrics(
    summary: DataFrame, revenue: DataFrame, sessions: DataFrame
) -> DataFrame:
    """The metrics record of every experiment that has both arms."""
    bounce = side_by_side(sessions, bounce_rate="bounce_rate")
    joined = (
        primary_metric(summary)
        .join(secondary_metrics(revenue, sessions), "experiment_name", "left")
        .join(bounce, "experiment_name", "left")
    )
    return joined.select(
        "experiment_name",
        "control_users",
        "variant_users",
        F.col("control_rate").alias("control_conversion_rate"),
        F.col("variant_rate").alias("variant_conversion_rate"),
        "absolute_lift",
        F.col("relative_lift_pct").alias("relative_lift"),
        _or_zero("control_rpv").alias("control_revenue_per_visitor"),
        _or_zero("variant_rpv").alias("variant_revenue_per_visitor"),
        _or_zero("control_aov"),
        _or_zero("variant_aov"),
        _or_zero("control_bounce_rate"),
        _or_zero("variant_bounce_rate"),
    )
