"""Funnel analysis over long funnel rows (one row per arm and step).

Input columns: experiment_name, variant, step_name, step_order, users_reached,
step_conversion_rate, cumulative_conversion_rate, as produced by ``reports.funnel_steps``.
Windows are partitioned by arm and hold one row per funnel step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialscope import schemas as S
from trialscope.functions.guards import assert_columns_exist
from trialscope.functions.ratios import ratio

REQUIRED = (
    "experiment_name",
    "variant",
    "step_name",
    "step_order",
    "users_reached",
    "step_conversion_rate",
    "cumulative_conversion_rate",
)


def analyzer_steps(funnel: DataFrame) -> DataFrame:
    """Steps with the users lost on the way to the next one; 0 for the last step."""
    assert_columns_exist(funnel, REQUIRED, "analyzer_steps")
    following = F.lead("users_reached").over(
        Window.partitionBy("experiment_name", "variant").orderBy("step_order")
    )
    lost = F.col("users_reached") - F.coalesce(following, F.col("users_reached"))
    return funnel.select(
        "experiment_name",
        "variant",
        "step_name",
        "step_order",
        "users_reached",
        F.col("step_conversion_rate").alias("step_rate"),
        F.col("cumulative_conversion_rate").alias("cumulative_rate"),
        F.greatest(lost, F.lit(0)).alias("drop_off_count"),
    )


def funnel_lift(funnel: DataFrame) -> DataFrame:
    """Step and cumulative rates of both arms with lifts; steps of either arm are kept."""
    assert_columns_exist(funnel, REQUIRED, "funnel_lift")
    keys = ["experiment_name", "step_name", "step_order"]

    def arm(label: str) -> DataFrame:
        return funnel.where(F.lower("variant") == label).select(
            *keys,
            F.col("step_conversion_rate").alias(f"{label}_step_rate"),
            F.col("cumulative_conversion_rate").alias(f"{label}_cumulative_rate"),
        )

    both = arm(S.CONTROL).join(arm(S.VARIANT), keys, "full")
    cumulative = F.col("variant_cumulative_rate") - F.col("control_cumulative_rate")
    return both.select(
        *keys,
        "control_step_rate",
        "control_cumulative_rate",
        "variant_step_rate",
        "variant_cumulative_rate",
        (F.col("variant_step_rate") - F.col("control_step_rate")).alias("step_rate_lift"),
        cumulative.alias("cumulative_rate_lift"),
        (ratio(cumulative, F.col("control_cumulative_rate")) * 100).alias(
            "cumulative_rate_relative_lift_pct"
        ),
    )


def biggest_drop_off(funnel: DataFrame) -> DataFrame:
    """The step that loses most users per arm, the last step excluded, first one on ties.

    An arm with a single step has no candidate and no row.
    """
    steps = analyzer_steps(funnel)
    last = F.max("step_order").over(Window.partitionBy("experiment_name", "variant"))
    worst = F.max_by(
        F.struct(
            "step_name", "step_order", "users_reached", "step_rate", "cumulative_rate",
            "drop_off_count",
        ),
        F.struct("drop_off_count", -F.col("step_order")),
    )
    return (
        steps.withColumn("_last", last)
        .where(F.col("step_order") < F.col("_last"))
        .groupBy("experiment_name", "variant")
        .agg(worst.alias("worst"))
        .select("experiment_name", "variant", "worst.*")
    )


def funnel_report(funnel: DataFrame) -> DataFrame:
    """One record per experiment: steps of both arms, lift rows and the worst steps."""

    def collected(df: DataFrame, name: str, when: Column | None = None) -> Column:
        columns = [c for c in df.columns if c not in ("experiment_name", "variant")]
        record = F.struct("step_order", *[c for c in columns if c != "step_order"])
        kept = record if when is None else F.when(when, record)
        return F.array_sort(F.collect_list(kept)).alias(name)

    steps = analyzer_steps(funnel)
    control = F.lower("variant") == S.CONTROL
    variant = F.lower("variant") == S.VARIANT
    lists = steps.groupBy("experiment_name").agg(
        collected(steps, "control_steps", control),
        collected(steps, "variant_steps", variant),
    )
    lift = funnel_lift(funnel)
    lifts = lift.groupBy("experiment_name").agg(collected(lift, "funnel_lift"))
    worst = biggest_drop_off(funnel)
    record = F.struct(*[c for c in worst.columns if c not in ("experiment_name", "variant")])
    worsts = worst.groupBy("experiment_name").agg(
        F.max(F.when(control, record)).alias("biggest_drop_off_control"),
        F.max(F.when(variant, record)).alias("biggest_drop_off_variant"),
    )
    return lists.join(lifts, "experiment_name", "left").join(worsts, "experiment_name", "left")
