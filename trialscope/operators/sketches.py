"""Distinct users and percentiles from states that can be stored and united.

States are kept per day, arm and segment; any period, and any coarser grouping, is the union of the
states of its days and groups, without another look at sessions or orders.  A state has a bounded size
whatever the number of rows behind it.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialscope.operators.arms import ARM, TableMap, arm_users, sales_by_user

#: Size of distinct-count states: two to this power of registers.
REGISTERS = 12
#: Size of percentile states; their normalized rank error is about 1.7 / k ** 0.9 (under 0.7 % for 400).
K = 400


# --- distinct users -------------------------------------------------------------------------------


def relative_error(registers: int = REGISTERS, deviations: float = 3.0) -> float:
    """Bound of the relative error of an estimate, at some number of standard deviations."""
    return deviations * 1.04 / math.sqrt(2**registers)


def active_users(t: TableMap, segment: str = "device_id") -> DataFrame:
    """(metric_date, experiment_name, variant, segment, user_id): users with a session that day, once."""
    user_days = t["sessions"].select("user_id", F.to_date("session_start").alias("metric_date")).distinct()
    arms = arm_users(t).select(*ARM, "user_id")
    users = t["users"].select("user_id", F.col(segment).cast("string").alias("segment"))
    return user_days.join(arms, "user_id").join(users, "user_id")


def distinct_states(rows: DataFrame, by: Sequence[str], what: str = "user_id", registers: int = REGISTERS) -> DataFrame:
    """One state per group: what stands for the set of its values."""
    return rows.groupBy(*by).agg(F.hll_sketch_agg(what, registers).alias("state"))


def united_distinct(states: DataFrame, by: Sequence[str]) -> DataFrame:
    """Estimated number of distinct values in the union of the states of each group."""
    return states.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("state")).alias("estimated"))


def compared(exact: DataFrame, estimates: DataFrame, by: Sequence[str], bound: float) -> DataFrame:
    """Exact counts (column ``exact``) beside estimates, and whether these are within the bound."""
    error = F.abs(F.col("estimated") - F.col("exact")) / F.greatest(F.col("exact"), F.lit(1))
    return exact.join(estimates, list(by), "left").withColumn(
        "within_bound", F.coalesce(error <= F.lit(bound), F.lit(False))
    )


# --- percentiles ----------------------------------------------------------------------------------


def session_states(t: TableMap, k: int = K) -> DataFrame:
    """Per day and arm: a percentile state of session durations, and additive session counts.

    Sessions of users with repeated assignment rows weigh as often, as in ``session_metrics_view``.
    """
    arms = arm_users(t).select(*ARM, "user_id", F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))))
    return (
        t["sessions"]
        .select("user_id", "duration_seconds", F.to_date("session_start").alias("metric_date"))
        .join(arms, "user_id")
        .groupBy("metric_date", *ARM)
        .agg(F.kll_sketch_agg_bigint(F.col("duration_seconds").cast("bigint"), F.lit(k)).alias("state"))
    )


def revenue_states(t: TableMap, k: int = K) -> DataFrame:
    """Per day of first assignment and arm: a percentile state of the revenue of purchasing users."""
    users = arm_users(t).join(sales_by_user(t), "user_id")
    return (
        users.withColumn("revenue", (F.col("user_revenue") * F.col("n_rows")).cast("double"))
        .groupBy(F.to_date("first_assigned").alias("metric_date"), *ARM)
        .agg(F.kll_sketch_agg_double("revenue", F.lit(k)).alias("state"))
    )


def _quantile(kind: str, state: Column, p: float) -> Column:
    get = {"bigint": F.kll_sketch_get_quantile_bigint, "double": F.kll_sketch_get_quantile_double}[kind]
    return get(state, F.lit(p)).cast("double")


def united_percentiles(
    states: DataFrame, by: Sequence[str], marks: Mapping[str, float], kind: str = "bigint"
) -> DataFrame:
    """Approximate percentiles of the union of the states of each group; kind: bigint or double."""
    merge = {"bigint": F.kll_merge_agg_bigint, "double": F.kll_merge_agg_double}[kind]
    merged = states.groupBy(*by).agg(merge("state").alias("state"))
    return merged.select(*by, *[_quantile(kind, F.col("state"), p).alias(name) for name, p in marks.items()])
