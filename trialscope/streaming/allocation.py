"""Daily allocation monitoring of an assignment stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trialscope.operators.reports import allocation_shares


def allocated_days(assignments: DataFrame) -> DataFrame:
    """Users per day, experiment and arm of distinct assignments with a watermark."""
    day = F.window("assignment_timestamp", "1 day")
    return (
        assignments.groupBy(day.alias("w"), "experiment_name", "variant")
        .agg(F.count("user_id").alias("users_assigned"))
        .select(
            F.to_date("w.start").alias("metric_date"),
            "experiment_name",
            "variant",
            "users_assigned",
        )
    )


def open_days(state: DataFrame) -> DataFrame:
    """Days that the state of ``allocated_days`` still holds, as rows of the state store source."""
    key = state.select("key.*", "value.*").toDF("w", "experiment_name", "variant", "users_assigned")
    return key.select(F.to_date("w.start").alias("metric_date"), "experiment_name", "variant", "users_assigned")


def stream_daily_allocation(assignments: DataFrame, delay: str = "1 day") -> DataFrame:
    """Users per day, experiment and arm, emitted when the watermark has passed the day.

    Repeated assignment rows are dropped while the watermark remembers them.
    """
    return allocated_days(
        assignments.where(~F.col("is_holdout"))
        .withColumn("assignment_timestamp", F.col("assignment_timestamp").cast("timestamp"))
        .withWatermark("assignment_timestamp", delay)
        .dropDuplicatesWithinWatermark(["experiment_id"])
    )


def monitored(days: DataFrame, minimum_users: int = 1000, tolerance: float = 0.05) -> DataFrame:
    """Daily and cumulative shares and the warning flag of the closed days.

    Each day is emitted once, so the emitted rows are the table of days; what accumulates is
    computed when it is read.
    """
    so_far = Window.partitionBy("experiment_name", "variant").orderBy("metric_date")
    cumulative = F.sum("users_assigned").over(
        so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return allocation_shares(
        days.withColumn("cumulative_users", cumulative), minimum_users, tolerance
    )
