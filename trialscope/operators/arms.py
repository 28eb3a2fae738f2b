"""Experiment arms and their users: what views, reports and attributions start from."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialscope.functions.ratios import MONEY

ARM = ("experiment_name", "variant")

TableMap = Mapping[str, DataFrame]


def is_sale() -> Column:
    return (F.col("payment_status") == "completed") & ~F.col("is_refund")


def active(t: TableMap) -> DataFrame:
    """Assignments outside the holdout."""
    return t["experiments"].where(~F.col("is_holdout"))


def arm_users(t: TableMap) -> DataFrame:
    """One row per (experiment, arm, user)."""
    return (
        active(t)
        .groupBy(*ARM, "user_id")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min("assignment_timestamp").alias("first_assigned"),
            F.max("assignment_timestamp").alias("last_assigned"),
        )
    )


def money(c: Column) -> Column:
    return c.cast(MONEY)


def sales_by_user(t: TableMap) -> DataFrame:
    return (
        t["orders"]
        .where(is_sale())
        .groupBy("user_id")
        .agg(
            F.count("order_id").alias("user_orders"),
            money(F.sum("order_value")).alias("user_revenue"),
        )
    )
