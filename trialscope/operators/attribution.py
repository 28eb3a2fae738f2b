"""Purchases attributed to an arm only from a user's assignment on.

A purchase counts for an arm if it was made at or after the user's first assignment to it.  Orders are
folded to users and days first.  Whole days after the day of assignment are taken from the fold, so a
user with very many orders meets its assignments as at most one row per day; single orders are looked
at only for the day of assignment, in an equi-join on (user, day).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialscope.operators.arms import ARM, TableMap, arm_users, is_sale, money

#: What orders are folded to; all of it is additive.
SUMS = ("gross", "refunded", "sales", "refunds", "failures", "any_orders")


def _sums() -> list[Column]:
    sale, refund = is_sale(), F.col("is_refund")
    return [
        money(F.sum(F.when(sale, F.col("order_value")))).alias("gross"),
        money(F.sum(F.when(refund, F.col("order_value")))).alias("refunded"),
        F.count_if(sale).alias("sales"),
        F.count_if(refund).alias("refunds"),
        F.count_if(F.col("payment_status") == "failed").alias("failures"),
        F.count(F.lit(1)).alias("any_orders"),
    ]


def orders_after_assignment(t: TableMap) -> DataFrame:
    """(experiment_name, variant, user_id, n_rows, metric_date, sums): one row per day with such orders."""
    arms = arm_users(t).select(
        *ARM, "user_id", "n_rows", "first_assigned", F.to_date("first_assigned").alias("first_day")
    )
    orders = t["orders"].withColumn("metric_date", F.to_date("order_timestamp"))
    days = orders.groupBy("user_id", "metric_date").agg(*_sums())
    key = [*ARM, "user_id", "n_rows", "metric_date"]
    later = days.join(arms, "user_id").where(F.col("metric_date") > F.col("first_day")).select(*key, *SUMS)
    first_days = arms.withColumnRenamed("first_day", "metric_date")
    same = (
        orders.join(first_days, ["user_id", "metric_date"])
        .where(F.col("order_timestamp") >= F.col("first_assigned"))
        .groupBy(*key)
        .agg(*_sums())
    )
    return later.unionByName(same)


def orders_of_arm_users(t: TableMap) -> DataFrame:
    """``orders_after_assignment`` per user of an arm."""
    kinds = {c: F.sum(c) for c in SUMS}
    kinds |= {c: money(kinds[c]) for c in ("gross", "refunded")}
    return (
        orders_after_assignment(t)
        .groupBy(*ARM, "user_id")
        .agg(*[total.alias(c) for c, total in kinds.items()])
    )
