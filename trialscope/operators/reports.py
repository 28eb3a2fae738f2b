"""The fourteen stand-alone reports, as functions over the canonical tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialscope import schemas as S
from trialscope.functions.quantiles import percentiles
from trialscope.functions.ratios import MONEY, ratio, ratio_or_zero
from trialscope.operators import sketches
from trialscope.operators.views import (
    ARM,
    TableMap,
    active,
    arm_users,
    experiment_summary,
    funnel_steps_view,
    is_sale,
    money,
    mv_daily_conversion,
    revenue_summary,
    sales_by_user,
    segment_conversion,
    session_metrics_view,
    user_profiles,
)


def _control_value(column: str, *keys: str) -> Column:
    """The control arm's value of a column, seen from every row with the same keys.

    A window over summary rows replaces a self-join of the summary.
    """
    in_control = F.when(F.col("variant") == S.CONTROL, F.col(column))
    return F.max(in_control).over(Window.partitionBy(*keys))


def _relative_to_control(rate: str, control: Column) -> Column:
    """0 for the control arm, NULL where its rate is 0 or absent."""
    return F.when(F.col("variant") == S.CONTROL, F.lit(0.0)).otherwise(
        ratio(F.col(rate) - control, control)
    )


def conversion_metrics(t: TableMap) -> DataFrame:
    """Arm conversion with absolute and relative lift over control."""
    summary = experiment_summary(t).withColumn(
        "_control", _control_value("conversion_rate", "experiment_name")
    )
    control = F.col("_control")
    return summary.select(
        *ARM,
        "total_users",
        "purchasers",
        "conversion_rate",
        "total_revenue",
        "total_orders",
        F.when(F.col("variant") == S.CONTROL, F.lit(0.0))
        .otherwise(F.col("conversion_rate") - control)
        .alias("lift_absolute"),
        _relative_to_control("conversion_rate", control).alias("lift_relative"),
    )


def daily_metrics(t: TableMap) -> DataFrame:
    """Daily series with running revenue and the day-over-day change in conversion."""
    by_day = Window.partitionBy(*ARM).orderBy("metric_date")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return mv_daily_conversion(t).select(
        "metric_date",
        *ARM,
        F.col("users_assigned").alias("daily_users"),
        F.col("purchasing_users").alias("daily_conversions"),
        "daily_conversion_rate",
        "cumulative_users",
        F.col("cumulative_purchasers").alias("cumulative_conversions"),
        "cumulative_conversion_rate",
        "rolling_7d_conversion_rate",
        "daily_revenue",
        F.sum("daily_revenue").over(so_far).cast(MONEY).alias("cumulative_revenue"),
        (
            F.col("daily_conversion_rate") - F.lag("daily_conversion_rate").over(by_day)
        ).alias("dod_conversion_change"),
    )


def session_metrics(t: TableMap) -> DataFrame:
    return session_metrics_view(t).select(
        *ARM,
        "total_sessions",
        "unique_users",
        F.col("avg_session_duration_seconds").alias("avg_session_duration"),
        F.col("median_session_duration_seconds").alias("median_session_duration"),
        F.col("p75_duration_seconds").alias("p75_session_duration"),
        "avg_pages_per_session",
        "bounce_rate",
        "bounced_sessions",
        "sessions_per_user",
    )


def funnel_long(t: TableMap) -> DataFrame:
    """One row per arm and funnel step; a single pass over the wide funnel."""
    steps = F.array(
        *[
            F.struct(
                F.lit(order).alias("step_order"),
                F.lit(label).alias("step_name"),
                F.col(column).alias("users_reached"),
            )
            for order, label, column, _ in S.FUNNEL_STEPS
        ]
    )
    return funnel_steps_view(t).select(*ARM, "total_users", F.inline(steps))


def funnel_steps(t: TableMap) -> DataFrame:
    """Conversion and drop-off of every step against the step before it."""
    before = F.lag("users_reached").over(Window.partitionBy(*ARM).orderBy("step_order"))
    rows = funnel_long(t).withColumn(
        "users_at_step", F.coalesce(before, F.col("total_users"))
    )
    reached, entering = F.col("users_reached"), F.col("users_at_step")
    return rows.select(
        *ARM,
        "step_name",
        "step_order",
        "users_reached",
        "users_at_step",
        ratio_or_zero(reached, entering).alias("step_conversion_rate"),
        ratio_or_zero(reached, F.col("total_users")).alias("cumulative_conversion_rate"),
        (entering - reached).alias("drop_off_count"),
        ratio_or_zero(entering - reached, entering).alias("drop_off_rate"),
    )


def funnel_completion(t: TableMap) -> DataFrame:
    """Cumulative step rate of the variant next to control, with lifts."""
    rows = (
        funnel_long(t)
        .withColumn("rate", ratio_or_zero(F.col("users_reached"), F.col("total_users")))
        .withColumn("control_rate", _control_value("rate", "experiment_name", "step_order"))
        .where((F.col("variant") == S.VARIANT) & F.col("control_rate").isNotNull())
    )
    difference = F.col("rate") - F.col("control_rate")
    return rows.select(
        "experiment_name",
        "step_order",
        "step_name",
        F.col("users_reached").alias("variant_users_reached"),
        F.col("total_users").alias("variant_total_users"),
        "control_rate",
        F.col("rate").alias("variant_rate"),
        difference.alias("absolute_lift"),
        ratio(difference, F.col("control_rate")).alias("relative_lift"),
    )


def user_revenue(t: TableMap) -> DataFrame:
    """Revenue per purchasing user and arm."""
    return (
        arm_users(t)
        .select(*ARM, "user_id", "n_rows")
        .join(sales_by_user(t), "user_id")
        .select(*ARM, "user_id", money(F.col("user_revenue") * F.col("n_rows")).alias("revenue"))
    )


def revenue_histogram(t: TableMap) -> DataFrame:
    """How many users of an arm have each revenue; the input of exact order statistics."""
    return user_revenue(t).groupBy(*ARM, "revenue").agg(F.count(F.lit(1)).alias("w"))


def revenue_per_visitor(t: TableMap, approx: bool = False) -> DataFrame:
    """Arm revenue with the percentiles of revenue over purchasing users, exact unless ``approx``.

    Approximate ones come from mergeable states (see ``operators.sketches``).
    """
    wanted = {
        "p25_order_value": 0.25,
        "median_order_value": 0.50,
        "p75_order_value": 0.75,
        "p95_order_value": 0.95,
    }
    if approx:
        marks = sketches.united_percentiles(sketches.revenue_states(t), ARM, wanted, "double")
    else:
        marks = percentiles(revenue_histogram(t), ARM, "revenue", "w", wanted, resolution=0.01).drop("n")
    return (
        revenue_summary(t)
        .join(marks, list(ARM), "left")
        .select(
            *ARM,
            "total_users",
            F.col("gross_revenue").alias("total_revenue"),
            "revenue_per_visitor",
            F.col("average_order_value").alias("avg_order_value"),
            "median_order_value",
            "p25_order_value",
            "p75_order_value",
            "p95_order_value",
            "refund_rate",
        )
    )


def order_analysis(t: TableMap) -> DataFrame:
    """Completed orders by arm, day, payment method and value bucket.

    Orders are folded per user before the join; refunds carry their own status in clean data,
    so the refund columns stay 0 unless a completed order is flagged as refunded.
    """
    value = F.col("order_value")
    *bounded, (_, rest) = S.VALUE_BUCKETS
    bucket = F.lit(rest)
    for upper, label in reversed(bounded):
        bucket = F.when(value < upper, label).otherwise(bucket)
    per_user = (
        t["orders"]
        .where(F.col("payment_status") == "completed")
        .groupBy(
            "user_id",
            F.to_date("order_timestamp").alias("order_date"),
            "payment_method",
            bucket.alias("order_value_bucket"),
        )
        .agg(
            F.count("order_id").alias("n"),
            money(F.sum("order_value")).alias("value"),
            F.count_if("is_refund").alias("refunds"),
            money(F.sum(F.when(F.col("is_refund"), value).otherwise(0))).alias("refund_value"),
        )
    )
    weight = F.col("n_rows")
    return (
        per_user.join(arm_users(t).select(*ARM, "user_id", "n_rows"), "user_id")
        .groupBy(*ARM, "order_date", "payment_method", "order_value_bucket")
        .agg(
            F.sum(F.col("n") * weight).alias("total_orders"),
            money(F.sum(F.col("value") * weight)).alias("total_revenue"),
            F.sum(F.col("refunds") * weight).alias("refunded_orders"),
            money(F.sum(F.col("refund_value") * weight)).alias("refunded_revenue"),
        )
    )


def _by_dimension(t: TableMap, *dimensions: str) -> DataFrame:
    return (
        segment_conversion(t)
        .groupBy("experiment_name", *dimensions, "variant")
        .agg(
            F.sum("total_users").alias("total_users"),
            F.sum("purchasers").alias("purchasers"),
        )
        .withColumn(
            "conversion_rate", ratio_or_zero(F.col("purchasers"), F.col("total_users"))
        )
    )


def _rate_rank() -> Column:
    return F.rank().over(
        Window.partitionBy(*ARM).orderBy(F.col("conversion_rate").desc_nulls_first())
    )


def device_segment(t: TableMap) -> DataFrame:
    return _by_dimension(t, "device_type").select(
        "experiment_name",
        "device_type",
        "variant",
        "total_users",
        "purchasers",
        "conversion_rate",
        _rate_rank().alias("cr_rank"),
    )


def country_segment(t: TableMap) -> DataFrame:
    rows = _by_dimension(t, "country_name", "country_code", "region_name").withColumn(
        "_control", _control_value("conversion_rate", "experiment_name", "country_name")
    )
    return rows.select(
        "experiment_name",
        "country_name",
        "country_code",
        "region_name",
        "variant",
        "total_users",
        "purchasers",
        "conversion_rate",
        _relative_to_control("conversion_rate", F.col("_control")).alias("lift_vs_control"),
    )


def channel_segment(t: TableMap) -> DataFrame:
    """Conversion and revenue by channel, from one pass over the assignments.

    Users and revenue use the same join to the user dimensions; they cover the same users as
    long as the foreign keys of ``users`` hold (``constraints.fk_check``).
    """
    rows = (
        arm_users(t)
        .select(*ARM, "user_id", "n_rows")
        .join(user_profiles(t).select("user_id", "channel_name"), "user_id")
        .join(sales_by_user(t), "user_id", "left")
        .groupBy("experiment_name", "channel_name", "variant")
        .agg(
            F.count("user_id").alias("total_users"),
            F.count("user_orders").alias("purchasers"),
            money(
                F.coalesce(F.sum(F.col("user_revenue") * F.col("n_rows")), F.lit(0))
            ).alias("total_revenue"),
        )
        .withColumn(
            "conversion_rate", ratio_or_zero(F.col("purchasers"), F.col("total_users"))
        )
    )
    return rows.select(
        "experiment_name",
        "channel_name",
        "variant",
        "total_users",
        "purchasers",
        "conversion_rate",
        "total_revenue",
        ratio_or_zero(F.col("total_revenue"), F.col("total_users")).alias("revenue_per_visitor"),
        _rate_rank().alias("cr_rank"),
    )


def daily_srm_check(
    t: TableMap, minimum_users: int = 1000, tolerance: float = 0.05
) -> DataFrame:
    """Daily and cumulative variant share per experiment, with a threshold warning.

    The cumulative share of a day sums only the arms that have a row on that day.
    """
    return allocation_shares(mv_daily_conversion(t), minimum_users, tolerance)


def dense_daily_srm(
    t: TableMap, by: Sequence[str] = (), minimum_users: int = 1000, tolerance: float = 0.05
) -> DataFrame:
    """``daily_srm_check`` over all days from an experiment's first assignment to its last.

    Every arm that the group has at any time has a row on each day, with its count so far, so a day on which
    an arm gets nobody does not distort the cumulative share.  ``by`` names attributes of users
    (as in ``user_profiles``) to watch each of their values on its own.
    """
    group = ["experiment_name", *by]
    assigned = active(t)
    if by:
        assigned = assigned.join(user_profiles(t).select("user_id", *by), "user_id")
    counts = assigned.groupBy(*group, "variant", F.to_date("assignment_timestamp").alias("metric_date")).agg(
        F.count_distinct("user_id").alias("users")
    )
    span = counts.groupBy("experiment_name").agg(
        F.min("metric_date").alias("first"), F.max("metric_date").alias("last")
    )
    spine = (
        counts.select(*group, "variant")
        .distinct()
        .join(span, "experiment_name")
        .select(*group, "variant", F.explode(F.sequence("first", "last")).alias("metric_date"))
    )
    so_far = Window.partitionBy(*group, "variant").orderBy("metric_date")
    so_far = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    daily = spine.join(counts, [*group, "variant", "metric_date"], "left").select(
        "metric_date",
        *group,
        "variant",
        F.coalesce("users", F.lit(0)).alias("users_assigned"),
        F.coalesce(F.sum("users").over(so_far), F.lit(0)).alias("cumulative_users"),
    )
    return allocation_shares(daily, minimum_users, tolerance, by)


def allocation_shares(
    daily: DataFrame, minimum_users: int = 1000, tolerance: float = 0.05, by: Sequence[str] = ()
) -> DataFrame:
    """``daily_srm_check`` over rows of (metric_date, experiment_name, variant, users_assigned,
    cumulative_users)."""

    def of(arm: str, column: str, name: str) -> Column:
        return F.sum(F.when(F.col("variant") == arm, F.col(column)).otherwise(0)).alias(name)

    days = (
        daily.groupBy("metric_date", "experiment_name", *by)
        .agg(
            of(S.CONTROL, "users_assigned", "daily_users_control"),
            of(S.VARIANT, "users_assigned", "daily_users_variant"),
            F.sum("users_assigned").alias("daily_total"),
            of(S.CONTROL, "cumulative_users", "cumulative_control"),
            of(S.VARIANT, "cumulative_users", "cumulative_variant"),
            F.sum("cumulative_users").alias("cumulative_total"),
        )
    )
    share = ratio_or_zero(F.col("cumulative_variant"), F.col("cumulative_total"))
    off_balance = (F.col("cumulative_total") > minimum_users) & (
        F.abs(share - 0.5) > tolerance
    )
    return days.select(
        "metric_date",
        "experiment_name",
        *by,
        F.lit(0.5).alias("expected_variant_fraction"),
        ratio_or_zero(F.col("daily_users_variant"), F.col("daily_total")).alias(
            "actual_daily_variant_fraction"
        ),
        share.alias("actual_cumulative_variant_fraction"),
        "daily_users_control",
        "daily_users_variant",
        "cumulative_control",
        "cumulative_variant",
        F.coalesce(off_balance, F.lit(False)).alias("srm_warning_flag"),
    )


def data_quality_monitor(t: TableMap, extreme_value: int = 1000) -> DataFrame:
    """One row of health counters over events, sessions, assignments and sales.

    Every counter is computed as its own one-row aggregate with NULLs for the others; the rows
    are united and folded, so no join without a key is needed.
    """
    counters = {
        "events_without_experiment": "bigint",
        "orphan_sessions_count": "bigint",
        "duplicate_experiment_assignments": "bigint",
        "min_revenue": "decimal(12,2)",
        "max_revenue": "decimal(12,2)",
        "avg_revenue": "double",
        "extreme_outliers_count": "bigint",
    }

    def one_row(df: DataFrame, **values: Column) -> DataFrame:
        row = df.agg(*[value.alias(name) for name, value in values.items()])
        return row.select(
            *[
                (F.col(name) if name in values else F.lit(None)).cast(kind).alias(name)
                for name, kind in counters.items()
            ]
        )

    seen = t["events"].groupBy("session_id").agg(F.lit(1).alias("seen"))
    pairs = t["experiments"].groupBy("user_id", "experiment_name").count()
    value = F.col("order_value")
    parts = [
        one_row(
            t["events"], events_without_experiment=F.count_if(F.col("experiment_id").isNull())
        ),
        one_row(
            t["sessions"].select("session_id").join(seen, "session_id", "left_anti"),
            orphan_sessions_count=F.count("session_id"),
        ),
        one_row(
            pairs.where("count > 1"), duplicate_experiment_assignments=F.count(F.lit(1))
        ),
        one_row(
            t["orders"].where(is_sale()),
            min_revenue=F.min(value),
            max_revenue=F.max(value),
            avg_revenue=ratio(F.sum(value), F.count(value)),
            extreme_outliers_count=F.count_if(value > extreme_value),
        ),
    ]
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part)
    return united.agg(*[F.max(name).alias(name) for name in counters])


def srm_check(t: TableMap) -> DataFrame:
    """Observed against equal allocation per experiment, with the chi-square statistic."""
    counts = (
        active(t)
        .groupBy("experiment_name")
        .agg(
            F.count_if(F.col("variant") == S.CONTROL).alias("control_users"),
            F.count_if(F.col("variant") == S.VARIANT).alias("variant_users"),
            F.count(F.lit(1)).alias("total_users"),
        )
    )
    expected = F.col("total_users") * F.lit(0.5)

    def term(observed: str) -> Column:
        return F.pow(F.col(observed) - expected, F.lit(2.0)) / expected

    return counts.select(
        "experiment_name",
        "control_users",
        "variant_users",
        expected.alias("expected_control"),
        expected.alias("expected_variant"),
        (term("control_users") + term("variant_users")).alias("chi_square_stat"),
    )


# Columns whose NULLs make a row incomplete, per table.
COMPLETENESS_KEYS = {
    "users": ("user_id", "signup_date", "country_id"),
    "experiments": ("experiment_id", "user_id", "variant"),
    "sessions": ("session_id", "user_id", "session_start"),
    "events": ("event_id", "session_id", "event_type_id"),
    "orders": ("order_id", "user_id", "order_value"),
}


def completeness_check(t: TableMap) -> DataFrame:
    """Rows, rows with a NULL key column and completeness in percent, per table."""
    united = None
    for table, keys in COMPLETENESS_KEYS.items():
        incomplete = F.col(keys[0]).isNull()
        for key in keys[1:]:
            incomplete = incomplete | F.col(key).isNull()
        row = t[table].agg(
            F.lit(table).alias("table_name"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(incomplete).alias("null_count_key_columns"),
        )
        united = row if united is None else united.unionByName(row)
    share = ratio(F.col("null_count_key_columns"), F.col("row_count"))
    return united.select(
        "*",
        F.when(F.col("row_count") == 0, F.lit(0.0))
        .otherwise(F.lit(100.0) - share * 100)
        .alias("completeness_pct"),
    )
