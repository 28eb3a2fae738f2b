"""Derived tables per experiment arm.  Every function maps canonical tables to a lazy DataFrame.

Facts (orders, sessions, events) are folded to user grain before they meet the assignments:
the fold combines on the map side, so a user with a large share of all rows still arrives at the
join as one row (or as few rows as the user has active days or distinct durations).  Assignments
are folded to one row per (experiment, arm, user) with a multiplicity ``n_rows``, so repeated
assignment rows count once in distinct-user counts and repeatedly in sums.

Order and session ids are primary keys (``constraints.unique_check`` verifies it); counting
them needs no distinct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialscope import schemas as S
from trialscope.functions.quantiles import percentiles
from trialscope.functions.ratios import ratio, ratio_or_zero, rounded_quotient
from trialscope.operators.arms import ARM, TableMap, active, arm_users, is_sale, money, sales_by_user
from trialscope.operators.attribution import orders_after_assignment, orders_of_arm_users
from trialscope.operators.sketches import session_states, united_percentiles

def _zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def sales_of_arm_users(t: TableMap, after_assignment: bool = False) -> DataFrame:
    """``arm_users`` with their sales: all of the user, or those from its assignment to the arm on."""
    users = arm_users(t)
    if not after_assignment:
        return users.join(sales_by_user(t), "user_id", "left")
    sales = orders_of_arm_users(t).where(F.col("sales") > 0)
    sales = sales.select(*ARM, "user_id", F.col("sales").alias("user_orders"), F.col("gross").alias("user_revenue"))
    return users.join(sales, [*ARM, "user_id"], "left")


def experiment_summary(t: TableMap, after_assignment: bool = False) -> DataFrame:
    """Users, purchasers, revenue and rates per arm.

    Purchases attach by user only, unless ``after_assignment``: then those from the assignment on.
    """
    users = F.count("user_id")
    buyers = F.count("user_orders")
    revenue = money(_zero_if_null(F.sum(F.col("user_revenue") * F.col("n_rows"))))
    orders = _zero_if_null(F.sum(F.col("user_orders") * F.col("n_rows")))
    totals = (
        sales_of_arm_users(t, after_assignment)
        .groupBy(*ARM)
        .agg(
            users.alias("total_users"),
            buyers.alias("purchasers"),
            revenue.alias("total_revenue"),
            orders.alias("total_orders"),
            F.min("first_assigned").alias("experiment_start"),
            F.max("last_assigned").alias("experiment_end"),
        )
    )
    return totals.select(
        *ARM,
        "total_users",
        "purchasers",
        "total_revenue",
        "total_orders",
        ratio_or_zero(F.col("purchasers"), F.col("total_users")).alias("conversion_rate"),
        ratio_or_zero(F.col("total_revenue"), F.col("total_users")).alias("revenue_per_visitor"),
        ratio_or_zero(F.col("total_revenue"), F.col("total_orders")).alias("average_order_value"),
        "experiment_start",
        "experiment_end",
    )


def assigned_per_day(t: TableMap) -> DataFrame:
    """Users that an arm got per day."""
    return (
        active(t)
        .groupBy(F.to_date("assignment_timestamp").alias("metric_date"), *ARM)
        .agg(F.count_distinct("user_id").alias("users_assigned"))
    )


def sales_by_user_day(t: TableMap) -> DataFrame:
    return (
        t["orders"]
        .where(is_sale())
        .groupBy("user_id", F.to_date("order_timestamp").alias("metric_date"))
        .agg(
            F.count("order_id").alias("user_orders"),
            money(F.sum("order_value")).alias("user_revenue"),
        )
    )


def sales_per_day(user_days: DataFrame, t: TableMap) -> DataFrame:
    """Purchases per day and arm from ``sales_by_user_day``."""
    return _summed_per_day(user_days.join(arm_users(t).select(*ARM, "user_id", "n_rows"), "user_id"))


def _summed_per_day(arm_user_days: DataFrame) -> DataFrame:
    return (
        arm_user_days
        .groupBy("metric_date", *ARM)
        .agg(
            F.count(F.lit(1)).alias("purchasing_users"),
            F.sum("user_orders").alias("order_count"),
            money(F.sum(F.col("user_revenue") * F.col("n_rows"))).alias("daily_revenue"),
        )
    )


def daily_counts(assigned: DataFrame, sales: DataFrame) -> DataFrame:
    """Assignment days of an arm with their purchases, which are additive over users."""
    return assigned.join(sales, ["metric_date", *ARM], "left").select(
        "metric_date",
        *ARM,
        "users_assigned",
        _zero_if_null(F.col("purchasing_users")).alias("purchasing_users"),
        _zero_if_null(F.col("order_count")).alias("order_count"),
        money(_zero_if_null(F.col("daily_revenue"))).alias("daily_revenue"),
    )


def daily_rates(counts: DataFrame) -> DataFrame:
    """Daily, cumulative and rolling metrics over ``daily_counts``."""
    by_day = Window.partitionBy(*ARM).orderBy("metric_date")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    week = by_day.rowsBetween(-6, Window.currentRow)
    return counts.select(
        "*",
        ratio_or_zero(F.col("purchasing_users"), F.col("users_assigned")).alias(
            "daily_conversion_rate"
        ),
        ratio_or_zero(F.col("daily_revenue"), F.col("users_assigned")).alias(
            "daily_revenue_per_visitor"
        ),
        F.sum("users_assigned").over(so_far).alias("cumulative_users"),
        F.sum("purchasing_users").over(so_far).alias("cumulative_purchasers"),
        ratio(F.sum("purchasing_users").over(week), F.sum("users_assigned").over(week)).alias(
            "rolling_7d_conversion_rate"
        ),
    )


def daily_metrics_view(t: TableMap, after_assignment: bool = False) -> DataFrame:
    """Daily, cumulative and rolling metrics, one row per assignment day of an arm.

    Days are anchored on assignments: sales on a day without assignments do not appear.  The
    rolling rate spans seven rows, which are seven days only when no day is missing.  With
    ``after_assignment`` purchases before a user's assignment to the arm do not count.
    """
    if after_assignment:
        days = orders_after_assignment(t).where(F.col("sales") > 0)
        days = days.withColumnsRenamed({"sales": "user_orders", "gross": "user_revenue"})
        return daily_rates(daily_counts(assigned_per_day(t), _summed_per_day(days)))
    return daily_rates(daily_counts(assigned_per_day(t), sales_per_day(sales_by_user_day(t), t)))


def with_cumulative_rate(daily: DataFrame) -> DataFrame:
    return daily.withColumn(
        "cumulative_conversion_rate",
        ratio_or_zero(F.col("cumulative_purchasers"), F.col("cumulative_users")),
    )


def mv_daily_conversion(t: TableMap) -> DataFrame:
    return with_cumulative_rate(daily_metrics_view(t))


def funnel_steps_view(t: TableMap) -> DataFrame:
    """Users of each arm who ever reached each of the five steps, in any order.

    Events are folded to one row of flags per session, then per user, before the assignments
    are joined.
    """
    steps = t["event_types"].where(F.col("funnel_step").isNotNull()).select(
        "event_type_id", "event_name"
    )
    reached = {column: F.col("event_name") == event for _, _, column, event in S.FUNNEL_STEPS}
    per_session = (
        t["events"]
        .select("session_id", "event_type_id")
        .join(steps, "event_type_id")
        .groupBy("session_id")
        .agg(*[F.bool_or(flag).alias(column) for column, flag in reached.items()])
    )
    per_user = (
        t["sessions"]
        .select("session_id", "user_id")
        .join(per_session, "session_id")
        .groupBy("user_id")
        .agg(*[F.bool_or(column).alias(column) for column in reached])
    )
    counts = (
        arm_users(t)
        .select(*ARM, "user_id")
        .join(per_user, "user_id", "left")
        .groupBy(*ARM)
        .agg(
            F.count("user_id").alias("total_users"),
            *[F.count_if(F.col(column)).alias(column) for column in reached],
        )
    )

    def rate(part: str, whole: str, name: str) -> Column:
        return ratio_or_zero(F.col(part), F.col(whole)).alias(name)

    return counts.select(
        "*",
        rate("product_users", "landing_users", "landing_to_product_rate"),
        rate("cart_users", "product_users", "product_to_cart_rate"),
        rate("checkout_users", "cart_users", "cart_to_checkout_rate"),
        rate("purchase_users", "checkout_users", "checkout_to_purchase_rate"),
        rate("purchase_users", "total_users", "overall_funnel_rate"),
    )


def session_metrics_view(t: TableMap, approx: bool = False) -> DataFrame:
    """Session counts, averages and duration percentiles per arm, exact unless ``approx``.

    Approximate percentiles come from mergeable states (see ``operators.sketches``) and need no
    histogram of durations; all else stays exact.

    ``sessions_per_user`` keeps the published definition, users divided by sessions;
    ``avg_sessions_per_user`` is the other way round.
    """
    if approx:
        return _approximate_session_metrics(t)
    durations = (
        t["sessions"]
        .groupBy("user_id", "duration_seconds")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("page_count").alias("pages"),
            F.count("page_count").alias("pages_n"),
            F.count_if("is_bounce").alias("bounces"),
        )
    )
    first_of_user = F.row_number().over(
        Window.partitionBy("user_id").orderBy("duration_seconds")
    )
    weight = F.col("n_rows")
    hist = (
        durations.withColumn("user_mark", (first_of_user == 1).cast("int"))
        .join(arm_users(t).select(*ARM, "user_id", "n_rows"), "user_id")
        .groupBy(*ARM, "duration_seconds")
        .agg(
            F.sum(F.col("n") * weight).alias("w"),
            F.sum(F.col("pages") * weight).alias("pages"),
            F.sum(F.col("pages_n") * weight).alias("pages_n"),
            F.sum("n").alias("sessions"),
            F.sum("bounces").alias("bounces"),
            F.sum("user_mark").alias("users"),
        )
    )
    totals = hist.groupBy(*ARM).agg(
        *[F.sum(c).alias(c) for c in ("sessions", "users", "pages", "pages_n", "bounces")],
        F.sum(F.col("duration_seconds").cast("bigint") * F.col("w")).alias("seconds"),
    )
    marks = percentiles(
        hist, ARM, "duration_seconds", "w", {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}
    )
    sessions, users = F.col("sessions"), F.col("users")
    # An arm none of whose durations is known has no percentiles, but it has sessions.
    return totals.join(marks, list(ARM), "left").select(
        *ARM,
        sessions.alias("total_sessions"),
        users.alias("unique_users"),
        rounded_quotient(F.col("seconds"), F.col("n"), 2).alias(
            "avg_session_duration_seconds"
        ),
        F.round("p50", 2).alias("median_session_duration_seconds"),
        rounded_quotient(F.col("pages"), F.col("pages_n"), 2).alias("avg_pages_per_session"),
        rounded_quotient(F.col("bounces"), sessions, 4).alias("bounce_rate"),
        F.col("bounces").alias("bounced_sessions"),
        rounded_quotient(users, sessions, 3).alias("sessions_per_user"),
        rounded_quotient(sessions, users, 3).alias("avg_sessions_per_user"),
        F.col("p25").alias("p25_duration_seconds"),
        F.col("p75").alias("p75_duration_seconds"),
        F.col("p95").alias("p95_duration_seconds"),
    )


def _approximate_session_metrics(t: TableMap) -> DataFrame:
    marks = {f"p{p}": p / 100 for p in (25, 50, 75, 95)}
    sessions, users = F.col("total_sessions"), F.col("unique_users")
    percentiles_ = united_percentiles(session_states(t), ARM, marks)
    return session_averages(t).join(percentiles_, list(ARM), "left").select(
        *ARM,
        "total_sessions",
        "unique_users",
        "avg_session_duration_seconds",
        F.col("p50").alias("median_session_duration_seconds"),
        "avg_pages_per_session",
        "bounce_rate",
        "bounced_sessions",
        rounded_quotient(users, sessions, 3).alias("sessions_per_user"),
        rounded_quotient(sessions, users, 3).alias("avg_sessions_per_user"),
        *[F.col(f"p{p}").alias(f"p{p}_duration_seconds") for p in (25, 75, 95)],
    )


def session_averages(t: TableMap) -> DataFrame:
    """The columns of ``session_metrics_view`` that need no percentiles.

    Sessions are folded to users, so this costs one aggregation and one join.
    """
    weight = F.col("n_rows")
    per_user = (
        t["sessions"]
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("sessions"),
            F.sum("duration_seconds").alias("seconds"),
            F.count("duration_seconds").alias("seconds_n"),
            F.sum("page_count").alias("pages"),
            F.count("page_count").alias("pages_n"),
            F.count_if("is_bounce").alias("bounces"),
        )
    )
    weighted = ("seconds", "seconds_n", "pages", "pages_n")
    totals = (
        per_user.join(arm_users(t).select(*ARM, "user_id", "n_rows"), "user_id")
        .groupBy(*ARM)
        .agg(
            F.sum("sessions").alias("total_sessions"),
            F.count("user_id").alias("unique_users"),
            *[F.sum(F.col(c) * weight).alias(c) for c in weighted],
            F.sum("bounces").alias("bounced_sessions"),
        )
    )
    sessions = F.col("total_sessions")
    return totals.select(
        *ARM,
        "total_sessions",
        "unique_users",
        rounded_quotient(F.col("seconds"), F.col("seconds_n"), 2).alias(
            "avg_session_duration_seconds"
        ),
        rounded_quotient(F.col("pages"), F.col("pages_n"), 2).alias("avg_pages_per_session"),
        rounded_quotient(F.col("bounced_sessions"), sessions, 4).alias("bounce_rate"),
        "bounced_sessions",
    )


SEGMENT = (
    "device_type",
    "country_name",
    "country_code",
    "region_name",
    "channel_name",
    "customer_type",
)


def user_profiles(t: TableMap) -> DataFrame:
    """Users with the names of their dimensions; the lookups are small, Spark broadcasts them."""
    return (
        t["users"]
        .select("user_id", "device_id", "country_id", "channel_id", "customer_type")
        .join(t["devices"], "device_id")
        .join(t["countries"], "country_id")
        .join(t["regions"], "region_id")
        .join(t["acquisition_channels"], "channel_id")
        .select("user_id", *SEGMENT)
    )


def segment_conversion(t: TableMap) -> DataFrame:
    """Users, purchasers and conversion per arm and combination of user dimensions."""
    buyers = t["orders"].where(is_sale()).groupBy("user_id").agg(F.lit(1).alias("bought"))
    return (
        arm_users(t)
        .select(*ARM, "user_id")
        .join(user_profiles(t), "user_id")
        .join(buyers, "user_id", "left")
        .groupBy(*ARM, *SEGMENT)
        .agg(
            F.count("user_id").alias("total_users"),
            F.count("bought").alias("purchasers"),
        )
        .withColumn(
            "conversion_rate", ratio_or_zero(F.col("purchasers"), F.col("total_users"))
        )
    )


def orders_by_user_and_kind(t: TableMap) -> DataFrame:
    sale, refund = is_sale(), F.col("is_refund")
    return (
        t["orders"]
        .groupBy("user_id")
        .agg(
            money(F.sum(F.when(sale, F.col("order_value")))).alias("gross"),
            money(F.sum(F.when(refund, F.col("order_value")))).alias("refunded"),
            F.count_if(sale).alias("sales"),
            F.count_if(refund).alias("refunds"),
            F.count_if(F.col("payment_status") == "failed").alias("failures"),
        )
    )


def revenue_summary(t: TableMap, after_assignment: bool = False) -> DataFrame:
    """Gross, refunded and net revenue per arm; arms without any order do not appear.

    With ``after_assignment`` orders before a user's assignment to the arm do not count.
    """
    per_user = orders_of_arm_users(t) if after_assignment else orders_by_user_and_kind(t)
    key = [*ARM, "user_id"] if after_assignment else ["user_id"]
    totals = (
        arm_users(t)
        .select(*ARM, "user_id", "n_rows")
        .join(per_user, key, "left")
        .groupBy(*ARM)
        .agg(
            F.count("user_id").alias("total_users"),
            F.count("sales").alias("users_with_orders"),
            money(F.sum(F.col("gross") * F.col("n_rows"))).alias("gross_revenue"),
            money(F.sum(F.col("refunded") * F.col("n_rows"))).alias("refunded_revenue"),
            F.sum("sales").alias("completed_orders"),
            F.sum("refunds").alias("refunded_orders"),
            F.sum("failures").alias("failed_orders"),
        )
        .where(F.col("users_with_orders") > 0)
    )
    gross = F.col("gross_revenue")
    return totals.select(
        *ARM,
        "total_users",
        "gross_revenue",
        "refunded_revenue",
        money(gross - _zero_if_null(F.col("refunded_revenue"))).alias("net_revenue"),
        "completed_orders",
        "refunded_orders",
        "failed_orders",
        ratio_or_zero(gross, F.col("total_users")).alias("revenue_per_visitor"),
        ratio_or_zero(gross, F.col("completed_orders")).alias("average_order_value"),
        ratio_or_zero(F.col("refunded_orders"), F.col("completed_orders")).alias("refund_rate"),
    )


def orders_by_user(t: TableMap) -> DataFrame:
    sale = is_sale()
    return (
        t["orders"]
        .groupBy("user_id")
        .agg(
            money(F.sum(F.when(sale, F.col("order_value")))).alias("revenue"),
            F.count_if(sale).alias("orders"),
            F.max("order_timestamp").alias("last_purchase_date"),
            F.bool_or(sale).alias("bought"),
        )
    )


def sessions_by_user(t: TableMap) -> DataFrame:
    return (
        t["sessions"]
        .groupBy("user_id")
        .agg(
            F.count("session_id").alias("sessions"),
            F.sum("duration_seconds").alias("seconds"),
            F.count("duration_seconds").alias("seconds_n"),
            F.sum("page_count").alias("pages"),
            F.count("page_count").alias("pages_n"),
            F.count_if("is_bounce").alias("bounces"),
        )
    )


def profiled_assignments(t: TableMap) -> DataFrame:
    """Active assignments with their users' dimensions: the part of the user view without facts."""
    return (
        active(t)
        .select(*ARM, "user_id", "assignment_timestamp")
        .join(user_profiles(t), "user_id")
        .select(
            "user_id",
            *ARM,
            "assignment_timestamp",
            F.to_date("assignment_timestamp").alias("assignment_date"),
            *USER_DIMENSIONS,
        )
    )


USER_DIMENSIONS = (
    "customer_type",
    "device_type",
    "country_name",
    "country_code",
    "region_name",
    "channel_name",
)
ASSIGNMENT = ("user_id", *ARM, "assignment_timestamp", "assignment_date", *USER_DIMENSIONS)


def user_behaviour(joined: DataFrame) -> DataFrame:
    """The user view from assignments joined to ``orders_by_user`` and ``sessions_by_user``."""
    zero = F.lit(0.0)
    return joined.select(
        *ASSIGNMENT,
        F.coalesce("bought", F.lit(False)).alias("made_purchase"),
        _zero_if_null(F.col("orders")).alias("order_count"),
        money(_zero_if_null(F.col("revenue"))).alias("total_revenue"),
        "last_purchase_date",
        _zero_if_null(F.col("sessions")).alias("session_count"),
        F.coalesce(ratio(F.col("seconds"), F.col("seconds_n")), zero).alias(
            "avg_session_duration_seconds"
        ),
        F.coalesce(ratio(F.col("pages"), F.col("pages_n")), zero).alias("avg_page_count"),
        F.coalesce(ratio(F.col("bounces"), F.col("sessions")), zero).alias("bounce_rate"),
    )


def mv_user_experiment_summary(t: TableMap) -> DataFrame:
    """One row per active assignment with dimensions, purchases and session behaviour."""
    return user_behaviour(
        profiled_assignments(t)
        .join(orders_by_user(t), "user_id", "left")
        .join(sessions_by_user(t), "user_id", "left")
    )


VIEWS = {
    "experiment_summary": experiment_summary,
    "daily_metrics_view": daily_metrics_view,
    "funnel_steps_view": funnel_steps_view,
    "session_metrics_view": session_metrics_view,
    "segment_conversion": segment_conversion,
    "revenue_summary": revenue_summary,
}
MATERIALIZED_VIEWS = {
    "mv_user_experiment_summary": mv_user_experiment_summary,
    "mv_daily_conversion": mv_daily_conversion,
}


def register_views(t: TableMap) -> None:
    """Expose every view and materialized view to ``spark.sql`` under its own name."""
    for name, build in {**VIEWS, **MATERIALIZED_VIEWS}.items():
        build(t).createOrReplaceTempView(name)
