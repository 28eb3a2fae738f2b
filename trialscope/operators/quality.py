"""The data-quality gate: one result row per check.

Row: (table_name, check_name, severity, status, violations, detail).  A violated WARN check is a
warning and still counts as passed; a violated FAIL check makes the table invalid.  An empty
table yields the single failed check ``non_empty``; a table without a required column yields the
single failed check ``required_columns_present``.

Counters of a table come from one aggregation pass.  Duplicate keys need a pass grouped by key
and reference checks fold the child to one row per key before they meet the parent, so neither
depends on how often a key occurs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialscope import schemas as S
from trialscope.functions.ratios import ratio

# Thresholds of the gate.
SPLIT_WARN = (0.40, 0.60)
SPLIT_FAIL = (0.30, 0.70)
MAX_P99_DURATION = 7200
MAX_ORDER_VALUE = 10_000
MAX_REFUND_RATE = 0.30
MAX_TYPE_SHARE = 0.70

# Columns that the gate asks for: those that must not be NULL, without the flags.
REQUIRED = {
    table: tuple(c for c in S.not_null(table) if S.declared_columns(table)[c] != "boolean")
    for table in S.CORE_TABLES
}


@dataclass(frozen=True)
class Check:
    """A check over a one-row frame of counters; ``skip`` drops its row."""

    name: str
    violations: Column
    severity: str = "FAIL"
    detail: Column | None = None
    skip: Column | None = None


def _emit(counters: DataFrame, table: str, checks: Sequence[Check], rows: str | None) -> DataFrame:
    """Turn a frame of counters into check rows.

    ``rows`` names the row-count column: at zero the only row is a failed ``non_empty``.
    """

    def record(check: Check) -> Column:
        skip = F.lit(False) if check.skip is None else check.skip
        detail = F.lit(None) if check.detail is None else check.detail
        return F.struct(
            F.lit(check.name).alias("check_name"),
            F.lit(check.severity).alias("severity"),
            F.when(~skip, check.violations).cast("bigint").alias("violations"),
            detail.cast("string").alias("detail"),
        )

    records = F.array(*[record(c) for c in checks])
    if rows is not None:
        nothing = F.array(record(Check("non_empty", F.lit(1))))
        records = F.when(F.col(rows) > 0, records).otherwise(nothing)
    return (
        counters.select(F.inline(records))
        .where(F.col("violations").isNotNull())
        .select(
            F.lit(table).alias("table_name"),
            "check_name",
            "severity",
            F.when(F.col("violations") == 0, "PASS")
            .otherwise(F.col("severity"))
            .alias("status"),
            "violations",
            "detail",
        )
    )


def _all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _missing_columns(df: DataFrame, table: str) -> DataFrame | None:
    absent = [c for c in REQUIRED[table] if c not in df.columns]
    if not absent:
        return None
    check = Check("required_columns_present", F.lit(len(absent)), detail=F.lit(", ".join(absent)))
    return _emit(df.agg(F.count(F.lit(1)).alias("n")), table, [check], "n")


def _null_counters(table: str) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in REQUIRED[table]]


def _standard_checks(table: str) -> list[Check]:
    return [
        Check("required_columns_present", F.lit(0)),
        *[Check(f"no_nulls_{c}", F.col(f"null_{c}")) for c in REQUIRED[table]],
    ]


def _duplicates(df: DataFrame, table: str, keys: Sequence[str], name: str) -> DataFrame:
    """Rows beyond the first of every key; no row at all for an empty table."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"))
    return _emit(
        counted.agg(F.sum(F.col("c") - 1).alias("extra")), table, [Check(name, F.col("extra"))],
        None,
    )


def _orphans(
    child: DataFrame, column: str, parent: DataFrame, key: str, table: str, name: str
) -> DataFrame:
    """Child rows whose key is NULL or absent from the parent."""
    children = child.groupBy(F.col(column).alias("_k")).agg(F.count(F.lit(1)).alias("c"))
    known = parent.groupBy(F.col(key).alias("_p")).agg(F.lit(True).alias("known"))
    totals = children.join(known, F.col("_k") == F.col("_p"), "left").agg(
        F.sum(F.when(F.col("known"), 0).otherwise(F.col("c"))).alias("orphans")
    )
    return _emit(totals, table, [Check(name, F.col("orphans"))], None)


def _not_boolean(df: DataFrame, column: str) -> Column:
    if isinstance(df.schema[column].dataType, T.BooleanType):
        return F.lit(False)
    return ~F.lower(F.col(column).cast("string")).isin("true", "false", "0", "1")


def dq_users(users: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    bad = _missing_columns(users, "users")
    if bad is not None:
        return bad
    kind = F.col("customer_type")
    outside = F.lit(False)
    if start and end:
        day = F.to_date("signup_date")
        outside = (day < F.lit(start).cast("date")) | (day > F.lit(end).cast("date"))
    not_boolean = (
        _not_boolean(users, "is_returning") if "is_returning" in users.columns else F.lit(False)
    )
    per_type = users.groupBy("customer_type").agg(
        F.count(F.lit(1)).alias("n"),
        *_null_counters("users"),
        F.count_if(outside).alias("outside"),
        F.count_if(not_boolean).alias("not_boolean"),
    )
    typed = F.when(kind.isNotNull(), F.col("n"))
    counters = per_type.agg(
        F.sum("n").alias("n"),
        *[F.sum(f"null_{c}").alias(f"null_{c}") for c in REQUIRED["users"]],
        F.sum("outside").alias("outside"),
        F.sum("not_boolean").alias("not_boolean"),
        F.sum(F.when(kind.isNotNull() & ~kind.isin(*S.CUSTOMER_TYPES), F.col("n")).otherwise(0))
        .alias("bad_type"),
        F.max(typed).alias("largest"),
        F.max_by("customer_type", typed).alias("largest_type"),
        F.sum(typed).alias("typed"),
    )
    dominant = F.coalesce(
        ratio(F.col("largest"), F.col("typed")) > MAX_TYPE_SHARE, F.lit(False)
    )
    checks = [
        *_standard_checks("users"),
        Check("valid_customer_type", F.col("bad_type")),
        Check(
            "customer_type_balance",
            dominant.cast("bigint"),
            "WARN",
            F.when(dominant, F.col("largest_type")),
        ),
    ]
    if start and end:
        checks.append(Check("signup_date_range", F.col("outside")))
    if "is_returning" in users.columns:
        checks.append(Check("is_returning_boolean", F.col("not_boolean")))
    return _all(
        [
            _emit(counters.na.fill(0, ["n"]), "users", checks, "n"),
            _duplicates(users, "users", ["user_id"], "unique_user_id"),
        ]
    )


def dq_experiments(
    experiments: DataFrame, start: str | None = None, end: str | None = None
) -> DataFrame:
    bad = _missing_columns(experiments, "experiments")
    if bad is not None:
        return bad
    arm = F.col("variant")
    outside = F.lit(False)
    if start and end:
        day = F.to_date("assignment_timestamp")
        outside = (day < F.lit(start).cast("date")) | (day > F.lit(end).cast("date"))
    per_experiment = experiments.groupBy("experiment_name").agg(
        F.count(F.lit(1)).alias("n"),
        *_null_counters("experiments"),
        F.count_if(arm.isNotNull() & ~arm.isin(*S.VARIANTS)).alias("bad_variant"),
        F.count_if(outside).alias("outside"),
        F.count("variant").alias("labelled"),
        F.count_if(arm == S.VARIANT).alias("in_variant"),
    )
    sums = ["n", *[f"null_{c}" for c in REQUIRED["experiments"]], "bad_variant", "outside"]
    counters = per_experiment.agg(*[F.sum(c).alias(c) for c in sums])
    checks = [
        *_standard_checks("experiments"),
        Check("valid_variant_values", F.col("bad_variant")),
    ]
    if start and end:
        checks.append(Check("assignment_timestamp_range", F.col("outside")))

    share = F.coalesce(ratio(F.col("in_variant"), F.col("labelled")), F.lit(0.0))
    too_far = (share < SPLIT_FAIL[0]) | (share > SPLIT_FAIL[1])
    far = ((share < SPLIT_WARN[0]) | (share > SPLIT_WARN[1])) & ~too_far
    named = F.col("experiment_name").isNotNull()
    split = _emit(
        per_experiment,
        "experiments",
        [
            Check("variant_split", F.lit(1), "FAIL", F.col("experiment_name"), ~(named & too_far)),
            Check(
                "variant_split", far.cast("int"), "WARN", F.col("experiment_name"),
                ~named | too_far,
            ),
        ],
        None,
    )
    return _all(
        [
            _emit(counters.na.fill(0, ["n"]), "experiments", checks, "n"),
            split,
            _duplicates(
                experiments, "experiments", ["user_id", "experiment_name"],
                "unique_user_experiment",
            ),
        ]
    )


def _percentile_counters(column: str, limit: float) -> list[Column]:
    within = F.col(column) <= limit
    return [
        F.count(column).alias("measured"),
        F.count_if(within).alias("within"),
        F.max(F.when(within, F.col(column))).alias("last_within"),
        F.min(F.when(~within, F.col(column))).alias("first_beyond"),
    ]


def _percentile_exceeds(p: float, limit: float) -> Column:
    """Whether the interpolated percentile is above a limit, from plain counters.

    The two ranks around the percentile are both within the limit, both beyond it, or they are
    the last value within and the first beyond it; no sorting is needed to tell.
    """
    position = F.lit(p) * (F.col("measured") - 1)
    low, high = F.floor(position), F.ceil(position)
    between = F.col("last_within") + (F.col("first_beyond") - F.col("last_within")) * (
        position - low
    )
    exceeds = (low >= F.col("within")) | ((high >= F.col("within")) & (between > limit))
    return F.coalesce((F.col("measured") > 0) & exceeds, F.lit(False))


def dq_sessions(sessions: DataFrame) -> DataFrame:
    bad = _missing_columns(sessions, "sessions")
    if bad is not None:
        return bad
    counters = [
        F.count(F.lit(1)).alias("n"),
        *_null_counters("sessions"),
        F.count_if(F.col("session_end") < F.col("session_start")).alias("reversed"),
        F.count_if(F.col("duration_seconds") <= 0).alias("no_duration"),
        F.count_if(F.col("page_count") < 1).alias("no_page"),
    ]
    checks = [
        *_standard_checks("sessions"),
        Check("session_end_after_start", F.col("reversed")),
        Check("positive_duration", F.col("no_duration")),
        Check("page_count_minimum", F.col("no_page")),
    ]
    if "is_bounce" in sessions.columns:
        counters.append(
            F.count_if(F.col("is_bounce") & (F.col("page_count") > 1)).alias("odd_bounce")
        )
        checks.append(Check("bounce_page_count_consistency", F.col("odd_bounce"), "WARN"))
    counters += _percentile_counters("duration_seconds", MAX_P99_DURATION)
    long_tail = _percentile_exceeds(0.99, MAX_P99_DURATION)
    checks.append(Check("duration_distribution", long_tail.cast("bigint"), "WARN"))
    return _all(
        [
            _emit(sessions.agg(*counters), "sessions", checks, "n"),
            _duplicates(sessions, "sessions", ["session_id"], "unique_session_id"),
        ]
    )


def dq_events(
    events: DataFrame, sessions: DataFrame | None = None, event_types: DataFrame | None = None
) -> DataFrame:
    """Checks of events; those against sessions and event types need the other table."""
    bad = _missing_columns(events, "events")
    if bad is not None:
        return bad
    counters = [F.count(F.lit(1)).alias("n"), *_null_counters("events")]
    checks = _standard_checks("events")
    if "revenue" in events.columns:
        counters.append(F.count_if(F.col("revenue") < 0).alias("negative"))
        checks.append(Check("revenue_non_negative", F.col("negative")))
    parts = [
        _emit(events.agg(*counters), "events", checks, "n"),
        _duplicates(events, "events", ["event_id"], "unique_event_id"),
    ]
    if event_types is not None:
        paid = F.count("revenue") if "revenue" in events.columns else F.lit(0)
        by_type = events.groupBy(F.col("event_type_id").alias("_type")).agg(
            F.count(F.lit(1)).alias("c"), paid.alias("paid")
        )
        joined = by_type.join(
            event_types.select("event_type_id", "event_name"),
            F.col("_type") == F.col("event_type_id"),
            "left",
        )
        unknown = F.col("event_name").isNull()
        first_ids = (
            joined.where(unknown & F.col("_type").isNotNull())
            .orderBy("_type")
            .limit(10)
            .agg(F.array_join(F.sort_array(F.collect_list("_type")), ", ").alias("ids"))
        )
        totals = joined.agg(
            F.sum(F.when(F.col("event_name") != "purchase", F.col("paid")).otherwise(0))
            .alias("odd"),
            F.sum(F.when(unknown, F.col("c")).otherwise(0)).alias("unknown"),
        )
        both = totals.select("odd", "unknown", F.lit(None).cast("string").alias("ids")).unionByName(
            first_ids.select(
                F.lit(None).cast("bigint").alias("odd"),
                F.lit(None).cast("bigint").alias("unknown"),
                "ids",
            )
        ).agg(F.max("odd").alias("odd"), F.max("unknown").alias("unknown"), F.max("ids").alias("ids"))
        type_checks = [
            Check(
                "valid_event_type_ids", F.col("unknown"),
                detail=F.when(F.col("unknown") > 0, F.col("ids")),
            )
        ]
        if "revenue" in events.columns:
            type_checks.append(Check("revenue_only_on_purchase", F.col("odd"), "WARN"))
        parts.append(_emit(both, "events", type_checks, None))
    if sessions is not None:
        # One equi-join answers both session checks.  Only the child side can hold a hot key,
        # and a left outer join lets adaptive execution split that side.
        ts = F.col("event_timestamp")
        windows = sessions.select(
            F.col("session_id").alias("_session"), "session_start", "session_end"
        )
        totals = (
            events.select("session_id", "event_timestamp")
            .join(windows, F.col("session_id") == F.col("_session"), "left")
            .agg(
                F.count(F.lit(1)).alias("n"),
                F.count_if(F.col("_session").isNull()).alias("orphans"),
                F.count_if((ts < F.col("session_start")) | (ts > F.col("session_end")))
                .alias("outside"),
            )
        )
        empty = F.col("n") == 0
        parts.append(
            _emit(
                totals,
                "events",
                [
                    Check("no_orphan_events", F.col("orphans"), skip=empty),
                    Check("event_within_session_window", F.col("outside"), skip=empty),
                ],
                None,
            )
        )
    return _all(parts)


def dq_orders(
    orders: DataFrame, users: DataFrame | None = None, sessions: DataFrame | None = None
) -> DataFrame:
    bad = _missing_columns(orders, "orders")
    if bad is not None:
        return bad
    value, method, status = (
        F.col(c) for c in ("order_value", "payment_method", "payment_status")
    )
    counters = [
        F.count(F.lit(1)).alias("n"),
        *_null_counters("orders"),
        F.count_if(value <= 0).alias("no_value"),
        F.count_if(value > MAX_ORDER_VALUE).alias("extreme"),
        F.count_if(method.isNotNull() & ~method.isin(*S.PAYMENT_METHODS)).alias("bad_method"),
        F.count_if(status.isNotNull() & ~status.isin(*S.PAYMENT_STATUSES)).alias("bad_status"),
        F.count_if(status == "completed").alias("completed"),
    ]
    checks = [
        *_standard_checks("orders"),
        Check("order_value_positive", F.col("no_value")),
        Check("order_value_sanity", F.col("extreme"), "WARN"),
        Check("valid_payment_method", F.col("bad_method")),
        Check("valid_payment_status", F.col("bad_status")),
    ]
    if "is_refund" in orders.columns:
        counters.append(F.count_if("is_refund").alias("refunds"))
        too_many = ratio(F.col("refunds"), F.col("completed")) > MAX_REFUND_RATE
        checks.append(
            Check("refund_rate_sanity", too_many.cast("bigint"), "WARN",
                  skip=F.col("completed") == 0)
        )
    parts = [
        _emit(orders.agg(*counters), "orders", checks, "n"),
        _duplicates(orders, "orders", ["order_id"], "unique_order_id"),
    ]
    if users is not None:
        parts.append(
            _orphans(orders, "user_id", users, "user_id", "orders", "no_orphan_orders_user")
        )
    if sessions is not None:
        parts.append(
            _orphans(
                orders, "session_id", sessions, "session_id", "orders", "no_orphan_orders_session"
            )
        )
    return _all(parts)


def dq_cross_table(t) -> DataFrame:
    """Every assignment, session, event and order belongs to a known user."""
    users = t["users"]
    children = ("experiments", "sessions", "events", "orders")
    return _all(
        [
            _orphans(
                t[child], "user_id", users, "user_id", "cross_table_integrity",
                f"{child}_user_fk",
            )
            for child in children
        ]
    )


def dq_all(t, start: str | None = None, end: str | None = None) -> DataFrame:
    """Check rows of all five tables and of the references between them."""
    return _all(
        [
            dq_users(t["users"], start, end),
            dq_experiments(t["experiments"], start, end),
            dq_sessions(t["sessions"]),
            dq_events(t["events"], t["sessions"], t["event_types"]),
            dq_orders(t["orders"], t["users"], t["sessions"]),
            dq_cross_table(t),
        ]
    )


def dq_overall(checks: DataFrame) -> DataFrame:
    """Roll-up of check rows per table and in total (table_name ``ALL``)."""
    failed = F.col("status") == "FAIL"
    return (
        checks.rollup("table_name")
        .agg(
            F.count_if(~failed).alias("checks_passed"),
            F.count_if(failed).alias("checks_failed"),
            F.count_if(F.col("status") == "WARN").alias("warnings"),
            (F.count_if(failed) == 0).alias("is_valid"),
        )
        .withColumn("table_name", F.coalesce("table_name", F.lit("ALL")))
    )
