"""Sessions, orders and assignments computed from event and user tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialscope import schemas as S
from trialscope.functions.guards import assert_columns_exist
from trialscope.functions.hashing import draw

DEFAULT_GAP_MINUTES = 240


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def time_slot(ts: Column, gap_minutes: int) -> Column:
    """Start, in microseconds, of the gap-wide slot of the time axis that holds a timestamp."""
    micros = _micros(ts)
    return micros - F.pmod(micros, F.lit(gap_minutes * 60_000_000))


def numbered_slots(
    events: DataFrame,
    gap_minutes: int = DEFAULT_GAP_MINUTES,
    user: str = "user_id",
    ts: str = "event_timestamp",
    event_id: str = "event_id",
) -> DataFrame:
    """One row per (user, slot) with the number of its session among the user's sessions.

    Two events of a user in the same gap-wide slot are less than one gap apart, so a slot is
    never divided between sessions.  Events are therefore folded to slots first, with map-side
    combining: the window per user then sees at most (time span / gap) rows however many events
    the user has.
    """
    assert_columns_exist(events, [user, ts, event_id], "numbered_slots")
    slots = (
        events.where(F.col(ts).isNotNull())
        .groupBy(F.col(user).alias("user_id"), time_slot(F.col(ts), gap_minutes).alias("slot"))
        .agg(
            F.min(ts).alias("first_ts"),
            F.max(ts).alias("last_ts"),
            F.count(F.lit(1)).alias("n_events"),
            F.min(event_id).alias("first_event_id"),
        )
    )
    by_user = Window.partitionBy("user_id").orderBy("slot")
    so_far = by_user.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    idle = _micros(F.col("first_ts")) - F.lag(_micros(F.col("last_ts"))).over(by_user)
    opens = F.when(idle <= gap_minutes * 60_000_000, 0).otherwise(1)
    return (
        slots.withColumn("opens", opens)
        .withColumn("session_no", F.sum("opens").over(so_far))
        .drop("opens")
    )


def sessionize(
    events: DataFrame,
    gap_minutes: int = DEFAULT_GAP_MINUTES,
    user: str = "user_id",
    ts: str = "event_timestamp",
    event_id: str = "event_id",
) -> DataFrame:
    """Gap-based sessions: a new one starts when a user was idle for longer than the gap.

    A session is named after its smallest event id.
    """
    seconds = F.floor(
        (_micros(F.col("session_end")) - _micros(F.col("session_start"))) / F.lit(1_000_000)
    )
    return (
        numbered_slots(events, gap_minutes, user, ts, event_id)
        .groupBy("user_id", "session_no")
        .agg(
            F.min("first_event_id").alias("session_id"),
            F.min("first_ts").alias("session_start"),
            F.max("last_ts").alias("session_end"),
            F.sum("n_events").alias("page_count"),
        )
        .select(
            "session_id",
            "user_id",
            "session_start",
            "session_end",
            seconds.cast("int").alias("duration_seconds"),
            F.col("page_count").cast("int").alias("page_count"),
            (F.col("page_count") == 1).alias("is_bounce"),
        )
    )


def with_session_id(
    events: DataFrame,
    gap_minutes: int = DEFAULT_GAP_MINUTES,
    user: str = "user_id",
    ts: str = "event_timestamp",
    event_id: str = "event_id",
) -> DataFrame:
    """Append ``session_id`` to events by an equi-join on (user, slot).

    The slot is part of the join key, so a user with very many events is spread over as many
    keys as the user has active slots.
    """
    in_session = Window.partitionBy("user_id", "session_no")
    slots = numbered_slots(events, gap_minutes, user, ts, event_id).select(
        F.col("user_id").alias("_user"),
        F.col("slot").alias("_slot"),
        F.min("first_event_id").over(in_session).alias("session_id"),
    )
    same_slot = (F.col(user) == F.col("_user")) & (
        time_slot(F.col(ts), gap_minutes) == F.col("_slot")
    )
    return events.join(slots, same_slot, "left").drop("_user", "_slot")


def derive_orders(
    events: DataFrame,
    default_value: float = 50.0,
    floor: float = 1.0,
    payment_method: Column | str = "credit_card",
) -> DataFrame:
    """Canonical orders from purchase events: missing revenue gets a default, small values a floor.

    Events do not tell how was paid; ``payment_method`` is one method or a column of ``events``.
    """
    method = F.lit(payment_method) if isinstance(payment_method, str) else payment_method
    assert_columns_exist(
        events,
        ["event_id", "session_id", "user_id", "event_type_id", "event_timestamp", "revenue"],
        "derive_orders",
    )
    value = F.round(
        F.greatest(
            F.coalesce(F.col("revenue"), F.lit(default_value).cast("decimal(12,4)")),
            F.lit(floor).cast("decimal(12,4)"),
        ),
        2,
    )
    return events.where(F.col("event_type_id") == S.event_type_id("purchase")).select(
        F.col("event_id").alias("order_id"),
        "user_id",
        "session_id",
        "event_id",
        F.col("event_timestamp").alias("order_timestamp"),
        value.cast("decimal(12,2)").alias("order_value"),
        method.alias("payment_method"),
        F.lit(False).alias("is_refund"),
        F.lit("completed").alias("payment_status"),
    )


def assign_variants(
    users: DataFrame,
    experiments: Sequence[tuple[str, int]] = (("checkout_redesign", 500),),
    holdout_permille: int = 20,
    ramp_days: int = 14,
    start: str = "2024-01-01",
) -> DataFrame:
    """Deterministic assignment by hash of the user id, which may be of any type; no shuffle.

    ``experiments`` lists (name, variant share in permille).  The name is the salt of the draw, so
    experiments split the same users independently of each other, and the holdout, which is the
    same for all of them, has a salt of its own.  Held-out users keep the control label, as they
    see the control experience.  Users without id are not assigned.
    """
    assert_columns_exist(users, ["user_id"], "assign_variants")
    if len({name for name, _ in experiments}) < len(experiments):
        raise ValueError("two experiments have the same name")
    uid, name = F.col("user_id"), F.col("experiment_name")
    plan = F.array(
        *[
            F.struct(F.lit(name).alias("experiment_name"), F.lit(share).alias("share"))
            for name, share in experiments
        ]
    )
    ramp = draw(uid, F.concat(name, F.lit(" ramp")), ramp_days)
    return (
        users.where(uid.isNotNull())
        .select("user_id", F.explode(plan).alias("e"))
        .select("user_id", "e.*", (draw(uid, "holdout", 1000) < holdout_permille).alias("is_holdout"))
        .select(
            "user_id",
            "experiment_name",
            F.when(~F.col("is_holdout") & (draw(uid, name, 1000) < F.col("share")), S.VARIANT)
            .otherwise(S.CONTROL)
            .alias("variant"),
            F.date_add(F.lit(start).cast("date"), ramp.cast("int")).alias("assignment_date"),
            "is_holdout",
        )
    )
