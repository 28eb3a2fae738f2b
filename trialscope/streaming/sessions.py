"""Sessions of an event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


DEFAULT_GAP = "240 minutes"


def _named(rows: DataFrame, gap: str) -> DataFrame:
    """Sessions from the user, the window, its first event id and the number of events.

    A session window starts with its first event and ends one gap after its last.
    """
    start, end = F.col("w.start"), F.col("w.end") - F.expr(f"INTERVAL {gap}")
    seconds = (F.unix_micros(end) - F.unix_micros(start)) / 1_000_000
    return rows.select(
        "session_id",
        "user_id",
        start.alias("session_start"),
        end.alias("session_end"),
        F.floor(seconds).cast("int").alias("duration_seconds"),
        F.col("page_count").cast("int").alias("page_count"),
        (F.col("page_count") == 1).alias("is_bounce"),
    )


def session_windows(events: DataFrame, gap: str = DEFAULT_GAP) -> DataFrame:
    """Sessions of distinct events with a watermark."""
    window = F.session_window("event_timestamp", gap)
    found = events.groupBy("user_id", window.alias("w")).agg(
        F.min("event_id").alias("session_id"), F.count(F.lit(1)).alias("page_count")
    )
    return _named(found, gap)


def open_sessions(state: DataFrame, gap: str = DEFAULT_GAP) -> DataFrame:
    """Sessions that the state of ``session_windows`` still holds, as rows of the state store source."""
    held = state.select("value.*").toDF("user_id", "w", "session_id", "page_count")
    return _named(held, gap)


def stream_sessionize(
    events: DataFrame, gap: str = DEFAULT_GAP, delay: str = "1 day"
) -> DataFrame:
    """Gap-based sessions of a stream with columns event_id, user_id and event_timestamp.

    Repeated events are dropped while the watermark remembers them, events later than ``delay``
    behind the newest are dropped (``numRowsDroppedByWatermark`` in the query progress counts
    them), and a session is emitted once the watermark has passed its end.  State is bounded by
    the events of the last ``delay`` plus the open sessions.
    """
    return session_windows(
        events.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))
        .withWatermark("event_timestamp", delay)
        .dropDuplicatesWithinWatermark(["event_id"]),
        gap,
    )
