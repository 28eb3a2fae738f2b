"""The named queries: every operator over a folder of warehouse tables.

Doubles are published with nine decimals; the operators themselves do not round.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialscope import schemas as S
from trialscope.functions.guards import assert_columns_exist, assert_not_empty
from trialscope.functions.ratios import with_conversion_rate, with_lift
from trialscope.operators import (
    constraints,
    decisions,
    frames,
    funnel,
    metrics,
    outliers,
    quality,
    reporting,
    reports,
    segments,
    sessions,
    sketches,
    statistics,
    views,
)
from trialscope.plans import refresh
from trialscope.sources import lookups, storage, warehouse
from trialscope.sources.tables import Tables
from trialscope.streaming import activity, allocation, continuing, replay
from trialscope.streaming import sessions as stream_sessions

Query = Callable[[SparkSession, str], DataFrame]

STAMP = "2024-02-01 00:00:00"
DECIMALS = 9


def published(df: DataFrame) -> DataFrame:
    return df.select(
        *[
            F.round(F.col(c), DECIMALS).alias(c) if kind == "double" else F.col(c)
            for c, kind in df.dtypes
        ]
    )


def _united(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _counts(spark: SparkSession, rows: dict[str, int], name: str) -> DataFrame:
    return spark.createDataFrame(list(rows.items()), f"{name} string, row_count bigint")


# --- sources and sinks -------------------------------------------------------------------


def _checksum(df: DataFrame, column: str) -> Column:
    """The sum of a number for each value that another engine computes alike."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.StringType):
        number = F.conv(F.substring(F.md5(c.cast("binary")), 1, 8), 16, 10)
    elif isinstance(kind, T.DateType):
        number = F.unix_date(c)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        number = F.unix_micros(c.cast("timestamp"))
    elif isinstance(kind, T.BooleanType):
        number = c.cast("int")
    else:
        number = c
    return F.sum(number.cast("decimal(30,4)")).cast("decimal(38,4)")


def _contents(t) -> DataFrame:
    """(table_name, column_name, non_null, checksum) of the core tables' declared columns."""
    parts = []
    for table in S.CORE_TABLES:
        df = t[table]
        cells = [
            F.struct(
                F.lit(c).alias("column_name"),
                F.count(c).alias("non_null"),
                _checksum(df, c).alias("checksum"),
            ).alias(c)
            for c in S.declared_columns(table)
        ]
        row = df.agg(*cells).select(F.inline(F.array(*S.declared_columns(table))))
        parts.append(row.select(F.lit(table).alias("table_name"), "*"))
    return _united(parts)


def _scan_tables(spark, t):
    root = storage.scratch_path(spark, "raw")
    storage.sink_raw(t, root)
    return _contents(storage.scan_tables(spark, root))


def _sink_raw(spark, t):
    """What the files hold that the sink has written, beside the rows it says it wrote."""
    root = storage.scratch_path(spark, "raw")
    written = storage.sink_raw(t, root, "parquet")
    counts = _counts(spark, written, "table_name").withColumnRenamed("row_count", "rows_written")
    files = {name: spark.read.parquet(storage.table_path(root, name)) for name in written}
    return _contents(files).join(counts, "table_name")


#: What the text of a finite double looks like; a cast that fails costs much more than a look at the text.
_NUMBER = (
    r"^[\x00-\x20]*+[+-]?(?:0[xX](?:[0-9a-fA-F]++\.?|[0-9a-fA-F]*\.[0-9a-fA-F]++)[pP][+-]?[0-9]++"
    r"|(?:[0-9]++(?:\.[0-9]*+)?|\.[0-9]++)(?:[eE][+-]?[0-9]++)?)[fFdD]?[\x00-\x20]*+$"
)


def _sum_of_32_bits(value: Column) -> Column:
    high, low = F.sum(F.shiftright(value, 16)), F.sum(value.bitwiseAND(0xFFFF))
    return high.cast("decimal(20,0)") * 65536 + low


def _text_sums(name: str, df: DataFrame, label: str) -> DataFrame:
    """(label, column_name, non_null, checksum) of any frame: numbers are summed to six places, other
    values as numbers made from their text.

    The two kinds are summed apart.  Those made from texts have 32 bits; their halves are summed as integers,
    which costs much less than decimals do and does not overflow below 2^47 rows.
    """
    numbers, hashes, cells = [], [], []
    for i, (c, kind) in enumerate(df.dtypes):
        text, number = F.col(c).cast("string"), F.lit(None).cast("decimal(30,6)")
        if not (kind == "boolean" or kind.startswith(("date", "timestamp"))):
            plain = kind in ("tinyint", "smallint", "int", "bigint", "double") or kind.startswith("decimal")
            number = (F.col(c) if plain else text).try_cast("double").try_cast("decimal(30,6)")
        if kind == "string":
            number = F.when(text.rlike(_NUMBER), number)
        hashed = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")
        numbers.append(number.alias(f"_n{i}"))
        hashes.append(F.when(F.col(f"_n{i}").isNull(), hashed).alias(f"_h{i}"))
        of_numbers, of_texts = F.sum(f"_n{i}"), _sum_of_32_bits(F.col(f"_h{i}"))
        total = F.coalesce(of_numbers + of_texts, of_numbers, of_texts).cast("decimal(38,6)")
        cells.append(F.struct(F.lit(c).alias("column_name"), F.count(c).alias("non_null"), total.alias("checksum")))
    values = df.select("*", *numbers).select("*", *hashes)
    sums = values.agg(*[cell.alias(f"c{i}") for i, cell in enumerate(cells)])
    rows = sums.select(F.inline(F.array(*[f"c{i}" for i in range(len(cells))])))
    return rows.select(F.lit(name).alias(label), "*")


def _bulk_load(spark, t):
    root = storage.scratch_path(spark, "load")
    storage.bulk_load(t, root, truncate_first=True)
    return _contents(storage.read_loaded(spark, root))


def _row_count_reconcile(spark, t):
    root = storage.scratch_path(spark, "load")
    expected = _counts(spark, storage.bulk_load(t, root), "table_name")
    return storage.row_count_reconcile(storage.read_loaded(spark, root), expected)


def _refresh_materialized(spark, t):
    root = storage.scratch_path(spark, "views")
    refresh.refresh_materialized(spark, t, root)
    return _united(
        [
            _text_sums(name, refresh.read_materialized(spark, root, name), "view_name")
            for name in views.MATERIALIZED_VIEWS
        ]
    )


def _loaded_twice(spark, t, name):
    """A view after two loads, of which the second one adds orders and sessions."""
    root = storage.scratch_path(spark, "changes")
    second = {"orders": F.col("order_id") % 4 == 0, "sessions": F.col("session_id") % 3 == 0}
    storage.bulk_load({n: t[n].where(~second.get(n, F.lit(False))) for n in S.CORE_TABLES if n != "events"}, root)
    refresh.refresh_from_changes(spark, root, f"{root}/views", t)
    storage.bulk_load({n: t[n].where(more) for n, more in second.items()}, root)
    refresh.refresh_from_changes(spark, root, f"{root}/views", t)
    return refresh.read_materialized(spark, f"{root}/views", name)


def _with_sessions_once(spark, t):
    """Three of the datasets use the sessions, one of them twice."""
    return storage.written_once(spark, t, storage.scratch_path(spark, "sessions"), ["sessions"])


def _export_datasets(spark, t):
    """What the exported files hold, as the types of the datasets."""
    root = storage.scratch_path(spark, "export")
    bundle = reporting.dataset_bundle(_with_sessions_once(spark, t))
    parts = []
    for name in sorted(storage.export_datasets(bundle, root)):
        texts = storage.read_export(spark, f"{root}/{name}")
        typed = texts.select(*[F.col(c).cast(kind).alias(c) for c, kind in bundle[name].dtypes])
        parts.append(_text_sums(name, typed, "dataset"))
    return _united(parts)


def _dataset_bundle(spark, t):
    bundle = reporting.dataset_bundle(_with_sessions_once(spark, t))
    return _united([_text_sums(name, df, "dataset") for name, df in bundle.items()])


def _experiment_report(spark, t):
    """The nested report, written, read back and laid out as one row per section, item and metric."""
    path = storage.scratch_path(spark, "report")
    reporting.experiment_report(t).write.parquet(path)
    report = spark.read.parquet(path)

    def long(section: str, item, names) -> DataFrame:
        one = section == "metrics"
        rows = report.select("experiment_name", F.col("metrics.*") if one else F.inline(section))
        values = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])
        return rows.select("experiment_name", F.lit(section).alias("section"), item.alias("item"), F.inline(values))

    segments_ = [c for c in reporting.SEGMENT_FIELDS if c not in ("dimension", "segment")]
    return _united(
        [
            long("metrics", F.lit("all"), report.schema["metrics"].dataType.names),
            long("funnel", F.concat_ws(" ", "variant", "step_name"), reporting.FUNNEL_FIELDS[3:]),
            long("segments", F.concat_ws(" ", "dimension", "segment"), segments_),
            long("daily", F.concat_ws(" ", F.col("metric_date").cast("string"), "variant"), reporting.DAILY_FIELDS[2:]),
        ]
    )


def _block_sample(spark, t):
    """Sums of a quarter of the days of the loaded orders, of which only these days' files are read."""
    root = storage.scratch_path(spark, "blocks")
    storage.bulk_load({"orders": t["orders"]}, root, truncate_first=True)
    days = storage.LAYOUT["orders"][0]
    sample = reporting.block_sample(storage.read_loaded(spark, root)["orders"], days, 0.25)
    return sample.groupBy(days).agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("order_value").cast("decimal(38,2)").alias("revenue"),
        F.count_distinct("user_id").alias("users"),
    )


def _dim_lookup_seed(spark, t):
    """Lookup rows after seeding, with how many rows of the data refer to each."""
    users, events = t["users"], t["raw_events"]
    plan = {
        "regions": ("region_id", "region_name", t["countries"]),
        "countries": ("country_id", "country_name", users),
        "devices": ("device_id", "device_type", users),
        "browsers": ("browser_id", "browser_name", users),
        "acquisition_channels": ("channel_id", "channel_name", users),
        "event_types": ("event_type_id", "event_name", events),
    }
    seeded = lookups.seed_lookups(spark, t)
    parts = []
    for table, (identity, name, referring) in plan.items():
        uses = referring.groupBy(identity).agg(F.count(F.lit(1)).alias("uses"))
        parts.append(
            seeded[table]
            .join(uses, identity, "left")
            .select(
                F.lit(table).alias("lookup"),
                F.col(identity).alias("id"),
                F.col(name).alias("name"),
                F.coalesce("uses", F.lit(0)).alias("uses"),
            )
        )
    return _united(parts)


def _split_by_variant(spark, t):
    return _united(
        [
            part.agg(
                F.lit(label).alias("arm"),
                F.count(F.lit(1)).alias("n_rows"),
                F.count_distinct("user_id").alias("n_users"),
            )
            for label, part in zip(S.VARIANTS, frames.split_by_variant(t["experiments"]))
        ]
    )


def _safe_merge(spark, t):
    users = t["users"].select("user_id", "customer_type")
    sessions_ = t["sessions"].select("session_id", "user_id")
    return _united(
        [
            frames.merge_counts(users, sessions_, "user_id", how).select(
                F.lit(how).alias("how"), "*"
            )
            for how in ("inner", "left", "right", "outer")
        ]
        + [
            frames.safe_merge(users, sessions_, "user_id").agg(
                F.lit("inner rows").alias("how"),
                F.count_distinct("user_id").alias("left_rows"),
                F.count_distinct("session_id").alias("right_rows"),
                F.count(F.lit(1)).alias("result_rows"),
            )
        ]
    )


def _filter_date_range(spark, t):
    return frames.filter_date_range(
        t["orders"], "order_timestamp", "2024-01-05", "2024-01-12 12:00:00"
    ).select("order_id", "order_timestamp", "order_value", "payment_status")


def _guards(spark, t):
    for name in S.CORE_TABLES:
        assert_columns_exist(t[name], quality.REQUIRED[name], name)
        assert_not_empty(t[name], name)
    return storage.row_counts(t)


def _null_profile(spark, t):
    return _united([frames.null_profile(t[name], name) for name in S.CORE_TABLES])


def _event_funnel_map(spark, t):
    return (
        t["raw_events"]
        .groupBy("event_type_id", "user_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(t["event_types"], "event_type_id")
        .groupBy("event_name", "event_category", "funnel_step")
        .agg(F.sum("n").alias("n_events"), F.count("user_id").alias("n_users"))
    )


# --- analytics ---------------------------------------------------------------------------


def _funnel_report(spark, t):
    """The nested report, laid out as one row per step and section."""
    report = funnel.funnel_report(reports.funnel_steps(t))
    columns = ["experiment_name", "section", "step_order", "step_name", "users_reached",
               "drop_off_count", "rate"]

    def section(name: str, rate: str, counted: bool = True) -> DataFrame:
        source = F.col(name) if name.endswith("steps") or name == "funnel_lift" else F.array(name)
        rows = report.select("experiment_name", F.inline(source))
        none = F.lit(None).cast("bigint")
        return rows.select(
            "experiment_name",
            F.lit(name).alias("section"),
            "step_order",
            "step_name",
            (F.col("users_reached") if counted else none).alias("users_reached"),
            (F.col("drop_off_count") if counted else none).alias("drop_off_count"),
            F.col(rate).alias("rate"),
        ).select(*columns)

    return _united(
        [
            section("control_steps", "cumulative_rate"),
            section("variant_steps", "cumulative_rate"),
            section("funnel_lift", "cumulative_rate_lift", counted=False),
            section("biggest_drop_off_control", "cumulative_rate"),
            section("biggest_drop_off_variant", "cumulative_rate"),
        ]
    )


def _conversion_by(dimension):
    return lambda spark, t: segments.conversion_by_dimension(
        views.segment_conversion(t), dimension
    )


def _lift_cols(spark, t):
    lift = segments.segment_lift(views.segment_conversion(t), "country_name").select(
        "experiment_name",
        "country_name",
        F.col("conversion_rate_control").alias("control_rate"),
        F.col("conversion_rate_variant").alias("variant_rate"),
    )
    return with_lift(lift, "control_rate", "variant_rate")


def _conversion_rate_col(spark, t):
    daily = views.daily_metrics_view(t).select(
        "metric_date", "experiment_name", "variant", "users_assigned", "purchasing_users"
    )
    return with_conversion_rate(daily, "purchasing_users", "users_assigned", "rate")


def _comparisons(t: Tables) -> DataFrame:
    return statistics.comparisons(
        views.experiment_summary(t), segments.all_lifts(views.segment_conversion(t))
    )


def _p_values(t: Tables) -> DataFrame:
    return statistics.p_value_family(
        views.experiment_summary(t), segments.all_lifts(views.segment_conversion(t))
    )


def _proportion_ci(spark, t):
    rates = segments.segment_grouping_sets(views.segment_conversion(t))
    return statistics.proportion_ci(rates, "purchasers", "total_users")


def _with_rates(df: DataFrame) -> DataFrame:
    df = with_conversion_rate(df, "control_conversions", "control_users", "control_rate")
    return with_conversion_rate(df, "variant_conversions", "variant_users", "variant_rate")


def _cohens_h(spark, t):
    return statistics.cohens_h(_with_rates(_comparisons(t)))


def _required_sample_size(spark, t):
    rated = _with_rates(_comparisons(t)).select(
        "experiment_name", "metric_name", "control_rate",
        F.abs(F.col("variant_rate") - F.col("control_rate")).alias("effect"),
    )
    return statistics.required_sample_size(rated, "control_rate", "effect")


def _mde_for_n(spark, t):
    rated = _with_rates(_comparisons(t)).select(
        "experiment_name", "metric_name", "control_rate", "control_users"
    )
    return statistics.mde_for_n(rated, "control_rate", "control_users")


def _rule(name):
    return lambda spark, t: decisions.apply_rule(reporting.decision_inputs_of(t), name)


def _recommendation(spark, t):
    """Recommendations with the rules and numbers behind them in columns of their own."""
    advice = reporting.recommendations(t)
    rules = F.array_join(F.transform("rule_results", lambda r: F.concat_ws("=", r["rule_name"], r["passed"])), ";")
    names = ("p_value", "relative_lift_pct", "achieved_power", "control_n", "required_n")
    return advice.select(
        "experiment_name", "recommendation", "decision", "confidence", "summary",
        rules.alias("rules"), *[F.col("key_metrics")[n].alias(n) for n in names],
    )


# --- states and estimates ----------------------------------------------------------------


def _distinct_users_sketch(spark, t):
    """Active users per period, arm and device: exact, and whether the estimate from stored states is near."""
    by = ["period", *views.ARM, "segment"]
    period = F.when(F.col("metric_date") < "2024-01-11", "first").otherwise("second")
    active = sketches.active_users(t)
    path = storage.scratch_path(spark, "distinct-states")
    day = ["metric_date", *views.ARM, "segment"]
    sketches.distinct_states(active, day).write.parquet(path)
    stored = spark.read.parquet(path).withColumn("period", period)
    rows = active.withColumn("period", period)
    wholes = [("period", "segment"), ("period",), ("segment",), ()]
    parts = []
    for kept in wholes:
        keys = [*views.ARM, *kept]
        exact = rows.select(*keys, "user_id").distinct().groupBy(*keys).agg(F.count("user_id").alias("exact"))
        near = sketches.compared(exact, sketches.united_distinct(stored, keys), keys, sketches.relative_error())
        missing = [F.lit("all").alias(c) for c in by if c not in keys]
        parts.append(near.select(*keys, *missing, F.col("exact").alias("active_users"), "within_bound"))
    return _united(parts)


def _with_ranks_checked(histogram: DataFrame, value: str, marks: dict[str, tuple[str, float]]) -> DataFrame:
    """Per arm and mark, whether the rank of an approximate percentile in the exact histogram is off by at
    most 2 % of the values and one value; ``histogram`` has the approximate percentiles beside it."""
    n, error = F.sum("w"), 0.02
    checks = []
    for mark, (name, p) in marks.items():
        below = F.sum(F.when(F.col(value) < F.col(name), F.col("w")).otherwise(0))
        upto = F.sum(F.when(F.col(value) <= F.col(name), F.col("w")).otherwise(0))
        near = (below <= n * (p + error) + 1) & (upto >= n * (p - error) - 1)
        checks.append(near.alias(f"{mark}_near"))
    return histogram.where(F.col(value).isNotNull()).groupBy(*views.ARM).agg(*checks)


def _approximate(view: DataFrame, histogram: DataFrame, value: str, marks: dict[str, tuple[str, float]]) -> DataFrame:
    """The exact columns of a view, and whether its approximate percentiles are near."""
    names = [name for name, _ in marks.values()]
    checked = _with_ranks_checked(histogram.join(view.select(*views.ARM, *names), list(views.ARM)), value, marks)
    return view.drop(*names).join(checked, list(views.ARM))


def _session_metrics_approx(spark, t):
    arms = views.arm_users(t).select(*views.ARM, "user_id", "n_rows")
    durations = t["sessions"].select("user_id", F.col("duration_seconds").cast("double").alias("seconds"))
    histogram = durations.join(arms, "user_id").groupBy(*views.ARM, "seconds").agg(F.sum("n_rows").alias("w"))
    marks = {
        "p25": ("p25_duration_seconds", 0.25),
        "p50": ("median_session_duration_seconds", 0.5),
        "p75": ("p75_duration_seconds", 0.75),
        "p95": ("p95_duration_seconds", 0.95),
    }
    return _approximate(views.session_metrics_view(t, approx=True), histogram, "seconds", marks)


def _revenue_per_visitor_approx(spark, t):
    histogram = reports.revenue_histogram(t).withColumn("revenue", F.col("revenue").cast("double"))
    marks = {
        "p25": ("p25_order_value", 0.25),
        "p50": ("median_order_value", 0.5),
        "p75": ("p75_order_value", 0.75),
        "p95": ("p95_order_value", 0.95),
    }
    return _approximate(reports.revenue_per_visitor(t, approx=True), histogram, "revenue", marks)


# --- streaming ---------------------------------------------------------------------------


# Later than all rows of a stream: when it has been read, everything before it is closed.
FAR_FUTURE = datetime(9999, 1, 1)


def _stream_sessionize(spark: SparkSession, path: str) -> DataFrame:
    events = replay.read_files_as_stream(spark, f"{path}/events.parquet").select(
        "event_id", "user_id", F.col("ts").alias("event_timestamp")
    )
    closing = {"event_id": -1, "user_id": -1, "event_timestamp": FAR_FUTURE}
    found = replay.run_available(
        events, stream_sessions.stream_sessionize, closing, "stream-sessions"
    )
    return found.withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")}
    )


def _stream_daily_srm(spark: SparkSession, path: str) -> DataFrame:
    customers = replay.read_files_as_stream(spark, f"{path}/customer.parquet")
    closing = {
        "experiment_id": -1, "experiment_name": "", "variant": S.CONTROL, "user_id": -1,
        "assignment_timestamp": FAR_FUTURE, "is_holdout": False,
    }
    days = replay.run_available(
        warehouse.experiments_of(customers),
        allocation.stream_daily_allocation,
        closing,
        "stream-allocation",
    )
    return allocation.monitored(days)


#: Arrivals into which the continuing streams' source is cut.
ARRIVALS = 3


def _arrivals(rows: DataFrame, ts: str, row_id: str, lag_hours: int = 13) -> DataFrame:
    """Rows with the number of the arrival that brings them: by time, some up to half a day late."""
    due = F.unix_micros(F.col(ts).cast("timestamp")) + F.col(row_id) % lag_hours * 3_600_000_000
    first, last = rows.agg(F.min(due), F.max(due)).first()
    share = (due - (first or 0)) * ARRIVALS
    return rows.withColumn("arrival", F.floor(share / ((last or 0) - (first or 0) + 1)).cast("int"))


def _after_each(spark: SparkSession, name: str, rows: DataFrame, take) -> DataFrame:
    """Write one arrival after the other to a folder, ``take`` it and keep what can be read then."""
    root = storage.scratch_path(spark, name)
    for k in range(ARRIVALS):
        rows.where(F.col("arrival") == k).drop("arrival").write.mode("append").parquet(f"{root}/in")
        found = take(f"{root}/in", f"{root}/stream", k).withColumn("arrival", F.lit(k))
        found.write.parquet(f"{root}/readings/{k}")
    return _united([spark.read.parquet(f"{root}/readings/{k}") for k in range(ARRIVALS)])


def _events_in_arrivals(spark: SparkSession, path: str) -> DataFrame:
    events = warehouse.source(spark, path, "events")
    return _arrivals(events.select("event_id", "user_id", F.col("ts").alias("event_timestamp")),
                     "event_timestamp", "event_id")


def _stream_continuing_sessions(spark: SparkSession, path: str) -> DataFrame:
    """Sessions as they can be read after each of three arrivals, open ones included."""

    def take(source: str, root: str, k: int) -> DataFrame:
        # A new object each time, as after a restart.
        stream = continuing.Continuing(spark, root, source, continuing.SESSIONS)
        stream.advance()
        return stream.now()

    found = _after_each(spark, "continuing-sessions", _events_in_arrivals(spark, path), take)
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})


def _stream_continuing_srm(spark: SparkSession, path: str) -> DataFrame:
    """The allocation check after each of three arrivals of assignments, days that go on included."""

    def take(source: str, root: str, k: int) -> DataFrame:
        stream = continuing.Continuing(spark, root, source, continuing.ALLOCATION)
        stream.advance()
        return allocation.monitored(stream.now())

    assigned = warehouse.experiments_of(warehouse.source(spark, path, "customer"))
    arriving = _arrivals(assigned, "assignment_timestamp", "experiment_id")
    return _after_each(spark, "continuing-allocation", arriving, take)


def _stream_late_rows(spark: SparkSession, path: str) -> DataFrame:
    """Events that come after the watermark has passed them: every fiftieth comes with the last arrival."""
    stray = F.col("event_id") % 50 == 0
    arriving = _events_in_arrivals(spark, path).withColumn(
        "arrival", F.when(stray, ARRIVALS - 1).otherwise(F.col("arrival"))
    )
    root = storage.scratch_path(spark, "late")
    stream = continuing.Continuing(spark, f"{root}/stream", f"{root}/in", continuing.SESSIONS)
    for k in range(ARRIVALS):
        arriving.where(F.col("arrival") == k).drop("arrival").write.mode("append").parquet(f"{root}/in")
        stream.advance()
    return stream.late_rows().select(
        "event_id", "user_id", F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp")
    )


def _stream_daily_active(spark: SparkSession, path: str) -> DataFrame:
    """Daily active users per arm after each arrival; a third of the users is assigned from the second on."""
    assigned = warehouse.experiments_of(warehouse.source(spark, path, "customer"))
    tables = storage.scratch_path(spark, "assignments")
    later = F.col("user_id") % 3 == 0

    def take(source: str, root: str, k: int) -> DataFrame:
        if k < 2:
            storage.bulk_load({"experiments": assigned.where(later if k else ~later)}, tables)
        stream = activity.Activity(spark, root, source, tables)
        stream.advance()
        return stream.daily_active()

    return _after_each(spark, "daily-active", _events_in_arrivals(spark, path), take)


# name -> function of (spark, canonical tables)
_OVER_TABLES: dict[str, Callable[[SparkSession, Tables], DataFrame]] = {
    "scan_tables": _scan_tables,
    "sink_raw": _sink_raw,
    "bulk_load": _bulk_load,
    "row_count_reconcile": _row_count_reconcile,
    "refresh_materialized": _refresh_materialized,
    "refresh_users_from_changes": lambda s, t: _loaded_twice(s, t, "mv_user_experiment_summary"),
    "refresh_daily_from_changes": lambda s, t: _loaded_twice(s, t, "mv_daily_conversion"),
    "experiment_report": _experiment_report,
    "block_sample": _block_sample,
    "export_datasets": _export_datasets,
    "dim_lookup_seed": _dim_lookup_seed,
    "typed_view_read": lambda s, t: reporting.DATASETS["experiment_summary"](t),
    "user_level_sample": lambda s, t: reporting.user_level_data(t, 0.25),
    "dataset_bundle": _dataset_bundle,
    "export_stat_results": lambda s, t: reporting.statistical_export(
        reporting.inference_results(views.experiment_summary(t)), STAMP
    ),
    "export_recommendation": lambda s, t: reporting.recommendation_export(
        reporting.recommendations(t), STAMP
    ),
    "filter_date_range": _filter_date_range,
    "split_by_variant": _split_by_variant,
    "safe_merge": _safe_merge,
    "assert_guards": _guards,
    "null_profile": _null_profile,
    **{name: (lambda s, t, f=f: f(t)) for name, f in views.VIEWS.items()},
    **{name: (lambda s, t, f=f: f(t)) for name, f in views.MATERIALIZED_VIEWS.items()},
    **{
        f.__name__: (lambda s, t, f=f: f(t))
        for f in (
            reports.conversion_metrics,
            reports.daily_metrics,
            reports.session_metrics,
            reports.funnel_steps,
            reports.funnel_completion,
            reports.revenue_per_visitor,
            reports.order_analysis,
            reports.device_segment,
            reports.country_segment,
            reports.channel_segment,
            reports.daily_srm_check,
            reports.data_quality_monitor,
            reports.srm_check,
            reports.completeness_check,
        )
    },
    "experiment_summary_after": lambda s, t: views.experiment_summary(t, after_assignment=True),
    "daily_metrics_after": lambda s, t: views.daily_metrics_view(t, after_assignment=True),
    "revenue_summary_after": lambda s, t: views.revenue_summary(t, after_assignment=True),
    "dense_daily_srm": lambda s, t: reports.dense_daily_srm(t, ("country_name",), minimum_users=20),
    "distinct_users_sketch": _distinct_users_sketch,
    "session_metrics_approx": _session_metrics_approx,
    "revenue_per_visitor_approx": _revenue_per_visitor_approx,
    "primary_metric": lambda s, t: metrics.primary_metric(views.experiment_summary(t)),
    "secondary_metrics": lambda s, t: metrics.secondary_metrics(
        views.revenue_summary(t), views.session_averages(t)
    ),
    "guardrail_metrics": lambda s, t: metrics.guardrail_metrics(
        views.session_averages(t), views.funnel_steps_view(t)
    ),
    "all_metrics": lambda s, t: metrics.all_metrics(
        views.experiment_summary(t), views.revenue_summary(t), views.session_averages(t)
    ),
    "funnel_analyzer_steps": lambda s, t: funnel.analyzer_steps(reports.funnel_steps(t)),
    "funnel_lift": lambda s, t: funnel.funnel_lift(reports.funnel_steps(t)),
    "biggest_drop_off": lambda s, t: funnel.biggest_drop_off(reports.funnel_steps(t)),
    "funnel_report": _funnel_report,
    "conversion_by_dimension": lambda s, t: segments.segment_grouping_sets(
        views.segment_conversion(t), ("device_type", "channel_name", "customer_type")
    ),
    "conversion_by_device": _conversion_by("device_type"),
    "conversion_by_channel": _conversion_by("channel_name"),
    "conversion_by_customer_type": _conversion_by("customer_type"),
    "conversion_by_country_topn": lambda s, t: segments.conversion_by_country(
        views.segment_conversion(t)
    ),
    "segment_lift": lambda s, t: segments.segment_lift(
        views.segment_conversion(t), "channel_name"
    ),
    "top_segments": lambda s, t: segments.top_segments(
        views.segment_conversion(t), "country_name"
    ),
    "segment_report": lambda s, t: segments.segment_report(views.segment_conversion(t)),
    "segment_grouping_sets": lambda s, t: segments.segment_grouping_sets(
        views.segment_conversion(t)
    ),
    "conversion_rate_col": _conversion_rate_col,
    "lift_cols": _lift_cols,
    "event_funnel_map": _event_funnel_map,
    "assign_variants": lambda s, t: sessions.assign_variants(
        t["users"], (("checkout_redesign", 500), ("pricing_test", 420))
    ),
    "sessionize": lambda s, t: sessions.sessionize(t["raw_events"]),
    "derive_orders": lambda s, t: sessions.derive_orders(t["events"]),
    "dq_users": lambda s, t: quality.dq_users(t["users"], "2023-07-05", "2023-12-31"),
    "dq_experiments": lambda s, t: quality.dq_experiments(
        t["experiments"], "2024-01-01", "2024-01-10"
    ),
    "dq_sessions": lambda s, t: quality.dq_sessions(t["sessions"]),
    "dq_events": lambda s, t: quality.dq_events(t["events"], t["sessions"], t["event_types"]),
    "dq_orders": lambda s, t: quality.dq_orders(t["orders"], t["users"], t["sessions"]),
    "dq_cross_table": lambda s, t: quality.dq_cross_table(t),
    "dq_overall": lambda s, t: quality.dq_overall(quality.dq_all(t)),
    "schema_check": lambda s, t: constraints.schema_check(t, issues_only=False),
    "constraint_check": lambda s, t: constraints.constraint_check(t),
    "unique_check": lambda s, t: constraints.unique_check(t),
    "fk_check": lambda s, t: constraints.fk_check(t),
    "two_proportion_z_test": lambda s, t: statistics.two_proportion_z_test(_comparisons(t)),
    "proportion_ci": _proportion_ci,
    "difference_ci": lambda s, t: statistics.difference_ci(_comparisons(t)),
    "revenue_ci": lambda s, t: statistics.mean_ci(reports.revenue_histogram(t), views.ARM),
    "cohens_h": _cohens_h,
    "achieved_power": lambda s, t: statistics.achieved_power(_comparisons(t)),
    "required_sample_size": _required_sample_size,
    "mde_for_n": _mde_for_n,
    "srm_test": lambda s, t: statistics.srm_from_assignments(t["experiments"]),
    "bonferroni": lambda s, t: statistics.bonferroni(_p_values(t)),
    "benjamini_hochberg": lambda s, t: statistics.benjamini_hochberg(_p_values(t)),
    "correct_p_values": lambda s, t: statistics.correct_p_values(
        _p_values(t), "benjamini_hochberg"
    ),
    "iqr_outliers": lambda s, t: outliers.iqr_outliers(reports.user_revenue(t)),
    "outlier_impact": lambda s, t: outliers.outlier_impact(reports.revenue_histogram(t)),
    "winsorized_mean": lambda s, t: outliers.winsorized_mean(reports.revenue_histogram(t)),
    "stat_report": lambda s, t: reporting.stat_report(t),
    **{name: _rule(name) for name in decisions.RULES},
    "evaluate_rules": lambda s, t: decisions.evaluate_rules(reporting.decision_inputs_of(t)),
    "recommendation": _recommendation,
    "recommendation_confidence": lambda s, t: decisions.recommendation_confidence(
        decisions.evaluate_rules(reporting.decision_inputs_of(t))
    ),
}

_OVER_FILES: dict[str, Query] = {
    "stream_sessionize": _stream_sessionize,
    "stream_daily_srm": _stream_daily_srm,
    "stream_continuing_sessions": _stream_continuing_sessions,
    "stream_continuing_srm": _stream_continuing_srm,
    "stream_late_rows": _stream_late_rows,
    "stream_daily_active": _stream_daily_active,
}


def _over_tables(build) -> Query:
    return lambda spark, path: published(build(spark, warehouse.load(spark, path)))


def _over_files(build: Query) -> Query:
    return lambda spark, path: published(build(spark, path))


QUERIES: dict[str, Query] = {
    **{name: _over_tables(build) for name, build in _OVER_TABLES.items()},
    **{name: _over_files(build) for name, build in _OVER_FILES.items()},
}
