"""Datasets and the statistical report of every experiment."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialscope.functions.guards import assert_columns_exist
from trialscope.functions.hashing import draw
from trialscope.functions.ratios import ratio
from trialscope.operators import decisions, metrics, outliers, segments, statistics
from trialscope.operators import funnel as funnels
from trialscope.operators.reports import funnel_steps, revenue_histogram
from trialscope.operators.views import (
    TableMap,
    experiment_summary,
    funnel_steps_view,
    mv_daily_conversion,
    mv_user_experiment_summary,
    revenue_summary,
    segment_conversion,
    session_averages,
    session_metrics_view,
)

# Types of the published datasets, per dataset; columns that a dataset lacks are ignored.
_COUNTS = {"total_users": "bigint", "purchasers": "bigint"}
_MONEY = {"revenue_per_visitor": "double", "average_order_value": "double"}
DATASET_TYPES: dict[str, dict[str, str]] = {
    "experiment_summary": {
        **_COUNTS, **_MONEY, "total_orders": "bigint", "total_revenue": "double",
        "conversion_rate": "double",
    },
    "daily_metrics": {
        "users_assigned": "bigint", "purchasing_users": "bigint", "daily_revenue": "double",
        "daily_conversion_rate": "double",
    },
    "funnel_data": {"total_users": "bigint"},
    "session_metrics": {"bounce_rate": "double"},
    "segment_data": {**_COUNTS, "conversion_rate": "double"},
    "revenue_summary": {
        **_MONEY, "total_users": "bigint", "gross_revenue": "double", "net_revenue": "double",
    },
    "user_level_data": {
        "total_revenue": "double", "session_count": "bigint", "bounce_rate": "double",
    },
}


def typed_read(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns that exist; a column with a value that can not be cast stays as it is.

    Only text columns can fail; if there are any among them, one aggregate looks at them.
    """
    named = [c for c in df.columns if c in types]
    texts = [c for c in named if df.schema[c].dataType == T.StringType()]
    kept: set[str] = set()
    if texts:
        fails = [
            F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(types[c]).isNull()).alias(c)
            for c in texts
        ]
        failed = df.agg(*fails).first()
        kept = {c for c in texts if failed[c]}
    cast = set(named) - kept
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in cast else F.col(c) for c in df.columns])


def user_level_data(t: TableMap, fraction: float = 1.0, seed: int = 42) -> DataFrame:
    """The per-user summary, optionally of about that fraction of the users.

    A user is chosen by hash of its id, so the sample is the same on every run and layout.
    """
    if not 0 < fraction <= 1:
        raise ValueError(f"fraction must be in (0, 1], got {fraction!r}")
    rows = typed_read(mv_user_experiment_summary(t), DATASET_TYPES["user_level_data"])
    chosen = draw(F.col("user_id"), f"sample {seed}", 1_000_000) < round(fraction * 1_000_000)
    return rows if fraction == 1 else rows.where(chosen)


def _dataset(name: str, build) -> Callable[[TableMap], DataFrame]:
    return lambda t: typed_read(build(t), DATASET_TYPES[name])


DATASETS = {
    "experiment_summary": _dataset("experiment_summary", experiment_summary),
    "daily_metrics": _dataset("daily_metrics", mv_daily_conversion),
    "funnel_data": _dataset("funnel_data", funnel_steps_view),
    "session_metrics": _dataset("session_metrics", session_metrics_view),
    "segment_data": _dataset("segment_data", segment_conversion),
    "revenue_summary": _dataset("revenue_summary", revenue_summary),
    "user_level_data": user_level_data,
}


def dataset_bundle(t: TableMap) -> dict[str, DataFrame]:
    """The seven named datasets, lazily."""
    return {name: build(t) for name, build in DATASETS.items()}


def inference_results(
    summary: DataFrame, alpha: float = 0.05, power: float = 0.80, srm_alpha: float = 0.01
) -> DataFrame:
    """Test, interval, power, effect size and allocation check per experiment."""
    tested = statistics.two_proportion_z_test(statistics.arms(summary), alpha)
    tested = statistics.difference_ci(tested, 1 - alpha)
    tested = statistics.achieved_power(tested, alpha, power)
    tested = statistics.cohens_h(tested)
    return statistics.srm_test(tested, alpha=srm_alpha)


def stat_report(
    t: TableMap,
    alpha: float = 0.05,
    power: float = 0.80,
    srm_alpha: float = 0.01,
    method: str = "benjamini_hochberg",
) -> DataFrame:
    """The statistics the decision rests on, one row per experiment.

    Besides the tests of ``inference_results``: the p-value corrected for all segment tests of the
    experiment, the outlier effect on revenue per arm, and the worst funnel step per arm.
    ``experiment_report`` adds the metrics, funnel, segments and days behind them.
    """
    summary = experiment_summary(t)
    lifts = segments.all_lifts(segment_conversion(t))
    corrected = (
        statistics.correct_p_values(statistics.p_value_family(summary, lifts), method, alpha)
        .where(F.col("metric_name") == "conversion")
        .select("experiment_name", "corrected_p_value")
    )
    impact = metrics.side_by_side(
        outliers.outlier_impact(revenue_histogram(t)),
        outliers="outlier_count",
        outliers_material="outliers_material",
    )
    worst = metrics.side_by_side(
        funnels.biggest_drop_off(funnel_steps(t)), worst_step="step_name"
    )
    return (
        inference_results(summary, alpha, power, srm_alpha)
        .join(corrected, "experiment_name", "left")
        .join(impact, "experiment_name", "left")
        .join(worst, "experiment_name", "left")
    )


# What the sections of a report hold of the frames they are made from.
FUNNEL_FIELDS = ("variant", "step_order", "step_name", "users_reached", "drop_off_count", "cumulative_rate")
SEGMENT_FIELDS = (
    "dimension", "segment", "total_users_control", "total_users_variant", "purchasers_control",
    "purchasers_variant", "absolute_lift", "relative_lift",
)
DAILY_FIELDS = (
    "metric_date", "variant", "users_assigned", "purchasing_users", "order_count", "daily_revenue",
    "cumulative_users", "cumulative_purchasers", "cumulative_conversion_rate",
)


def _section(df: DataFrame, name: str, fields: Sequence[str]) -> DataFrame:
    """The rows of each experiment as one sorted array; their number is that of days, steps or segments."""
    return df.groupBy("experiment_name").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias(name))


def experiment_report(t: TableMap, alpha: float = 0.05, power: float = 0.80, srm_alpha: float = 0.01) -> DataFrame:
    """The whole report, one row per experiment: ``stat_report`` and the sections metrics (a struct),
    funnel, segments and daily (arrays of structs)."""
    summary, averages = experiment_summary(t), session_averages(t)
    records = metrics.all_metrics(summary, revenue_summary(t), averages)
    named = [c for c in records.columns if c != "experiment_name"]
    parts = (
        records.select("experiment_name", F.struct(*named).alias("metrics")),
        _section(funnels.analyzer_steps(funnel_steps(t)), "funnel", FUNNEL_FIELDS),
        _section(segments.segment_report(segment_conversion(t)), "segments", SEGMENT_FIELDS),
        _section(mv_daily_conversion(t), "daily", DAILY_FIELDS),
    )
    report = stat_report(t, alpha, power, srm_alpha)
    for part in parts:
        report = report.join(part, "experiment_name", "left")
    return report


def block_sample(df: DataFrame, block: str, fraction: float, seed: int = 42) -> DataFrame:
    """Rows of about that fraction of the blocks of a table that is partitioned by ``block``.

    A block is chosen by hash of its name, so the filter is one on partitions: files of other blocks
    are neither opened nor listed by tasks.  Counts and sums of the sample, divided by ``fraction``, estimate
    those of the table without bias over seeds, with the spread of whole blocks.  Rows without a block are
    never chosen.
    """
    if not 0 < fraction <= 1:
        raise ValueError(f"fraction must be in (0, 1], got {fraction!r}")
    chosen = draw(F.col(block), f"block {seed}", 1_000_000) < round(fraction * 1_000_000)
    return df.where(chosen)


def decision_inputs(tests: DataFrame, sessions: DataFrame) -> DataFrame:
    """Inputs of the launch rules from ``inference_results`` rows and session metrics.

    The sample size compared is the control arm's, against the needed users per arm.
    """
    assert_columns_exist(tests, ["p_value", "achieved_power", "srm_detected"], "decision_inputs")
    bounce = metrics.side_by_side(sessions, bounce_rate="bounce_rate")
    base = F.col("control_rate")
    lift = F.when(base == 0, F.lit(0.0)).otherwise(ratio(F.col("absolute_lift"), base))
    return tests.join(bounce, "experiment_name", "left").select(
        "experiment_name",
        "p_value",
        "achieved_power",
        lift.alias("relative_lift"),
        F.coalesce("control_bounce_rate", F.lit(0.0)).alias("control_bounce_rate"),
        F.coalesce("variant_bounce_rate", F.lit(0.0)).alias("variant_bounce_rate"),
        "srm_detected",
        F.col("control_users").alias("current_n"),
        F.col("required_sample_size_per_group").alias("required_n"),
    )


def decision_inputs_of(t: TableMap) -> DataFrame:
    return decision_inputs(inference_results(experiment_summary(t)), session_averages(t))


def recommendations(
    t: TableMap, limits: decisions.Thresholds = decisions.DEFAULTS
) -> DataFrame:
    return decisions.recommendation(decision_inputs_of(t), limits)


def _stamped(generated_at: str | None) -> Column:
    stamp = F.current_timestamp() if generated_at is None else F.lit(generated_at)
    return F.date_format(stamp.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss").alias("generated_at")


def statistical_export(report: DataFrame, generated_at: str | None = None) -> DataFrame:
    """The flat statistics file: 13 columns per experiment."""
    return report.select(
        "experiment_name",
        _stamped(generated_at),
        "p_value",
        "z_score",
        "is_significant",
        "absolute_lift",
        "relative_lift_pct",
        "ci_lower",
        "ci_upper",
        "achieved_power",
        "cohens_h",
        "srm_detected",
        F.col("srm_p_value"),
    )


def recommendation_export(rows: DataFrame, generated_at: str | None = None) -> DataFrame:
    """The flat recommendation file: 6 columns per experiment."""
    return rows.select(
        "experiment_name",
        _stamped(generated_at),
        "recommendation",
        "decision",
        "confidence",
        "summary",
    )
