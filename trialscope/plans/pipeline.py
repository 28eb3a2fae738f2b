"""The whole run: stage, gate, publish, refresh, datasets, report, recommendation, export."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialscope.operators import constraints, decisions, quality, reporting
from trialscope.plans.refresh import read_materialized, refresh_materialized
from trialscope.sources import storage
from trialscope.sources.tables import Tables


class GateFailed(RuntimeError):
    """The input does not pass the data-quality gate; nothing was loaded."""


def gate(
    t: Mapping[str, DataFrame],
    start: str | None = None,
    end: str | None = None,
    failures: str | None = None,
) -> None:
    """Raise ``GateFailed`` when a check or the load contract fails.

    The error names every failed check with its violations; their number is that of the checks.
    All failed rows, which can be one per experiment, go to the path ``failures`` if one is given.
    """
    failed = quality.dq_all(t, start, end).where(F.col("status") == "FAIL")
    by_check = (
        failed.groupBy("table_name", "check_name")
        .agg(F.sum("violations").alias("violations"))
        .orderBy("table_name", "check_name")
        .collect()
    )
    if by_check:
        message = "; ".join(f"{r.table_name}.{r.check_name}: {r.violations}" for r in by_check)
        if failures is not None:
            failed.write.parquet(failures)
            message += f" (all rows in {failures})"
        raise GateFailed(message)
    try:
        constraints.assert_schema(t)
    except constraints.SchemaViolation as violation:
        raise GateFailed(str(violation)) from violation


def export_all(
    datasets: Mapping[str, DataFrame],
    report: DataFrame,
    recommendation: DataFrame,
    root: str,
    generated_at: str | None = None,
) -> dict[str, int]:
    """Write the datasets, the statistics and the recommendation; returns rows per file set."""
    return storage.export_datasets(
        {
            **datasets,
            "statistical_results": reporting.statistical_export(report, generated_at),
            "recommendation": reporting.recommendation_export(recommendation, generated_at),
        },
        root,
    )


def run(
    spark: SparkSession,
    t: Tables,
    root: str,
    check: bool = True,
    limits: decisions.Thresholds = decisions.DEFAULTS,
    generated_at: str | None = None,
) -> dict[str, int]:
    """Stage, gate, publish, refresh and export under ``root``; returns the rows per export.

    The input is computed once, for the staged files; the gate and all that follows read those.
    They are published when they have passed, and the two materialized datasets are exported from
    their published versions.
    """
    staged = storage.stage(t, f"{root}/tables", truncate_first=True)
    loaded = t.replacing(**storage.read_staged(spark, staged))
    if check:
        gate(loaded, failures=f"{root}/failures/{uuid.uuid4().hex}")
    storage.publish(spark, f"{root}/tables", staged)
    refresh_materialized(spark, loaded, f"{root}/views")
    datasets = reporting.dataset_bundle(loaded)
    for name, view in (
        ("daily_metrics", "mv_daily_conversion"),
        ("user_level_data", "mv_user_experiment_summary"),
    ):
        datasets[name] = reporting.typed_read(
            read_materialized(spark, f"{root}/views", view), reporting.DATASET_TYPES[name]
        )
    return export_all(
        datasets,
        reporting.stat_report(loaded, alpha=limits.alpha, power=limits.power),
        reporting.recommendations(loaded, limits),
        f"{root}/exports",
        generated_at,
    )
