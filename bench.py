"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the local cores.  Every query is built and
run to completion three times, its rows written to the ``noop`` sink, and the least time counts; one small query runs first
so that the session's start is not charged to a query.  ``end_to_end`` has the seconds of a whole run
(staging, gate, refresh, report), which are not part of ``value``, and the rows staged per second.
"""

from __future__ import annotations

import contextlib
import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from trialscope.operators import reporting  # noqa: E402
from trialscope.plans import pipeline, refresh  # noqa: E402
from trialscope.plans.registry import QUERIES  # noqa: E402
from trialscope.sources import storage, warehouse  # noqa: E402

HEADLINE = (
    "experiment_summary",
    "daily_metrics",
    "funnel_steps",
    "session_metrics",
    "segment_report",
    "revenue_per_visitor",
    "order_analysis",
    "mv_user_experiment_summary",
    "sessionize",
    "derive_orders",
    "dq_sessions",
    "dq_events",
    "dq_orders",
    "fk_check",
    "benjamini_hochberg",
    "outlier_impact",
    "winsorized_mean",
    "recommendation",
)

RUNS = 3


def end_to_end(spark: SparkSession, path: str) -> dict[str, float]:
    t = warehouse.load(spark, path)
    root = storage.scratch_path(spark, "bench")
    seconds, marks = {}, [time.perf_counter()]

    def mark(name: str) -> None:
        marks.append(time.perf_counter())
        seconds[name] = round(marks[-1] - marks[-2], 3)

    staged = storage.stage(t, f"{root}/tables")
    mark("stage")
    loaded = t.replacing(**storage.read_staged(spark, staged))
    # The gate's findings on these tables are not the subject here.
    with contextlib.suppress(pipeline.GateFailed):
        pipeline.gate(loaded)
    mark("gate")
    refresh.refresh_materialized(spark, loaded, f"{root}/views")
    mark("refresh")
    reporting.stat_report(loaded).write.format("noop").mode("overwrite").save()
    mark("report")
    rows = sum(entry.rows for entry in staged.values())
    return {**seconds, "rows_staged_per_second": round(rows / seconds["stage"])}


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("trialscope-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        # Without it every Column call also records where it was made, at several times the cost.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["srm_test"](spark, path).collect()
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, path).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    whole = end_to_end(spark, path)
    print(
        json.dumps(
            {
                "metric": "total time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "end_to_end": whole,
                "sf": os.path.basename(path.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
