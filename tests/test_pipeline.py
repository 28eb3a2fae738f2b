from __future__ import annotations

import tempfile

import pytest

from tests.tiny import at, order, session, tables
from trialscope.operators import reporting
from trialscope.plans import pipeline


@pytest.fixture()
def root():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def test_gate_names_the_failures(spark, root):
    t = tables(spark, orders=[order("o1", "ghost", "s1", at(1), "5.00")])
    with pytest.raises(pipeline.GateFailed, match="orders.no_orphan_orders_user: 1"):
        pipeline.run(spark, t, root)


def test_run_exports_everything(spark, root):
    t = tables(spark)
    written = pipeline.run(spark, t, root, check=False, generated_at="2024-02-01 00:00:00")
    assert set(written) == {*reporting.DATASETS, "statistical_results", "recommendation"}
    stats = spark.read.option("header", True).csv(f"{root}/exports/statistical_results")
    assert stats.columns == [
        "experiment_name", "generated_at", "p_value", "z_score", "is_significant",
        "absolute_lift", "relative_lift_pct", "ci_lower", "ci_upper", "achieved_power",
        "cohens_h", "srm_detected", "srm_p_value",
    ]
    advice = spark.read.option("header", True).csv(f"{root}/exports/recommendation")
    assert {r.experiment_name: r.recommendation for r in advice.collect()}["A"] in (
        "CONTINUE_EXPERIMENT", "STOP_FOR_FUTILITY",
    )
    assert {r.generated_at for r in advice.collect()} == {"2024-02-01T00:00:00"}


def test_command_line(spark, root, capsys):
    from trialscope.__main__ import main
    from trialscope.sources import storage

    storage.sink_raw(tables(spark), f"{root}/raw")
    assert main(["--csv", f"{root}/raw", "--dry-run"]) == 1
    assert "sessions.positive_duration: 1" in capsys.readouterr().err
    assert main(["--csv", f"{root}/raw", "--out", f"{root}/out", "--no-gate"]) == 0
    assert "user_level_data: 5 rows" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["--csv", f"{root}/raw"])


def test_clean_tables_pass_the_gate(spark):
    # Bounces of no duration are a violation, so the clean input has none.
    t = tables(spark)
    longer = [session(r[0], r[1], r[2], r[3], r[7]) for r in
              [tuple(x) for x in t["sessions"].where("duration_seconds > 0").collect()]]
    kept = {r[0] for r in longer}
    experiments = t["experiments"].where("experiment_name = 'A'")
    clean = t.replacing(
        sessions=tables(spark, sessions=longer)["sessions"],
        experiments=experiments,
        events=t["events"].where(t["events"].session_id.isin(*kept)),
        orders=t["orders"].where(t["orders"].session_id.isin(*kept)),
    )
    pipeline.gate(clean)
