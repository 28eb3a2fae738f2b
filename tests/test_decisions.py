from __future__ import annotations

import pytest

from tests.tiny import one
from trialscope.operators import decisions
from trialscope.operators.funnel import biggest_drop_off, funnel_lift
from trialscope.functions.ratios import with_conversion_rate, with_lift

DDL = (
    "experiment_name string, p_value double, achieved_power double, relative_lift double, "
    "control_bounce_rate double, variant_bounce_rate double, srm_detected boolean, "
    "current_n long, required_n long"
)
GOOD = dict(p=0.01, power=0.9, lift=0.2, bc=0.4, bv=0.4, srm=False, n=1000, need=900)
CASES = {
    "launch": ({}, "LAUNCH", "HIGH"),
    "srm": (dict(srm=True), "INVESTIGATE_DATA_QUALITY", "MEDIUM"),
    "more data": (dict(p=0.3, n=100), "CONTINUE_EXPERIMENT", "MEDIUM"),
    "futile": (dict(p=0.3), "STOP_FOR_FUTILITY", "MEDIUM"),
    "weak": (dict(power=0.5), "CONTINUE_EXPERIMENT", "MEDIUM"),
    "small lift": (dict(lift=0.01), "CONTINUE_EXPERIMENT", "MEDIUM"),
    "bounces": (dict(bv=0.5), "INVESTIGATE_DATA_QUALITY", "MEDIUM"),
    "no bounces": (dict(bc=0.0, bv=0.5), "LAUNCH", "HIGH"),
    "nothing needed": (dict(need=0), "LAUNCH", "HIGH"),
    "poor": (dict(p=0.5, power=0.1, lift=-0.1, n=1), "CONTINUE_EXPERIMENT", "LOW"),
    "invalid": (dict(p=None, power=0.0, lift=None, n=0, need=0), "STOP_FOR_FUTILITY", "LOW"),
}


@pytest.fixture(scope="module")
def inputs(spark):
    rows = []
    for name, (changes, *_) in CASES.items():
        v = {**GOOD, **changes}
        rows.append((name, v["p"], v["power"], v["lift"], v["bc"], v["bv"], v["srm"], v["n"], v["need"]))
    return spark.createDataFrame(rows, DDL)


def test_recommendation_and_confidence(inputs):
    found = {r.experiment_name: r for r in decisions.recommendation(inputs).collect()}
    for name, (_, expected, confidence) in CASES.items():
        assert (found[name].recommendation, found[name].confidence) == (expected, confidence), name
    assert found["futile"].decision == "Stop For Futility"
    assert found["launch"].summary == (
        "Conversion rose by 20.00% (p = 0.0100, power 90.00%) and the guardrails hold: "
        "launch the variant to all users."
    )
    assert found["launch"].key_metrics["required_n"] == 900.0
    assert [r.rule_name for r in found["launch"].rule_results][0] == "srm_rule"


def test_rules_in_order_and_with_other_thresholds(inputs):
    rules = decisions.evaluate_rules(inputs.where("experiment_name = 'launch'"))
    rows = sorted(rules.collect(), key=lambda r: r.rule_order)
    assert [r.rule_name for r in rows] == [
        "srm_rule", "significance_rule", "power_rule", "practical_uplift_rule",
        "guardrail_bounce_rate_rule", "sample_size_rule",
    ]
    assert all(r.passed for r in rows)
    strict = decisions.Thresholds().with_alpha(0.001).with_uplift(0.5)
    failed = {r.rule_name for r in decisions.evaluate_rules(inputs, strict)
              .where("experiment_name = 'launch' and not passed").collect()}
    assert failed == {"significance_rule", "practical_uplift_rule"}
    confidence = decisions.recommendation_confidence(decisions.evaluate_rules(inputs))
    assert one(confidence, experiment_name="poor")["confidence"] == "LOW"


FUNNEL = (
    "experiment_name string, variant string, step_name string, step_order int, users_reached long, "
    "step_conversion_rate double, cumulative_conversion_rate double"
)


def test_funnel_ties_and_missing_steps(spark):
    rows = [
        ("A", "control", "one", 1, 100, 1.0, 1.0),
        ("A", "control", "two", 2, 80, 0.8, 0.8),
        ("A", "control", "three", 3, 60, 0.75, 0.0),
        ("A", "variant", "one", 1, 50, 1.0, 1.0),
        ("B", "control", "one", 1, 5, 1.0, 1.0),
    ]
    funnel = spark.createDataFrame(rows, FUNNEL)
    worst = biggest_drop_off(funnel).collect()
    # The first of equal drop-offs wins; a single step has no drop-off.
    assert [(r.experiment_name, r.variant, r.step_name) for r in worst] == [("A", "control", "one")]
    lift = funnel_lift(funnel)
    assert one(lift, experiment_name="A", step_name="two")["variant_step_rate"] is None
    assert lift.count() == 4
    with pytest.raises(ValueError, match="missing columns"):
        funnel_lift(funnel.drop("step_order"))


def test_rate_and_lift_columns(spark):
    df = spark.createDataFrame([(1, 4), (0, 0)], "x long, n long")
    assert [r.rate for r in with_conversion_rate(df, "x", "n", "rate").collect()] == [0.25, 0.0]
    rates = spark.createDataFrame([(0.1, 0.15), (0.0, 0.2)], "c double, v double")
    defined, undefined = with_lift(rates, "c", "v").collect()
    assert defined.relative_lift_pct == pytest.approx(50.0) and defined.is_defined
    assert undefined.absolute_lift is None and not undefined.is_defined
