"""Launch rules and recommendations, one row per experiment.

Input frame (see ``reporting.decision_inputs``): experiment_name, p_value, achieved_power,
relative_lift (a fraction), control_bounce_rate, variant_bounce_rate, srm_detected, current_n,
required_n.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialscope.functions.guards import assert_columns_exist
from trialscope.functions.ratios import null_if_zero

INPUTS = (
    "experiment_name",
    "p_value",
    "achieved_power",
    "relative_lift",
    "control_bounce_rate",
    "variant_bounce_rate",
    "srm_detected",
    "current_n",
    "required_n",
)


@dataclass(frozen=True)
class Thresholds:
    """Default thresholds of the six rules."""

    alpha: float = 0.05
    power: float = 0.80
    uplift: float = 0.05
    bounce_tolerance: float = 0.02
    srm: float = 0.0
    sample_ratio: float = 1.0

    def with_alpha(self, alpha: float) -> "Thresholds":
        return replace(self, alpha=alpha)

    def with_uplift(self, uplift: float) -> "Thresholds":
        return replace(self, uplift=uplift)


DEFAULTS = Thresholds()


def _result(name: str, passed: Column, actual: Column, threshold: float, message: Column) -> Column:
    return F.struct(
        F.lit(name).alias("rule_name"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        actual.cast("double").alias("actual_value"),
        F.lit(float(threshold)).alias("threshold"),
        message.alias("message"),
    )


def _compare(template_ok: str, template_bad: str, passed: Column, *values: Column) -> Column:
    return F.when(passed, F.format_string(template_ok, *values)).otherwise(
        F.format_string(template_bad, *values)
    )


def rule_srm(limits: Thresholds = DEFAULTS) -> Column:
    found = F.col("srm_detected")
    message = F.when(
        found, F.lit("Traffic split deviates from the plan; results can not be trusted.")
    ).otherwise(F.lit("Traffic split is consistent with the plan."))
    return _result("srm_rule", ~found, found.cast("int"), limits.srm, message)


def rule_significance(limits: Thresholds = DEFAULTS) -> Column:
    p = F.col("p_value")
    passed = p < limits.alpha
    message = _compare(
        "Significant: p = %.4f, alpha = %.4f.", "Not significant: p = %.4f, alpha = %.4f.",
        passed, p, F.lit(limits.alpha),
    )
    return _result("significance_rule", passed, p, limits.alpha, message)


def rule_power(limits: Thresholds = DEFAULTS) -> Column:
    power = F.col("achieved_power")
    passed = power >= limits.power
    message = _compare(
        "Power %.2f%% reaches the target of %.2f%%.",
        "Power %.2f%% misses the target of %.2f%%.",
        passed, power * 100, F.lit(limits.power * 100),
    )
    return _result("power_rule", passed, power, limits.power, message)


def rule_practical_uplift(limits: Thresholds = DEFAULTS) -> Column:
    lift = F.col("relative_lift")
    passed = lift >= limits.uplift
    message = _compare(
        "Relative lift %.2f%% reaches the minimum of %.2f%%.",
        "Relative lift %.2f%% is below the minimum of %.2f%%.",
        passed, lift * 100, F.lit(limits.uplift * 100),
    )
    return _result("practical_uplift_rule", passed, lift, limits.uplift, message)


def rule_guardrail_bounce(limits: Thresholds = DEFAULTS) -> Column:
    control, variant = F.col("control_bounce_rate"), F.col("variant_bounce_rate")
    change = (variant - control) / null_if_zero(control)
    undefined = control == 0
    passed = F.when(undefined, F.lit(True)).otherwise(change <= limits.bounce_tolerance)
    message = F.when(
        undefined, F.lit("Bounce rate not compared: control has no bounces.")
    ).otherwise(
        _compare(
            "Bounce rate change %.2f%% is within the tolerance of %.2f%%.",
            "Bounce rate change %.2f%% exceeds the tolerance of %.2f%%.",
            passed, change * 100, F.lit(limits.bounce_tolerance * 100),
        )
    )
    actual = F.when(undefined, F.lit(0.0)).otherwise(change)
    return _result(
        "guardrail_bounce_rate_rule", passed, actual, limits.bounce_tolerance, message
    )


def rule_sample_size(limits: Thresholds = DEFAULTS) -> Column:
    current, required = F.col("current_n"), F.col("required_n")
    undefined = required <= 0
    share = current.cast("double") / null_if_zero(required.cast("double"))
    passed = F.when(undefined, F.lit(True)).otherwise(share >= limits.sample_ratio)
    message = F.when(undefined, F.lit("Sample size not compared: none is required.")).otherwise(
        _compare(
            "Sample size reached: %d of %d users.", "Sample size not reached: %d of %d users.",
            passed, current.cast("bigint"), required.cast("bigint"),
        )
    )
    actual = F.when(undefined, F.lit(1.0)).otherwise(share)
    return _result("sample_size_rule", passed, actual, limits.sample_ratio, message)


# In the order of evaluation.
RULES = {
    "rule_srm": rule_srm,
    "rule_significance": rule_significance,
    "rule_power": rule_power,
    "rule_practical_uplift": rule_practical_uplift,
    "rule_guardrail_bounce": rule_guardrail_bounce,
    "rule_sample_size": rule_sample_size,
}


def apply_rule(inputs: DataFrame, rule: str, limits: Thresholds = DEFAULTS) -> DataFrame:
    assert_columns_exist(inputs, INPUTS, rule)
    return inputs.select("experiment_name", RULES[rule](limits).alias("r")).select(
        "experiment_name", "r.*"
    )


def _all_rules(limits: Thresholds) -> Column:
    return F.array(*[rule(limits) for rule in RULES.values()])


def evaluate_rules(inputs: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Six rows per experiment, in the order of ``RULES``."""
    assert_columns_exist(inputs, INPUTS, "evaluate_rules")
    return inputs.select("experiment_name", F.posexplode(_all_rules(limits))).select(
        "experiment_name", (F.col("pos") + 1).alias("rule_order"), "col.*"
    )


def _confidence(results: Column) -> Column:
    failed = F.size(F.filter(results, lambda r: ~r["passed"]))
    return F.when(failed == 0, "HIGH").when(failed <= 2, "MEDIUM").otherwise("LOW")


def recommendation(inputs: DataFrame, limits: Thresholds = DEFAULTS) -> DataFrame:
    """Recommendation, title, confidence and summary per experiment.

    The lift is compared as a fraction and the bounce guardrail takes part in the decision.
    ``rule_results`` holds the six rule records and ``key_metrics`` the numbers behind them.
    """
    assert_columns_exist(inputs, INPUTS, "recommendation")
    significant = F.coalesce(F.col("p_value") < limits.alpha, F.lit(False))
    powered = F.coalesce(F.col("achieved_power") >= limits.power, F.lit(False))
    uplift = F.coalesce(F.col("relative_lift") >= limits.uplift, F.lit(False))
    enough = F.coalesce(F.col("current_n") >= F.col("required_n"), F.lit(False))
    staged = inputs.withColumn("rule_results", _all_rules(limits))
    guardrail = F.exists(
        "rule_results",
        lambda r: (r["rule_name"] == "guardrail_bounce_rate_rule") & r["passed"],
    )
    choice = (
        F.when(F.col("srm_detected"), "INVESTIGATE_DATA_QUALITY")
        .when(~significant & ~enough, "CONTINUE_EXPERIMENT")
        .when(~significant, "STOP_FOR_FUTILITY")
        .when(powered & uplift & guardrail, "LAUNCH")
        .when(~powered | ~uplift, "CONTINUE_EXPERIMENT")
        .otherwise("INVESTIGATE_DATA_QUALITY")
    )
    lift = F.col("relative_lift") * 100
    power = F.col("achieved_power") * 100
    p = F.col("p_value")
    summary = (
        F.when(
            F.col("recommendation") == "LAUNCH",
            F.format_string(
                "Conversion rose by %.2f%% (p = %.4f, power %.2f%%) and the guardrails hold: "
                "launch the variant to all users.",
                lift, p, power,
            ),
        )
        .when(
            F.col("recommendation") == "CONTINUE_EXPERIMENT",
            F.format_string(
                "Inconclusive at a lift of %.2f%% (p = %.4f, power %.2f%%): continue until %d "
                "users per arm are reached.",
                lift, p, power, F.col("required_n").cast("bigint"),
            ),
        )
        .when(
            F.col("recommendation") == "STOP_FOR_FUTILITY",
            F.format_string(
                "No significant change (p = %.4f) although the required %d users per arm were "
                "reached: stop and keep control.",
                p, F.col("required_n").cast("bigint"),
            ),
        )
        .otherwise(
            F.format_string(
                "The allocation or a guardrail is off, so the result (p = %.4f) can not be "
                "trusted: investigate the data first.",
                p,
            )
        )
    )
    return (
        staged.withColumn("recommendation", choice)
        .select(
            "experiment_name",
            "recommendation",
            F.initcap(F.replace("recommendation", F.lit("_"), F.lit(" "))).alias("decision"),
            _confidence(F.col("rule_results")).alias("confidence"),
            summary.alias("summary"),
            "rule_results",
            F.create_map(
                F.lit("p_value"), p,
                F.lit("relative_lift_pct"), lift,
                F.lit("achieved_power"), F.col("achieved_power"),
                F.lit("control_n"), F.col("current_n").cast("double"),
                F.lit("required_n"), F.col("required_n").cast("double"),
            ).alias("key_metrics"),
        )
    )


def recommendation_confidence(rules: DataFrame) -> DataFrame:
    """Confidence from long rule rows: all passed HIGH, up to two failed MEDIUM, else LOW."""
    counted = rules.groupBy("experiment_name").agg(
        F.count_if("passed").alias("rules_passed"), F.count(F.lit(1)).alias("rules_total")
    )
    missing = F.col("rules_total") - F.col("rules_passed")
    return counted.withColumn(
        "confidence",
        F.when(missing == 0, "HIGH").when(missing <= 2, "MEDIUM").otherwise("LOW"),
    )
