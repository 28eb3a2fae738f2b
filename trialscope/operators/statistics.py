"""Statistical tests as Column formulas over summary rows.

Every function takes a frame with one row per comparison (an experiment, or an experiment and a
segment) and appends or selects columns; all rows are evaluated at once, on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialscope import schemas as S
from trialscope.functions.distributions import (
    normal_quantile,
    t_quantile,
    with_upper_tails,
)
from trialscope.functions.guards import assert_columns_exist
from trialscope.functions.ratios import null_if_zero, ratio
from trialscope.operators.metrics import side_by_side

COUNTS = ("control_users", "variant_users", "control_conversions", "variant_conversions")


def arms(summary: DataFrame) -> DataFrame:
    """Counts of both arms per experiment, from ``views.experiment_summary``."""
    return side_by_side(summary, users="total_users", conversions="purchasers")


def _counts(df: DataFrame, context: str) -> tuple[Column, Column, Column, Column]:
    assert_columns_exist(df, COUNTS, context)
    n_c, n_v, x_c, x_v = (F.col(c).cast("double") for c in COUNTS)
    return n_c, n_v, x_c, x_v


def _is_valid(n_c: Column, n_v: Column, x_c: Column, x_v: Column) -> Column:
    valid = (
        (n_c > 0) & (n_v > 0) & (x_c >= 0) & (x_v >= 0) & (x_c <= n_c) & (x_v <= n_v)
    )
    return F.coalesce(valid, F.lit(False))


def two_proportion_z_test(df: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Pooled two-sided z-test.

    Rows with impossible counts get ``is_valid`` false and NULL results instead of an error,
    which would stop the other rows.
    """
    n_c, n_v, x_c, x_v = _counts(df, "two_proportion_z_test")
    valid = _is_valid(n_c, n_v, x_c, x_v)
    staged = df.select(
        "*",
        valid.alias("is_valid"),
        F.when(valid, ratio(x_c, n_c)).alias("control_rate"),
        F.when(valid, ratio(x_v, n_v)).alias("variant_rate"),
        F.when(valid, ratio(x_c + x_v, n_c + n_v)).alias("pooled_proportion"),
    )
    p = F.col("pooled_proportion")
    spread = p * (F.lit(1.0) - p) * (
        F.lit(1.0) / null_if_zero(n_c) + F.lit(1.0) / null_if_zero(n_v)
    )
    staged = staged.withColumn("standard_error", F.when(F.col("is_valid"), F.sqrt(spread)))
    difference = F.col("variant_rate") - F.col("control_rate")
    error = F.col("standard_error")
    staged = staged.withColumn(
        "z_score", F.when(error == 0, F.lit(0.0)).otherwise(difference / null_if_zero(error))
    )
    staged = with_upper_tails(staged, _tail=F.abs("z_score")).withColumn(
        "p_value",
        F.when(F.col("standard_error") == 0, F.lit(1.0)).otherwise(F.col("_tail") * 2),
    )
    base = F.col("control_rate")
    return staged.drop("_tail").select(
        "*",
        difference.alias("absolute_lift"),
        F.when(base > 0, difference / null_if_zero(base) * 100)
        .when(base == 0, F.lit(0.0))
        .alias("relative_lift_pct"),
        (F.col("p_value") < alpha).alias("is_significant"),
        F.lit(alpha).alias("alpha"),
    )


def proportion_ci(
    df: DataFrame, successes: str, n: str, confidence: float = 0.95
) -> DataFrame:
    """Wilson score interval of a proportion; the centre is the raw proportion."""
    assert_columns_exist(df, [successes, n], "proportion_ci")
    z = normal_quantile(1 - (1 - confidence) / 2)
    staged = (
        df.withColumn("_n", null_if_zero(F.col(n).cast("double")))
        .withColumn("_p", F.col(successes).cast("double") / F.col("_n"))
        .withColumn("_scale", F.lit(1.0) + F.lit(z * z) / F.col("_n"))
    )
    size, p, scale = F.col("_n"), F.col("_p"), F.col("_scale")
    middle = (p + F.lit(z * z) / (size * 2)) / scale
    half = (
        F.lit(z) * F.sqrt(p * (F.lit(1.0) - p) / size + F.lit(z * z) / (size * size * 4)) / scale
    )
    staged = staged.withColumns({"_middle": middle, "_half": half})
    zero = F.lit(0.0)
    return staged.select(
        *df.columns,
        F.coalesce(F.col("_middle") - F.col("_half"), zero).alias("ci_lower"),
        F.coalesce(F.col("_middle") + F.col("_half"), zero).alias("ci_upper"),
        F.coalesce(p, zero).alias("ci_center"),
        F.coalesce("_half", zero).alias("margin_of_error"),
        F.lit(confidence).alias("confidence_level"),
    )


def difference_ci(df: DataFrame, confidence: float = 0.95) -> DataFrame:
    """Unpooled interval of the difference of two proportions; zeros for an empty arm."""
    n_c, n_v, x_c, x_v = _counts(df, "difference_ci")
    n_c, n_v = null_if_zero(n_c), null_if_zero(n_v)
    z = normal_quantile(1 - (1 - confidence) / 2)
    staged = df.withColumns(
        {"_nc": n_c, "_nv": n_v, "_pc": x_c / n_c, "_pv": x_v / n_v}
    )
    p_c, p_v = F.col("_pc"), F.col("_pv")
    error = F.sqrt(
        p_c * (F.lit(1.0) - p_c) / F.col("_nc") + p_v * (F.lit(1.0) - p_v) / F.col("_nv")
    )
    staged = staged.withColumns(
        {
            "_center": F.coalesce(p_v - p_c, F.lit(0.0)),
            "_margin": F.coalesce(F.lit(z) * error, F.lit(0.0)),
        }
    )
    center, margin = F.col("_center"), F.col("_margin")
    # An empty arm leaves no margin, and its centre is 0 as well.
    return staged.select(
        *df.columns,
        (center - margin).alias("ci_lower"),
        (center + margin).alias("ci_upper"),
        center.alias("ci_center"),
        margin.alias("margin_of_error"),
        F.lit(confidence).alias("confidence_level"),
    )


def mean_ci(
    hist: DataFrame,
    groups: Sequence[str],
    value: str = "revenue",
    weight: str = "w",
    confidence: float = 0.95,
    resolution: float = 0.01,
) -> DataFrame:
    """Student-t interval of a mean, from (group, value, weight) rows.

    Values are multiples of ``resolution`` (cents by default); a finer one raises.  Sums run over
    whole multiples in decimals, so they do not depend on the order of rows.
    """
    per_unit = round(1 / resolution)
    scaled = F.col(value) * per_unit
    whole = F.round(scaled).cast("decimal(18,0)")
    finer = F.abs(scaled - whole) > 1e-6
    message = F.concat(F.lit(f"finer than {resolution}: "), F.col(value).cast("string"))
    cents = F.when(finer, F.raise_error(message).cast("decimal(18,0)")).otherwise(whole)
    sums = hist.groupBy(*groups).agg(
        F.sum(weight).alias("n"),
        F.sum(cents * F.col(weight)).cast("double").alias("_s1"),
        F.sum((cents * cents).cast("decimal(38,0)") * F.col(weight)).cast("double").alias("_s2"),
    )
    n = F.col("n").cast("double")
    mean = F.col("_s1") / n / per_unit
    spread = (F.col("_s2") - F.col("_s1") * F.col("_s1") / n) / null_if_zero(n - 1)
    error = F.sqrt(F.greatest(spread, F.lit(0.0)) / n) / per_unit
    margin = F.when(F.col("n") < 2, F.lit(0.0)).otherwise(
        error * t_quantile((1 + confidence) / 2, F.col("n") - 1)
    )
    return sums.select(
        *groups,
        "n",
        mean.alias("ci_center"),
        (mean - margin).alias("ci_lower"),
        (mean + margin).alias("ci_upper"),
        margin.alias("margin_of_error"),
        F.lit(confidence).alias("confidence_level"),
    )


def _angle(rate: Column) -> Column:
    inside = F.greatest(F.lit(0.0), F.least(F.lit(1.0), rate))
    return F.when(rate.isNotNull(), F.lit(2.0) * F.asin(F.sqrt(inside)))


def cohens_h(
    df: DataFrame, control_rate: str = "control_rate", variant_rate: str = "variant_rate"
) -> DataFrame:
    """Cohen's h of two proportions, positive when the variant is higher."""
    assert_columns_exist(df, [control_rate, variant_rate], "cohens_h")
    staged = df.select(
        "*",
        _angle(F.col(control_rate)).alias("phi_control"),
        _angle(F.col(variant_rate)).alias("phi_variant"),
    ).withColumn("cohens_h", F.col("phi_variant") - F.col("phi_control"))
    size = F.abs("cohens_h")
    return staged.withColumn(
        "magnitude",
        F.when(size < 0.2, "negligible")
        .when(size < 0.5, "small")
        .when(size < 0.8, "medium")
        .when(size >= 0.8, "large"),
    )


@lru_cache(maxsize=None)
def detectable_shift(alpha: float, power: float) -> float:
    """The shift of a standard normal statistic that a two-sided test finds with the given power.

    With equal arms the power depends on effect and size only through this shift, h * sqrt(n / 2), so
    it is solved once, with both tails, by bisection on the driver.  It is 0 for a power that a
    test of no effect has already.
    """
    normal, z = NormalDist(), normal_quantile(1 - alpha / 2)
    low, high = 0.0, z + abs(normal_quantile(power)) + 1.0
    for _ in range(200):
        middle = (low + high) / 2
        if normal.cdf(middle - z) + normal.cdf(-middle - z) < power:
            low = middle
        else:
            high = middle
    return high


def required_sample_size(
    df: DataFrame,
    baseline: str,
    mde: str,
    alpha: float = 0.05,
    power: float = 0.80,
    output: str = "required_sample_size",
) -> DataFrame:
    """Users per arm to detect ``baseline + mde`` in a two-sided test; truncated; 0 for no effect."""
    assert_columns_exist(df, [baseline, mde], "required_sample_size")
    z = detectable_shift(alpha, power)
    base, effect = F.col(baseline), F.col(mde)
    staged = df.withColumn("_h", _angle(base + effect) - _angle(base))
    needed = F.lit(2.0 * z * z) / null_if_zero(F.col("_h") * F.col("_h"))
    size = F.when(effect == 0, F.lit(0)).otherwise(F.floor(needed)).cast("bigint")
    return staged.withColumn(output, size).drop("_h")


def mde_for_n(
    df: DataFrame,
    baseline: str,
    n: str,
    alpha: float = 0.05,
    power: float = 0.80,
    output: str = "mde",
) -> DataFrame:
    """Smallest absolute effect that n users per arm detect; 0 for n <= 0."""
    assert_columns_exist(df, [baseline, n], "mde_for_n")
    size = F.when(F.col(n) > 0, F.col(n).cast("double"))
    h = F.lit(detectable_shift(alpha, power)) * F.sqrt(F.lit(2.0) / size)
    staged = df.withColumn("_root", F.sin((h + _angle(F.col(baseline))) / 2))
    found = F.col("_root") * F.col("_root") - F.col(baseline)
    return staged.withColumn(output, F.coalesce(found, F.lit(0.0))).drop("_root")


def achieved_power(df: DataFrame, alpha: float = 0.05, target: float = 0.80) -> DataFrame:
    """Two-sided power at the observed effect, with the sample size that effect would need.

    The needed size uses the absolute observed difference as the effect to detect.  Rows with an
    empty arm get power, size and detectable effect 0.
    """
    n_c, n_v, x_c, x_v = _counts(df, "achieved_power")
    valid = F.coalesce((n_c > 0) & (n_v > 0), F.lit(False))
    inverse = F.lit(1.0) / null_if_zero(n_c) + F.lit(1.0) / null_if_zero(n_v)
    z = normal_quantile(1 - alpha / 2)
    staged = df.withColumns(
        {
            "_valid": valid,
            "_pc": F.when(valid, x_c / null_if_zero(n_c)),
            "_pv": F.when(valid, x_v / null_if_zero(n_v)),
            "_spread": F.sqrt(F.lit(1.0) / null_if_zero(inverse)),
            "_smallest": F.least(F.col("control_users"), F.col("variant_users")),
        }
    )
    staged = staged.withColumns(
        {
            "_effect": F.abs(F.col("_pv") - F.col("_pc")),
            "effect_size": F.coalesce(_angle(F.col("_pv")) - _angle(F.col("_pc")), F.lit(0.0)),
        }
    )
    shift = F.col("effect_size") * F.col("_spread")
    staged = with_upper_tails(staged, _above=F.lit(z) - shift, _below=F.lit(z) + shift)
    staged = required_sample_size(staged, "_pc", "_effect", alpha, target, "_needed")
    staged = mde_for_n(staged, "_pc", "_smallest", alpha, target, "_mde")
    valid, h = F.col("_valid"), F.col("effect_size")
    staged = staged.withColumn(
        "achieved_power",
        F.when(~valid, F.lit(0.0))
        .when(h == 0, F.lit(alpha))
        .otherwise(F.col("_above") + F.col("_below")),
    )
    needed = F.when(valid & (h != 0), F.col("_needed")).otherwise(F.lit(0))
    return staged.select(
        *df.columns,
        "effect_size",
        "achieved_power",
        needed.cast("bigint").alias("required_sample_size_per_group"),
        (F.col("achieved_power") >= target).alias("is_adequately_powered"),
        F.when(valid, F.col("_mde")).otherwise(F.lit(0.0)).alias("mde"),
    )


def srm_test(
    df: DataFrame,
    control_n: str = "control_users",
    variant_n: str = "variant_users",
    expected_split: float = 0.5,
    alpha: float = 0.01,
) -> DataFrame:
    """Chi-square test of the observed allocation; ``expected_split`` is the variant share."""
    assert_columns_exist(df, [control_n, variant_n], "srm_test")
    c = F.coalesce(F.col(control_n), F.lit(0)).cast("double")
    v = F.coalesce(F.col(variant_n), F.lit(0)).cast("double")
    total = c + v
    staged = df.select(
        "*",
        (total * F.lit(1 - expected_split)).alias("control_expected"),
        (total * F.lit(expected_split)).alias("variant_expected"),
    )
    e_c, e_v = F.col("control_expected"), F.col("variant_expected")
    statistic = (c - e_c) * (c - e_c) / null_if_zero(e_c) + (v - e_v) * (
        v - e_v
    ) / null_if_zero(e_v)
    staged = staged.withColumn("chi_square_statistic", F.coalesce(statistic, F.lit(0.0)))
    # The upper tail of a chi-square with one degree of freedom is a two-sided normal tail.
    staged = with_upper_tails(staged, _tail=F.sqrt("chi_square_statistic"))
    p = F.when(total == 0, F.lit(1.0)).otherwise(F.col("_tail") * 2)
    return (
        staged.withColumn("srm_p_value", p)
        .drop("_tail")
        .withColumn("srm_detected", F.col("srm_p_value") < alpha)
    )


def srm_from_assignments(
    experiments: DataFrame, expected_split: float = 0.5, alpha: float = 0.01
) -> DataFrame:
    """SRM test per experiment from raw assignments, the holdout excluded."""
    assert_columns_exist(
        experiments, ["experiment_name", "variant", "is_holdout"], "srm_from_assignments"
    )
    counts = (
        experiments.where(~F.col("is_holdout"))
        .groupBy("experiment_name")
        .agg(
            F.count_if(F.col("variant") == S.CONTROL).alias("control_observed"),
            F.count_if(F.col("variant") == S.VARIANT).alias("variant_observed"),
        )
    )
    return srm_test(counts, "control_observed", "variant_observed", expected_split, alpha)


FAMILY = ("experiment_name",)


def bonferroni(
    p_values: DataFrame, alpha: float = 0.05, family: Sequence[str] = FAMILY
) -> DataFrame:
    """p times the number of tests of the family, at most 1; NULL p-values are not counted."""
    tests = F.count("p_value").over(Window.partitionBy(*family))
    # least() skips NULLs, so a missing p-value is kept out of it.
    corrected = F.when(
        F.col("p_value").isNotNull(), F.least(F.col("p_value") * tests, F.lit(1.0))
    )
    return _corrected(p_values, corrected, "bonferroni", alpha)


def benjamini_hochberg(
    p_values: DataFrame, alpha: float = 0.05, family: Sequence[str] = FAMILY
) -> DataFrame:
    """Step-up false discovery rate; windows hold one family, i.e. the tests of an experiment."""
    in_family = Window.partitionBy(*family)
    ascending = in_family.orderBy(F.col("p_value").asc_nulls_last(), "metric_name")
    from_here = ascending.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = p_values.select(
        "*",
        F.row_number().over(ascending).alias("_rank"),
        F.count("p_value").over(in_family).alias("_tests"),
    ).withColumn("_raw", F.col("p_value") / (F.col("_rank") / F.col("_tests")))
    monotone = F.min("_raw").over(from_here)
    corrected = F.when(F.col("p_value").isNotNull(), F.least(monotone, F.lit(1.0)))
    return _corrected(ranked, corrected, "benjamini_hochberg", alpha).drop(
        "_rank", "_tests", "_raw"
    )


def uncorrected(
    p_values: DataFrame, alpha: float = 0.05, family: Sequence[str] = FAMILY
) -> DataFrame:
    return _corrected(p_values, F.col("p_value"), "none", alpha)


def _corrected(df: DataFrame, corrected: Column, method: str, alpha: float) -> DataFrame:
    return df.withColumn("corrected_p_value", corrected).select(
        "*",
        (F.col("corrected_p_value") <= alpha).alias("is_significant"),
        F.lit(method).alias("correction_method"),
        F.lit(alpha).alias("alpha"),
    )


CORRECTIONS = {
    "bonferroni": bonferroni,
    "benjamini_hochberg": benjamini_hochberg,
    "none": uncorrected,
}


def correct_p_values(
    p_values: DataFrame,
    method: str = "benjamini_hochberg",
    alpha: float = 0.05,
    family: Sequence[str] = FAMILY,
) -> DataFrame:
    if method not in CORRECTIONS:
        raise ValueError(f"unknown correction method {method!r}; known: {sorted(CORRECTIONS)}")
    return CORRECTIONS[method](p_values, alpha, family)


def comparisons(summary: DataFrame, lifts: DataFrame) -> DataFrame:
    """Counts of both arms per experiment overall and per user segment.

    ``lifts`` are rows of ``segments.all_lifts``; the overall row is named ``conversion``.
    """
    overall = arms(summary).select(
        "experiment_name", F.lit("conversion").alias("metric_name"), *COUNTS
    )
    per_segment = lifts.select(
        "experiment_name",
        F.concat_ws(":", "section", "segment").alias("metric_name"),
        F.col("total_users_control").alias("control_users"),
        F.col("total_users_variant").alias("variant_users"),
        F.col("purchasers_control").alias("control_conversions"),
        F.col("purchasers_variant").alias("variant_conversions"),
    )
    return overall.unionByName(per_segment)


def p_value_family(summary: DataFrame, lifts: DataFrame) -> DataFrame:
    """All p-values of an experiment: the overall test and one test per user segment."""
    return two_proportion_z_test(comparisons(summary, lifts)).select(
        "experiment_name", "metric_name", "p_value"
    )
