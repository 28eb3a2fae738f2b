"""Formulas against independent computations with math.erfc and hand-worked cases."""

from __future__ import annotations

import math
import random
import statistics as st

import pytest
from pyspark.sql import functions as F

from tests.tiny import one
from trialscope.functions.distributions import small_t_quantiles, t_quantile, with_upper_tails
from trialscope.functions.quantiles import percentiles
from trialscope.operators import outliers, statistics

DDL = "id string, control_users long, variant_users long, control_conversions long, variant_conversions long"


def counts(spark, *rows):
    return spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)], DDL)


def test_normal_tail_matches_erfc(spark):
    zs = [0.0, 1e-9, 0.3, 1.0, 1.96, 3.5, 7.0, 7.0710678, 7.08, 9.0, 20.0, 36.9, 38.0]
    zs += [-z for z in zs]
    df = spark.createDataFrame([(z,) for z in zs], "z double")
    for row in with_upper_tails(df, tail=F.col("z")).collect():
        assert row.tail == pytest.approx(0.5 * math.erfc(row.z / math.sqrt(2)), rel=1e-9, abs=1e-16)


def test_t_quantiles(spark):
    # Published table values at 97.5 %.
    known = {1: 12.7062, 2: 4.30265, 5: 2.57058, 10: 2.22814, 30: 2.04227, 60: 2.00030}
    table = small_t_quantiles(0.975)
    for df, t in known.items():
        assert table[df - 1] == pytest.approx(t, rel=1e-5)
    frame = spark.createDataFrame([(60,), (61,), (120,), (10**6,)], "df long")
    got = [r[0] for r in frame.select(t_quantile(0.975, F.col("df"))).collect()]
    assert got == pytest.approx([2.0002978, 1.9996236, 1.9799304, 1.9599664], rel=1e-6)


def test_z_test(spark):
    df = statistics.two_proportion_z_test(
        counts(spark, (1000, 1000, 100, 150), (1000, 1000, 100, 100), (10, 10, 0, 0))
    )
    hit, same, none = (one(df, id=str(i)) for i in range(3))
    assert hit["absolute_lift"] == pytest.approx(0.05)
    assert hit["relative_lift_pct"] == pytest.approx(50.0)
    z = 0.05 / math.sqrt(0.125 * 0.875 * 0.002)
    assert hit["z_score"] == pytest.approx(z)
    assert hit["p_value"] == pytest.approx(math.erfc(z / math.sqrt(2)))
    assert hit["is_significant"] is True
    assert (same["z_score"], same["p_value"], same["is_significant"]) == (0.0, 1.0, False)
    assert (none["z_score"], none["p_value"], none["relative_lift_pct"]) == (0.0, 1.0, 0.0)


def test_z_test_marks_impossible_counts(spark):
    df = statistics.two_proportion_z_test(
        counts(spark, (0, 1000, 0, 100), (100, 100, 101, 10), (100, 100, -1, 10), (None, 1, 1, 1))
    )
    for row in df.collect():
        assert row.is_valid is False and row.p_value is None and row.z_score is None


def test_intervals(spark):
    df = spark.createDataFrame([(50, 1000), (0, 10), (0, 0)], "x long, n long")
    first, zero, empty = (one(statistics.proportion_ci(df, "x", "n"), x=x, n=n)
                          for x, n in ((50, 1000), (0, 10), (0, 0)))
    assert (first["ci_lower"], first["ci_upper"]) == pytest.approx((0.0381304, 0.0653136), rel=1e-3)
    assert zero["ci_lower"] == pytest.approx(0.0, abs=1e-12) and zero["ci_upper"] > 0.2
    assert (empty["ci_lower"], empty["ci_upper"], empty["margin_of_error"]) == (0.0, 0.0, 0.0)
    diff = statistics.difference_ci(counts(spark, (1000, 1000, 100, 150), (0, 10, 0, 5)))
    row = one(diff, id="0")
    margin = 1.959964 * math.sqrt(0.1 * 0.9 / 1000 + 0.15 * 0.85 / 1000)
    assert row["margin_of_error"] == pytest.approx(margin, rel=1e-6)
    assert row["ci_lower"] == pytest.approx(0.05 - margin)
    assert one(diff, id="1")["ci_upper"] == 0.0


def test_mean_interval(spark):
    values = [10.25, 20.5, 30.0, 99.99, 12.0]
    rows = [("a", v, 1) for v in values] + [("b", 7.5, 1), ("c", 4.0, 2)]
    hist = spark.createDataFrame(rows, "g string, revenue double, w long")
    df = statistics.mean_ci(hist, ["g"])
    row = one(df, g="a")
    margin = 2.776445 * st.stdev(values) / math.sqrt(5)
    assert row["ci_center"] == pytest.approx(st.mean(values))
    assert row["margin_of_error"] == pytest.approx(margin, rel=1e-5)
    single = one(df, g="b")
    assert (single["ci_lower"], single["ci_upper"], single["margin_of_error"]) == (7.5, 7.5, 0.0)
    assert one(df, g="c")["margin_of_error"] == 0.0


def test_effect_size_power_and_sample_size(spark):
    rates = spark.createDataFrame(
        [(0.1, 0.15), (0.5, 0.95), (-0.2, 1.3), (0.2, 0.2)], "control_rate double, variant_rate double"
    )
    got = [(r.cohens_h, r.magnitude) for r in statistics.cohens_h(rates).collect()]
    assert got[0][0] == pytest.approx(2 * math.asin(0.15**0.5) - 2 * math.asin(0.1**0.5))
    assert [m for _, m in got] == ["negligible", "large", "large", "negligible"]
    assert got[2][0] == pytest.approx(math.pi)
    df = statistics.achieved_power(
        counts(spark, (1000, 1200, 100, 156), (500, 500, 50, 50), (0, 10, 0, 1))
    )
    row, same, empty = (one(df, id=str(i)) for i in range(3))
    h = 2 * math.asin(0.13**0.5) - 2 * math.asin(0.1**0.5)
    shift = h * math.sqrt(1 / (1 / 1000 + 1 / 1200))
    normal = st.NormalDist()
    power = 1 - normal.cdf(1.959964 - shift) + normal.cdf(-1.959964 - shift)
    assert row["achieved_power"] == pytest.approx(power, rel=1e-5)
    z = normal.inv_cdf(0.975) + normal.inv_cdf(0.8)
    assert row["required_sample_size_per_group"] == int(2 * z * z / (h * h))
    # The detectable effect has the target power with the users that were there, both tails counted.
    back = 2 * math.asin((0.1 + row["mde"]) ** 0.5) - 2 * math.asin(0.1**0.5)
    z, shift = normal.inv_cdf(0.975), back * math.sqrt(1000 / 2)
    assert normal.cdf(shift - z) + normal.cdf(-shift - z) == pytest.approx(0.8, rel=1e-9)
    assert (same["achieved_power"], same["required_sample_size_per_group"]) == (0.05, 0)
    assert (empty["achieved_power"], empty["mde"], empty["is_adequately_powered"]) == (0.0, 0.0, False)


def test_srm(spark):
    df = statistics.srm_test(counts(spark, (500, 500, 0, 0), (600, 400, 0, 0), (0, 0, 0, 0)))
    even, off, none = (one(df, id=str(i)) for i in range(3))
    assert (even["chi_square_statistic"], even["srm_p_value"]) == (0.0, 1.0)
    assert off["chi_square_statistic"] == pytest.approx(40.0)
    assert off["srm_p_value"] == pytest.approx(math.erfc(math.sqrt(20)), rel=1e-9)
    assert off["srm_detected"] is True and even["srm_detected"] is False
    assert (none["srm_p_value"], none["srm_detected"]) == (1.0, False)
    planned = one(statistics.srm_test(counts(spark, (800, 200, 0, 0)), expected_split=0.2), id="0")
    assert planned["chi_square_statistic"] == pytest.approx(0.0)


def test_corrections(spark):
    ps = {"a": 0.01, "b": 0.04, "c": 0.03, "d": 0.03, "e": None}
    df = spark.createDataFrame(
        [("x", k, p) for k, p in ps.items()], "experiment_name string, metric_name string, p_value double"
    )
    bonferroni = {r.metric_name: r.corrected_p_value for r in statistics.bonferroni(df).collect()}
    assert bonferroni == pytest.approx({"a": 0.04, "b": 0.16, "c": 0.12, "d": 0.12, "e": None})
    fdr = {r.metric_name: r for r in statistics.benjamini_hochberg(df).collect()}
    assert {k: r.corrected_p_value for k, r in fdr.items()} == pytest.approx(
        {"a": 0.04, "b": 0.04, "c": 0.04, "d": 0.04, "e": None}
    )
    assert fdr["a"].is_significant is True and fdr["e"].is_significant is None
    none = statistics.correct_p_values(df, "none").collect()
    assert {r.metric_name: r.corrected_p_value for r in none} == ps
    with pytest.raises(ValueError, match="unknown correction"):
        statistics.correct_p_values(df, "other")


def _exact(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    lo = math.floor(at)
    hi = math.ceil(at)
    return values[lo] + (values[hi] - values[lo]) * (at - lo)


def test_percentiles_match_sorting(spark):
    rng = random.Random(7)
    groups = {
        "money": [round(rng.lognormvariate(3, 2), 2) for _ in range(3000)],
        "mixed": [float(rng.randint(-500, 500)) for _ in range(999)],
        "hot": [5.0] * 4000 + [float(i) for i in range(10)],
        "one": [42.0],
        "pair": [1.0, 2.0],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("money", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    hist = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("w"))
    wanted = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p95": 0.95, "p99": 0.99}
    found = {r.g: r for r in percentiles(hist, ["g"], "v", "w", wanted, 0.01, ["w"]).collect()}
    for g, vs in groups.items():
        assert found[g].n == len(vs)
        assert found[g].w == len(vs) + (g == "money")
        for name, p in wanted.items():
            assert found[g][name] == pytest.approx(_exact(vs, p)), (g, name)


def test_outliers_and_winsorizing(spark):
    base = [10.0, 11.0, 12.0, 13.0, 14.0] * 8
    groups = {"with": base + [500.0], "few": [1.0, 1.0, 900.0], "none": base}
    rows = [("x", g, f"u{i}", v) for g, vs in groups.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "experiment_name string, variant string, user_id string, revenue double")
    flagged = outliers.iqr_outliers(df).where("is_outlier").collect()
    assert [(r.variant, r.revenue) for r in flagged] == [("with", 500.0)]
    hist = df.groupBy("experiment_name", "variant", "revenue").agg(F.count(F.lit(1)).alias("w"))
    impact = outliers.outlier_impact(hist)
    hit, few, none = (one(impact, variant=v) for v in ("with", "few", "none"))
    assert hit["outlier_count"] == 1 and hit["outliers_material"] is True
    assert hit["mean_without_outliers"] == pytest.approx(12.0)
    assert hit["outlier_threshold"] == pytest.approx(13 + 3 * 2)
    assert few["outlier_count"] == 0 and few["outlier_threshold"] == 900.0
    assert (none["mean_difference_pct"], none["outliers_material"]) == (0.0, False)
    mean = one(outliers.winsorized_mean(hist), variant="with")
    kept = sorted(groups["with"])
    low, high = int(0.05 * 41), int(0.05 * 41)
    clipped = [kept[low]] * low + kept[low:41 - high] + [kept[41 - high - 1]] * high
    assert mean["winsorized_mean"] == pytest.approx(sum(clipped) / 41)
