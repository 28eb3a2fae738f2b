"""Attribution, dense days, sketches and the exact power solver."""

from __future__ import annotations

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.tiny import ROWS, assignment, at, one, order, session, tables, user
from trialscope.operators import attribution, reports, sketches, statistics, views


def test_purchases_before_the_assignment_do_not_count(spark):
    t = tables(
        spark,
        experiments=[
            assignment("x1", "A", "control", "u1", 2), assignment("x2", "A", "variant", "u2", 2),
            assignment("x3", "B", "variant", "u1", 4), assignment("x4", "A", "control", "u3", 2),
            assignment("x5", "A", "control", "u3", 5), assignment("x6", "A", "variant", "u4", 1),
        ],
        orders=[
            order("o1", "u1", "s1", at(1, 23), 1), order("o2", "u1", "s1", at(2, 0), 2),
            order("o3", "u1", "s1", at(3, 5), 4), order("o4", "u1", "s1", at(4, 0), 8),
            order("o5", "u2", "s2", at(1), 16), order("o6", "u3", "s1", at(2, 1), 32),
            order("o7", "u2", "s2", at(3), 64, "refunded", True), order("o8", "u1", "s1", at(9), 128, "failed"),
        ],
    )
    summary = views.experiment_summary(t, after_assignment=True)
    control = one(summary, experiment_name="A", variant="control")
    # u3 has two assignment rows, so its purchase weighs twice, as without the flag.
    assert (control["total_users"], control["purchasers"], float(control["total_revenue"])) == (2, 2, 2 + 4 + 8 + 64)
    assert one(summary, experiment_name="A", variant="variant")["purchasers"] == 0
    assert float(one(summary, experiment_name="B")["total_revenue"]) == 8
    revenue = views.revenue_summary(t, after_assignment=True)
    row = one(revenue, experiment_name="A", variant="variant")
    assert (row["total_users"], row["refunded_orders"], row["completed_orders"]) == (2, 1, 0)
    assert one(revenue, experiment_name="A", variant="control")["failed_orders"] == 1
    daily = views.daily_metrics_view(t, after_assignment=True)
    day = one(daily, metric_date=at(2).date(), experiment_name="A", variant="control")
    assert (day["purchasing_users"], float(day["daily_revenue"])) == (2, 2 + 64)


def test_attribution_like_brute_force_with_a_hot_user(spark):
    rng = random.Random(4)
    people = [assignment(f"x{i}", rng.choice("AB"), rng.choice(["control", "variant"]), f"u{i % 9}", rng.randint(1, 9))
              for i in range(14)]
    bought = [order(f"o{i}", "u0" if rng.random() < 0.5 else f"u{rng.randint(1, 8)}", "s1",
                    at(rng.randint(1, 12), rng.randint(0, 23)), rng.randint(1, 50)) for i in range(400)]
    first = {}
    for _, name, arm, uid, ts, _ in people:
        first[name, arm, uid] = min(ts, first.get((name, arm, uid), ts))
    expected = defaultdict(lambda: [0, 0])
    for (name, arm, uid), ts in first.items():
        for o in bought:
            if o[1] == uid and o[4] >= ts:
                expected[name, arm, uid][0] += 1
                expected[name, arm, uid][1] += float(o[5])
    found = attribution.orders_of_arm_users(tables(spark, experiments=people, orders=bought)).collect()
    assert {(r.experiment_name, r.variant, r.user_id): [r.sales, float(r.gross)] for r in found} == dict(expected)


def test_attribution_never_joins_orders_to_all_days(spark):
    plan = attribution.orders_after_assignment(tables(spark))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_dense_days_are_not_distorted_by_a_missing_arm(spark):
    people = [assignment(f"c{i}", "A", "control", f"u{i}", 1 if i < 6 else 3) for i in range(8)]
    people += [assignment(f"v{i}", "A", "variant", f"w{i}", 1 if i < 7 else 4) for i in range(9)]
    t = tables(spark, experiments=people, users=[user(f"u{i}") for i in range(8)])
    dense = reports.dense_daily_srm(t, minimum_users=10, tolerance=0.05)
    third = one(dense, metric_date=at(3).date())
    assert (third["cumulative_control"], third["cumulative_variant"]) == (8, 7)
    assert third["actual_cumulative_variant_fraction"] == pytest.approx(7 / 15) and not third["srm_warning_flag"]
    second = one(dense, metric_date=at(2).date())
    assert (second["daily_users_control"], second["cumulative_control"], second["cumulative_variant"]) == (0, 6, 7)
    # The check over assignment days only takes the one arm of that day for all.
    sparse = one(reports.daily_srm_check(t, minimum_users=7), metric_date=at(3).date())
    assert sparse["actual_cumulative_variant_fraction"] == 0 and sparse["srm_warning_flag"]
    assert dense.count() == 4
    # By country: users without a profile are not watched, and an arm that a country never has has no days.
    by = reports.dense_daily_srm(t, ("country_name",)).collect()
    assert {r.country_name for r in by} == {"Alfa"} and {r.cumulative_variant for r in by} == {0}
    assert len(by) == 3
    assert reports.dense_daily_srm(tables(spark, experiments=ROWS["experiments"][:0])).count() == 0


def test_distinct_states_are_united_over_days(spark):
    days = spark.range(60_000).select(
        (F.col("id") % 30).alias("day"), (F.col("id") % 2).alias("arm"), (F.xxhash64("id") % 20_000).alias("user_id")
    )
    states = sketches.distinct_states(days, ["day", "arm"])
    for by in (["arm"], ["day"], ["day", "arm"]):
        exact = days.groupBy(*by).agg(F.count_distinct("user_id").alias("exact"))
        found = sketches.compared(exact, sketches.united_distinct(states, by), by, sketches.relative_error()).collect()
        assert found and all(r.within_bound for r in found)
    # Registers bound a state's size whatever the number of users.
    sizes = [r[0] for r in states.select(F.length("state")).collect()]
    assert max(sizes) < 5_000
    none = sketches.distinct_states(days.limit(0), ["arm"])
    assert none.count() == 0


def test_percentile_states_are_united_over_days(spark):
    rng = random.Random(6)
    people = [user(f"u{i}") for i in range(300)]
    arms = [assignment(f"x{i}", "A", "control" if i % 2 else "variant", f"u{i}", 1 + i % 3) for i in range(300)]
    arms += [assignment("again", "A", "control", "u1", 2)]
    visits = []
    for i in range(3000):
        start = at(rng.randint(1, 20))
        visits.append(session(f"s{i}", f"u{rng.randint(0, 299)}", start, start, 1)[:4] + (int(rng.lognormvariate(6, 1)), 1, 1, 1, False))
    bought = [order(f"o{i}", f"u{rng.randint(0, 299)}", "s1", at(5), rng.randint(1, 500)) for i in range(900)]
    t = tables(spark, users=people, experiments=arms, sessions=visits, orders=bought)

    weight = defaultdict(int)
    for _, name, arm, uid, _, _ in arms:
        weight[arm, uid] += 1
    values, money = defaultdict(list), defaultdict(float)
    for v in visits:
        for arm in ("control", "variant"):
            values[arm] += [v[4]] * weight[arm, v[1]]
    for o in bought:
        for arm in ("control", "variant"):
            money[arm, o[1]] += float(o[5]) * weight[arm, o[1]]
    revenue = defaultdict(list)
    for (arm, _), x in money.items():
        if x:
            revenue[arm].append(x)

    def near(x, data, p, error=0.02):
        n = len(data)
        assert sum(y < x for y in data) <= n * (p + error) + 1 and sum(y <= x for y in data) >= n * (p - error) - 1

    exact = {r.variant: r for r in views.session_metrics_view(t).collect()}
    for r in views.session_metrics_view(t, approx=True).collect():
        near(r.median_session_duration_seconds, values[r.variant], 0.5)
        near(r.p95_duration_seconds, values[r.variant], 0.95)
        assert (r.total_sessions, r.unique_users) == (exact[r.variant].total_sessions, exact[r.variant].unique_users)
        assert r.avg_session_duration_seconds == exact[r.variant].avg_session_duration_seconds
    for r in reports.revenue_per_visitor(t, approx=True).collect():
        near(r.p25_order_value, revenue[r.variant], 0.25)
        near(r.median_order_value, revenue[r.variant], 0.5)
    # A roll-up over some days reads states only.
    states = sketches.session_states(t).where("metric_date < '2024-01-08'")
    week = sketches.united_percentiles(states, ["variant"], {"p50": 0.5}).collect()
    for r in week:
        some = [v[4] for v in visits if v[2] < at(8) for _ in range(weight[r.variant, v[1]])]
        near(r.p50, some, 0.5)


def two_sided_power(h, n, alpha):
    from statistics import NormalDist

    z, shift = NormalDist().inv_cdf(1 - alpha / 2), abs(h) * math.sqrt(n / 2)
    return 0.5 * math.erfc((z - shift) / math.sqrt(2)) + 0.5 * math.erfc((z + shift) / math.sqrt(2))


def solved(h, alpha, power):
    """Users per arm by doubling and halving over the power function itself."""
    high = 1e-6
    while two_sided_power(h, high, alpha) < power:
        high *= 2
    low = 0.0
    for _ in range(300):
        middle = (low + high) / 2
        low, high = (middle, high) if two_sided_power(h, middle, alpha) < power else (low, middle)
    return high


@pytest.mark.parametrize(("alpha", "power"), [(0.05, 0.8), (0.05, 0.1), (0.2, 0.25), (0.01, 0.95), (0.1, 0.5)])
def test_sample_sizes_equal_a_root_finder(spark, alpha, power):
    grid = [(b, e) for b in (0.0, 0.01, 0.1, 0.3, 0.5, 0.9) for e in (0.001, 0.02, 0.08, 0.1, -0.005)]
    df = spark.createDataFrame(grid, "base double, effect double")
    got = statistics.required_sample_size(df, "base", "effect", alpha, power, "n").collect()

    def angle(p):
        return 2 * math.asin(math.sqrt(min(1.0, max(0.0, p))))

    for r in got:
        h = angle(r.base + r.effect) - angle(r.base)
        if h:
            assert r.n == int(solved(h, alpha, power) + 1e-9) or r.n == int(solved(h, alpha, power) - 1e-9)
    sizes = spark.createDataFrame([(b, n) for b in (0.05, 0.4) for n in (2, 3, 10, 50, 1000, 0)], "base double, n long")
    for r in statistics.mde_for_n(sizes, "base", "n", alpha, power).collect():
        if r.n:
            low, high = 0.0, 100.0
            for _ in range(200):
                middle = (low + high) / 2
                low, high = (middle, high) if two_sided_power(middle, r.n, alpha) < power else (low, middle)
            assert r.mde == pytest.approx(math.sin((high + angle(r.base)) / 2) ** 2 - r.base, abs=1e-9)
        else:
            assert r.mde == 0
