"""Each check on a clean and on a deliberately broken table."""

from __future__ import annotations

import datetime as dt

import pytest

from tests.tiny import ROWS, assignment, at, event, one, order, session, tables, user
from trialscope.functions.guards import assert_columns_exist, assert_not_empty
from trialscope.operators import constraints, quality


def status(df, **where):
    return {r.check_name: (r.status, r.violations) for r in df.collect()}


def test_clean_users(spark):
    found = status(quality.dq_users(tables(spark)["users"]))
    assert len(found) == 12
    assert {s for s, _ in found.values()} == {"PASS"}


def test_broken_users(spark):
    rows = [user(f"u{i}") for i in range(9)] + [
        user("u1"), user(None, kind="robot"), user("u20", kind=None)
    ]
    df = tables(spark, users=rows)["users"]
    found = status(quality.dq_users(df, "2023-12-02", "2023-12-31"))
    assert found["no_nulls_user_id"] == ("FAIL", 1)
    assert found["unique_user_id"] == ("FAIL", 1)
    assert found["valid_customer_type"] == ("FAIL", 1)
    assert found["no_nulls_customer_type"] == ("FAIL", 1)
    assert found["customer_type_balance"] == ("WARN", 1)
    assert found["signup_date_range"] == ("FAIL", 12)
    text = df.withColumn("is_returning", df.is_returning.cast("string")).na.replace("false", "maybe")
    assert status(quality.dq_users(text))["is_returning_boolean"][0] == "FAIL"


def test_empty_and_incomplete_tables(spark):
    t = tables(spark)
    for name, check in (("users", quality.dq_users), ("experiments", quality.dq_experiments),
                        ("sessions", quality.dq_sessions), ("events", quality.dq_events),
                        ("orders", quality.dq_orders)):
        empty = t[name].where("1 = 0")
        assert status(check(empty)) == {"non_empty": ("FAIL", 1)}, name
        key = quality.REQUIRED[name][0]
        assert status(check(t[name].drop(key))) == {"required_columns_present": ("FAIL", 1)}
        assert status(check(empty.drop(key))) == {"non_empty": ("FAIL", 1)}
    empty = t["events"].where("1 = 0")
    assert status(quality.dq_events(empty, t["sessions"], t["event_types"]))["non_empty"]


def test_experiment_splits(spark):
    rows = [assignment(f"a{i}", "even", "variant" if i % 2 else "control", f"u{i}") for i in range(10)]
    rows += [assignment(f"b{i}", "tilted", "variant" if i < 13 else "control", f"u{i}") for i in range(20)]
    rows += [assignment(f"c{i}", "broken", "variant", f"u{i}") for i in range(5)]
    rows += [assignment("d1", "even", "other", "u0", 9)]
    df = quality.dq_experiments(tables(spark, experiments=rows)["experiments"], "2024-01-01", "2024-01-05")
    split = {r.detail: r.status for r in df.where("check_name = 'variant_split'").collect()}
    assert split == {"even": "PASS", "tilted": "WARN", "broken": "FAIL"}
    found = status(df.where("check_name <> 'variant_split'"))
    assert found["valid_variant_values"] == ("FAIL", 1)
    assert found["unique_user_experiment"] == ("FAIL", 1)
    assert found["assignment_timestamp_range"] == ("FAIL", 1)


def test_sessions(spark):
    clean = status(quality.dq_sessions(
        tables(spark, sessions=[session("s1", "u1", at(1, 1), at(1, 2))])["sessions"]))
    assert len(clean) == 15 and {s for s, _ in clean.values()} == {"PASS"}
    rows = [session("s1", "u1", at(1, 5), at(1, 2)), session("s1", "u1", at(1), at(1)),
            session("s2", "u1", at(1), at(2), 0), session("s3", "u1", at(1), at(2), 4, True)]
    found = status(quality.dq_sessions(tables(spark, sessions=rows)["sessions"]))
    assert found["unique_session_id"] == ("FAIL", 1)
    assert found["session_end_after_start"] == ("FAIL", 1)
    assert found["positive_duration"] == ("FAIL", 2)
    assert found["page_count_minimum"] == ("FAIL", 1)
    assert found["bounce_page_count_consistency"] == ("WARN", 1)
    assert found["duration_distribution"] == ("WARN", 1)


@pytest.mark.parametrize("durations", [
    [7200] * 100, [7201] * 100, [10] * 99 + [720_000], [10] * 99 + [720_000_000], [10] * 98 + [9000] * 2,
    [7201], [7199, 7300], [7100, 7201], [1] * 1000 + [10**6] * 11,
])
def test_percentile_limit_equals_the_sorted_percentile(spark, durations):
    rows = [(f"s{i}", "u1", at(1), at(1), d, 1, 1, 1, False) for i, d in enumerate(durations)]
    found = status(quality.dq_sessions(tables(spark, sessions=rows)["sessions"]))
    ordered, at_rank = sorted(durations), 0.99 * (len(durations) - 1)
    low, high = int(at_rank), -int(-at_rank // 1)
    p99 = ordered[low] + (ordered[high] - ordered[low]) * (at_rank - low)
    assert found["duration_distribution"][0] == ("WARN" if p99 > 7200 else "PASS")


def test_events(spark):
    t = tables(spark)
    clean = status(quality.dq_events(t["events"], t["sessions"], t["event_types"]))
    assert len(clean) == 12 and {s for s, _ in clean.values()} == {"PASS"}
    assert len(status(quality.dq_events(t["events"], t["sessions"]))) == 10
    rows = ROWS["events"] + [
        event("e1", "s1", "u1", "page_view", at(1, 10)),
        event("e9", "lost", "u1", "page_view", at(1, 10), 5),
        event("e10", "s1", "u1", "purchase", at(1, 23), -5),
        event("e11", None, "u1", "page_view", at(1, 10)),
        ("e12", "s1", "u1", None, 99, at(1, 10), None, None, False),
        ("e13", "s1", "u1", None, 98, at(1, 10), None, None, False),
    ]
    broken = tables(spark, events=rows)
    df = quality.dq_events(broken["events"], t["sessions"], t["event_types"])
    found = status(df)
    assert found["unique_event_id"] == ("FAIL", 1)
    assert found["no_orphan_events"] == ("FAIL", 2)
    assert found["no_nulls_session_id"] == ("FAIL", 1)
    assert found["event_within_session_window"] == ("FAIL", 1)
    assert found["revenue_non_negative"] == ("FAIL", 1)
    assert found["revenue_only_on_purchase"] == ("WARN", 1)
    assert found["valid_event_type_ids"] == ("FAIL", 2)
    assert one(df, check_name="valid_event_type_ids")["detail"] == "98, 99"


def test_orders_and_cross_table(spark):
    t = tables(spark)
    clean = status(quality.dq_orders(t["orders"], t["users"], t["sessions"]))
    assert len(clean) == 16
    # One refund for four sales stays under the limit.
    assert {s for s, _ in clean.values()} == {"PASS"}
    rows = [
        order("o1", "u1", "s1", at(1), "0.00"), order("o1", "ghost", "s1", at(1), "20000.00"),
        order("o3", "u1", "lost", at(1), "5.00", "unknown"),
        order("o4", "u1", None, at(1), "5.00", "completed", True, "cash"),
    ]
    broken = tables(spark, orders=rows)
    found = status(quality.dq_orders(broken["orders"], t["users"], t["sessions"]))
    assert found["order_value_positive"] == ("FAIL", 1)
    assert found["order_value_sanity"] == ("WARN", 1)
    assert found["valid_payment_method"] == ("FAIL", 1)
    assert found["valid_payment_status"] == ("FAIL", 1)
    assert found["refund_rate_sanity"] == ("WARN", 1)
    assert found["unique_order_id"] == ("FAIL", 1)
    assert found["no_orphan_orders_user"] == ("FAIL", 1)
    assert found["no_orphan_orders_session"] == ("FAIL", 2)
    assert found["no_nulls_session_id"] == ("FAIL", 1)
    cross = status(quality.dq_cross_table(broken))
    assert cross["orders_user_fk"] == ("FAIL", 1) and cross["events_user_fk"] == ("PASS", 0)
    overall = quality.dq_overall(quality.dq_all(broken))
    assert one(overall, table_name="orders")["is_valid"] is False
    assert one(overall, table_name="users")["is_valid"] is True
    assert one(overall, table_name="ALL")["checks_failed"] >= 7


def test_constraints(spark):
    rows = {
        "users": ROWS["users"] + [user("u1"), user("u9", country=77, kind="robot")],
        "orders": [order("o1", "u1", "s1", at(1), "-1.00"), order("o2", "gone", None, at(1), "1.00")],
        "experiments": ROWS["experiments"] + [
            ("x99", "A", "control", "u1", dt.datetime(2019, 1, 1), False)],
    }
    t = tables(spark, **rows)
    checks = {(r.table_name, r.constraint_name): r.violations
              for r in constraints.constraint_check(t).collect()}
    assert checks["users", "customer_type_allowed"] == 1
    assert checks["orders", "order_value_positive"] == 1
    assert checks["experiments", "assignment_since_2020"] == 1
    assert checks["event_types", "funnel_step_range"] == 0
    unique = {(r.table_name, r.key_columns): r.duplicate_rows for r in constraints.unique_check(t).collect()}
    assert len(unique) == 19
    assert unique["users", "user_id"] == 1
    assert unique["experiments", "user_id, experiment_name"] == 1
    fks = {(r.child_table, r.child_column): r.orphan_rows for r in constraints.fk_check(t).collect()}
    assert len(fks) == 16
    assert fks["users", "country_id"] == 1
    # A NULL key passes, an unknown one does not.
    assert fks["orders", "user_id"] == 1 and fks["orders", "session_id"] == 0


def test_schema_contract(spark):
    t = tables(spark)
    issues = constraints.schema_check(t)
    assert issues.count() == 0
    users = t["users"].withColumn("country_id", t["users"].country_id.cast("string"))
    users = users.na.replace("2", "two", "country_id").drop("is_returning")
    bad = t.replacing(
        users=users,
        orders=tables(spark, orders=[order("o1", None, "s1", at(1), "-3.00", "odd")])["orders"],
        sessions=t["sessions"].where("1 = 0"),
    )
    found = {(r.table_name, r.column_name, r.check_name): (r.severity, r.violations, r.sample)
             for r in constraints.schema_check(bad).collect()}
    assert found == {
        ("users", "is_returning", "column_present"): ("ERROR", 1, None),
        ("users", "country_id", "numeric"): ("ERROR", 1, None),
        ("orders", "user_id", "not_null"): ("ERROR", 1, None),
        ("orders", "order_value", "not_negative"): ("WARNING", 1, None),
        ("orders", "payment_status", "allowed_values"): ("ERROR", 1, "odd"),
        ("sessions", None, "not_empty"): ("ERROR", 1, None),
    }
    with pytest.raises(constraints.SchemaViolation, match="orders.user_id"):
        constraints.assert_schema(bad)
    assert constraints.assert_schema(t).count() == 0


def test_guards(spark):
    df = tables(spark)["users"]
    assert_columns_exist(df, ["user_id"])
    assert_not_empty(df)
    with pytest.raises(ValueError, match="missing columns in here: \\['nope'\\]"):
        assert_columns_exist(df, ["nope", "user_id"], "here")
    with pytest.raises(ValueError, match="no rows in here"):
        assert_not_empty(df.where("1 = 0"), "here")
