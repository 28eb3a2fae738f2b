"""Small hand-written tables with string ids, as a loaded warehouse would have them."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import SparkSession

from trialscope import schemas as S
from trialscope.sources.tables import Tables

UTC = dt.timezone.utc


def at(day: int, hour: int = 0, minute: int = 0) -> dt.datetime:
    return dt.datetime(2024, 1, day, hour, minute, tzinfo=UTC)


LOOKUPS = {
    "regions": [(1, "North"), (2, "South")],
    "countries": [(1, "AA", "Alfa", 1), (2, "BB", "Bravo", 2)],
    "devices": [(1, "desktop"), (2, "mobile")],
    "browsers": [(1, "Chrome")],
    "acquisition_channels": [(1, "email"), (2, "direct")],
    "event_types": [(i, *row) for i, row in enumerate(S.EVENT_TYPE_ROWS, 1)],
}


def user(uid, country=1, device=1, channel=1, kind="new"):
    return (uid, dt.date(2023, 12, 1), country, device, 1, channel, kind, None, kind != "new")


def assignment(xid, name, arm, uid, day=1, holdout=False):
    return (xid, name, arm, uid, at(day), holdout)


def session(sid, uid, start, end, pages=2, bounce=False):
    return (sid, uid, start, end, int((end - start).total_seconds()), 1, 1, pages, bounce)


def event(eid, sid, uid, name, ts, revenue=None, xid=None):
    money = None if revenue is None else Decimal(str(revenue))
    return (eid, sid, uid, xid, S.event_type_id(name), ts, None, money, False)


def order(oid, uid, sid, ts, value, status="completed", refund=False, method="paypal"):
    return (oid, uid, sid, None, ts, Decimal(str(value)), method, refund, status)


ROWS = {
    **LOOKUPS,
    "users": [
        user("u1"), user("u2", country=2), user("u3", device=2, kind="returning"),
        user("u4", channel=2, kind="high_value"), user("u5"), user("u6"),
    ],
    "experiments": [
        assignment("x1", "A", "control", "u1", 1),
        assignment("x2", "A", "variant", "u2", 1),
        assignment("x3", "A", "control", "u3", 3),
        assignment("x4", "A", "variant", "u4", 3),
        assignment("x5", "A", "control", "u5", 1, holdout=True),
        assignment("x6", "B", "control", "u1", 2),
        assignment("x7", "only_holdout", "control", "u6", 1, holdout=True),
    ],
    "sessions": [
        session("s1", "u1", at(1, 10), at(1, 11), 3),
        session("s2", "u2", at(1, 9), at(1, 9), 1, True),
        session("s3", "u2", at(2, 9), at(2, 10), 2),
        session("s4", "u4", at(3, 9), at(3, 12), 5),
    ],
    "events": [
        event("e1", "s1", "u1", "page_view", at(1, 10)),
        event("e2", "s1", "u1", "purchase", at(1, 11), 20),
        event("e3", "s2", "u2", "page_view", at(1, 9)),
        event("e4", "s3", "u2", "product_view", at(2, 9)),
        event("e5", "s4", "u4", "checkout_start", at(3, 10)),
        event("e6", "s4", "u4", "purchase", at(3, 11), None),
        event("e7", "s4", "u4", "scroll", at(3, 12)),
    ],
    "orders": [
        order("o1", "u1", "s1", at(1, 11), "20.00"),
        order("o2", "u1", "s1", at(2, 11), "30.00"),
        order("o3", "u2", "s2", at(1, 9), "10.00", "refunded", True),
        order("o4", "u4", "s4", at(3, 11), "250.00"),
        order("o5", "u4", "s4", at(3, 11), "5.00", "failed"),
        order("o6", "u5", "s1", at(1, 11), "99.00"),
    ],
}


def tables(spark: SparkSession, **changed) -> Tables:
    rows = {**ROWS, **changed}
    return Tables(
        {name: spark.createDataFrame(values, S.TABLE_DDL[name]) for name, values in rows.items()}
    )


def one(df, **where):
    """The single row with the given values, as a dict."""
    rows = [r.asDict() for r in df.collect()]
    found = [r for r in rows if all(r[k] == v for k, v in where.items())]
    assert len(found) == 1, (where, rows)
    return found[0]
