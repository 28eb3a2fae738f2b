"""Canonical experiment tables derived from a sales warehouse (customers, orders, events).

All rules are per-row integer arithmetic, so the derivation is deterministic and needs no
shuffle except for sessions, which are computed from the events.  The files' schemas are
declared, so loading runs no job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialscope import schemas as S
from trialscope.operators.sessions import sessionize, with_session_id
from trialscope.sources.lookups import literal_rows
from trialscope.sources.tables import Tables

GAP_MINUTES = 240

SOURCE_DDL = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}

# Market segments in channel-id order, and payment method by order priority.
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
PAYMENT_BY_PRIORITY = (
    ("1-URGENT", "credit_card"),
    ("2-HIGH", "debit_card"),
    ("3-MEDIUM", "paypal"),
    ("4-NOT SPECIFIED", "apple_pay"),
    ("5-LOW", "google_pay"),
)
# Event names by raw type as (k below, name) steps; the last step takes the rest.
EVENT_NAMES = {
    "view": ((20, "page_view"), (100, "scroll")),
    "click": ((10, "product_view"), (100, "click")),
    "signup": ((5, "add_to_cart"), (8, "checkout_start"), (100, "wishlist_add")),
    "purchase": ((2, "purchase"), (100, "coupon_applied")),
    "error": ((100, "purchase_failed"),),
}


def _case(subject: str, pairs, otherwise: str = "NULL") -> str:
    branches = " ".join(f"WHEN '{key}' THEN {result}" for key, result in pairs)
    return f"CASE {subject} {branches} ELSE {otherwise} END"


def _by_event(result, otherwise: str) -> str:
    """A CASE over raw type and k; nested, so that few branches look at k."""
    branches = []
    for kind, steps in EVENT_NAMES.items():
        *early, (_, rest) = steps
        inner = " ".join(f"WHEN k < {below} THEN {result(name)}" for below, name in early)
        branches.append(
            (kind, f"CASE {inner} ELSE {result(rest)} END" if early else result(rest))
        )
    return _case("event_type", branches, otherwise)


def source(spark: SparkSession, path: str, table: str) -> DataFrame:
    return spark.read.schema(SOURCE_DDL[table]).parquet(f"{path}/{table}.parquet")


def raw_events(spark: SparkSession, path: str) -> DataFrame:
    """Events in canonical columns, before sessions are attached."""
    return (
        source(spark, path, "events")
        .selectExpr("*", "CAST(get_json_object(props, '$.k') AS INT) AS k")
        .selectExpr(
            "event_id",
            "user_id",
            "IF(event_id % 10 <> 0, user_id * 2, NULL) AS experiment_id",
            # A raw type without a name gets 0, which no event type has; as the id is never NULL,
            # joins on it need no filter that would look into props once more.
            _by_event(lambda name: str(S.event_type_id(name)), "0") + " AS event_type_id",
            "ts AS event_timestamp",
            _by_event(lambda name: "NULL" if name == "purchase_failed" else f"'/{name}'", "NULL")
            + " AS page_url",
            "CAST(IF(event_type = 'purchase', value, NULL) AS DECIMAL(12,4)) AS revenue",
            "user_id % 3 = 1 AS is_mobile",
        )
    )


def _users(spark: SparkSession, path: str) -> DataFrame:
    channel = _case("c_mktsegment", [(s, i) for i, s in enumerate(SEGMENTS, 1)])
    return source(spark, path, "customer").selectExpr(
        "c_custkey AS user_id",
        "date_add(date'2023-07-05', CAST(c_custkey % 180 AS INT)) AS signup_date",
        "c_nationkey AS country_id",
        "CAST(c_custkey % 3 + 1 AS INT) AS device_id",
        "CAST(c_custkey % 6 + 1 AS INT) AS browser_id",
        f"{channel} AS channel_id",
        "CASE WHEN c_acctbal < 4000 THEN 'new' WHEN c_acctbal < 8000 THEN 'returning' "
        "ELSE 'high_value' END AS customer_type",
        "elt(CAST(c_custkey % 4 + 1 AS INT), 'Windows', 'macOS', 'iOS', 'Android') "
        "AS operating_system",
        "c_acctbal >= 4000 AS is_returning",
    )


def experiments_of(customers: DataFrame) -> DataFrame:
    """Assignments of customers to two experiments; per row, so it also runs on a stream."""
    return (
        customers.selectExpr(
            "c_custkey",
            "inline(array(struct(0 AS n, 'checkout_redesign' AS name, 500 AS cut), "
            "struct(1 AS n, 'pricing_test' AS name, 420 AS cut)))",
        )
        .where("n = 0 OR c_custkey % 3 <> 0")
        .selectExpr(
            "c_custkey * 2 + n AS experiment_id",
            "name AS experiment_name",
            "IF((c_custkey * 7919 + n * 104729) % 1000 < cut, 'variant', 'control') AS variant",
            "c_custkey AS user_id",
            "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval("
            "CAST(c_custkey % 14 AS INT), CAST(c_custkey % 24 AS INT)) AS assignment_timestamp",
            "(c_custkey * 31 + 7) % 50 = 0 AS is_holdout",
        )
    )


def _sessions(t: Tables) -> DataFrame:
    return sessionize(t["raw_events"], GAP_MINUTES).selectExpr(
        "session_id",
        "user_id",
        "session_start",
        "session_end",
        "duration_seconds",
        "CAST(user_id % 3 + 1 AS INT) AS device_id",
        "CAST(user_id % 6 + 1 AS INT) AS browser_id",
        "page_count",
        "is_bounce",
    )


def _orders(spark: SparkSession, path: str, t: Tables) -> DataFrame:
    """Orders with the first session of their user; a query that does not read it does not join."""
    first_session = (
        t["sessions"]
        .groupBy(F.col("user_id").alias("_user"))
        .agg(F.min_by("session_id", "session_start").alias("session_id"))
    )
    orders = source(spark, path, "orders").join(
        first_session, F.expr("o_custkey = _user"), "left"
    )
    method = _case("o_orderpriority", [(p, f"'{m}'") for p, m in PAYMENT_BY_PRIORITY])
    return orders.selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS user_id",
        "session_id",
        "CAST(NULL AS BIGINT) AS event_id",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval("
        "CAST(datediff(o_orderdate, date'1995-01-01') % 30 AS INT), "
        "CAST(o_orderkey % 24 AS INT)) AS order_timestamp",
        "CAST(CAST(CAST(round(o_totalprice * 100) AS BIGINT) % 120000 + 100 "
        "AS DECIMAL(10,0)) * 0.01BD AS DECIMAL(12,2)) AS order_value",
        f"{method} AS payment_method",
        "o_orderkey * 7 % 20 = 1 AS is_refund",
        "CASE o_orderkey * 7 % 20 WHEN 0 THEN 'completed' WHEN 1 THEN 'refunded' "
        "WHEN 2 THEN 'failed' ELSE 'pending' END AS payment_status",
    )


def load(spark: SparkSession, path: str) -> Tables:
    """The eleven canonical tables over a folder of warehouse Parquet files."""
    return Tables(
        {
            "regions": lambda t: source(spark, path, "region").selectExpr(
                "r_regionkey AS region_id", "r_name AS region_name"
            ),
            "countries": lambda t: source(spark, path, "nation").selectExpr(
                "n_nationkey AS country_id",
                "lpad(CAST(n_nationkey AS STRING), 2, '0') AS country_code",
                "n_name AS country_name",
                "n_regionkey AS region_id",
            ),
            "devices": lambda t: literal_rows(
                spark, S.TABLE_DDL["devices"], enumerate(S.DEVICE_TYPES, 1)
            ),
            "browsers": lambda t: literal_rows(
                spark, S.TABLE_DDL["browsers"], enumerate(S.BROWSER_NAMES, 1)
            ),
            "acquisition_channels": lambda t: literal_rows(
                spark, S.TABLE_DDL["acquisition_channels"], enumerate(SEGMENTS, 1)
            ),
            "event_types": lambda t: literal_rows(
                spark,
                S.TABLE_DDL["event_types"],
                [(i, *row) for i, row in enumerate(S.EVENT_TYPE_ROWS, 1)],
            ),
            "users": lambda t: _users(spark, path),
            "experiments": lambda t: experiments_of(source(spark, path, "customer")),
            "raw_events": lambda t: raw_events(spark, path),
            "sessions": _sessions,
            "events": lambda t: with_session_id(t["raw_events"], GAP_MINUTES).select(
                "event_id", "session_id", "user_id", "experiment_id", "event_type_id",
                "event_timestamp", "page_url", "revenue", "is_mobile",
            ),
            "orders": lambda t: _orders(spark, path, t),
        }
    )
