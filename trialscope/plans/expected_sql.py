"""What each named query must return, as SQL over the same warehouse files.

The statements say the meaning directly (plain joins, distinct counts, sorted percentiles); they
share no plan with the Spark operators.  Named building blocks are put in front of a statement
as common table expressions, as far as it needs them.
"""

from __future__ import annotations

import re
from statistics import NormalDist

from trialscope import schemas as S
from trialscope.functions import distributions as D
from trialscope.operators import quality as Q
from trialscope.operators.reports import COMPLETENESS_KEYS
from trialscope.operators.segments import REPORT_NAMES
from trialscope.sources import warehouse as W

BLOCKS: dict[str, str] = {}
EXPECTED_SQL: dict[str, str] = {}


def _quoted(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def _literal(v) -> str:
    return "NULL" if v is None else (str(v) if isinstance(v, int) else _quoted([v]))


def _values(rows, columns: str) -> str:
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS v({columns})"


def _with_blocks(statement: str) -> str:
    """Prefix a statement with the blocks it uses, directly or through other blocks."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in BLOCKS:
            if name not in order and re.search(rf"\b{name}\b", text):
                # A recursive block names itself.
                visit(re.sub(rf"\b{name}\b", "", BLOCKS[name]))
                order.append(name)

    visit(statement)
    if not order:
        return statement
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({BLOCKS[n]})" for n in order) + "\n" + statement


def expect(name: str, statement: str) -> None:
    EXPECTED_SQL[name] = _with_blocks(statement)


def r9(expression: str, alias: str) -> str:
    return f"round({expression}, 9) AS {alias}"


def div(a: str, b: str) -> str:
    """a / b as double, NULL for b = 0."""
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


def div0(a: str, b: str) -> str:
    """a / b as double, 0 for b = 0."""
    return f"(CASE WHEN ({b}) = 0 THEN 0.0 ELSE {div(a, b)} END)"


def money(x: str) -> str:
    return f"CAST({x} AS DECIMAL(38,2))"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def half_up(a: str, b: str, places: int) -> str:
    """Quotient of non-negative integers, ties upwards."""
    scale = 10**places
    return f"(CAST((({a}) * {2 * scale} + ({b})) // (2 * ({b})) AS DOUBLE) / {float(scale)})"


# --- canonical tables ---------------------------------------------------------------------

BLOCKS["c_regions"] = "SELECT r_regionkey AS region_id, r_name AS region_name FROM region"
BLOCKS["c_countries"] = """
SELECT n_nationkey AS country_id, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS country_code,
       n_name AS country_name, n_regionkey AS region_id FROM nation"""
BLOCKS["c_devices"] = _values(enumerate(S.DEVICE_TYPES, 1), "device_id, device_type")
BLOCKS["c_browsers"] = _values(enumerate(S.BROWSER_NAMES, 1), "browser_id, browser_name")
BLOCKS["c_channels"] = _values(enumerate(W.SEGMENTS, 1), "channel_id, channel_name")
BLOCKS["c_event_types"] = _values(
    [(i, *row) for i, row in enumerate(S.EVENT_TYPE_ROWS, 1)],
    "event_type_id, event_name, event_category, funnel_step",
)
BLOCKS["c_users"] = """
SELECT c_custkey AS user_id, date '2023-07-05' + CAST(c_custkey % 180 AS INTEGER) AS signup_date,
       c_nationkey AS country_id, CAST(c_custkey % 3 + 1 AS INTEGER) AS device_id,
       CAST(c_custkey % 6 + 1 AS INTEGER) AS browser_id, channel_id,
       CASE WHEN c_acctbal < 4000 THEN 'new' WHEN c_acctbal < 8000 THEN 'returning'
            ELSE 'high_value' END AS customer_type,
       ['Windows', 'macOS', 'iOS', 'Android'][c_custkey % 4 + 1] AS operating_system,
       c_acctbal >= 4000 AS is_returning
FROM customer LEFT JOIN c_channels ON channel_name = c_mktsegment"""
BLOCKS["c_experiments"] = """
SELECT c_custkey * 2 + n AS experiment_id, name AS experiment_name,
       CASE WHEN (c_custkey * 7919 + n * 104729) % 1000 < cut THEN 'variant' ELSE 'control' END
         AS variant,
       c_custkey AS user_id,
       timestamp '2024-01-01' + to_days(CAST(c_custkey % 14 AS INTEGER)) + to_hours(c_custkey % 24)
         AS assignment_timestamp,
       (c_custkey * 31 + 7) % 50 = 0 AS is_holdout
FROM customer,
     (VALUES (0, 'checkout_redesign', 500), (1, 'pricing_test', 420)) AS plan(n, name, cut)
WHERE n = 0 OR c_custkey % 3 <> 0"""
BLOCKS["c_named_events"] = """
SELECT *, CASE event_type
    WHEN 'view' THEN if(k < 20, 'page_view', 'scroll')
    WHEN 'click' THEN if(k < 10, 'product_view', 'click')
    WHEN 'signup' THEN CASE WHEN k < 5 THEN 'add_to_cart' WHEN k < 8 THEN 'checkout_start'
                            ELSE 'wishlist_add' END
    WHEN 'purchase' THEN if(k < 2, 'purchase', 'coupon_applied')
    WHEN 'error' THEN 'purchase_failed' END AS event_name
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"""
# Sessions: a session opens when the user's previous event is more than four hours back.
BLOCKS["c_opened"] = """
SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
                    <= INTERVAL 240 MINUTE THEN 0 ELSE 1 END AS opens
FROM c_named_events"""
BLOCKS["c_numbered"] = """
SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session_no
FROM c_opened"""
BLOCKS["c_events"] = """
SELECT event_id, min(event_id) OVER (PARTITION BY user_id, session_no) AS session_id, user_id,
       CASE WHEN event_id % 10 <> 0 THEN user_id * 2 END AS experiment_id,
       event_type_id, ts AS event_timestamp,
       CASE WHEN event_type <> 'error' THEN '/' || event_name END AS page_url,
       CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(12,4)) END AS revenue,
       user_id % 3 = 1 AS is_mobile
FROM c_numbered LEFT JOIN c_event_types USING (event_name)"""
BLOCKS["c_sessions"] = """
SELECT session_id, user_id, min(event_timestamp) AS session_start,
       max(event_timestamp) AS session_end,
       CAST((epoch_us(max(event_timestamp)) - epoch_us(min(event_timestamp))) // 1000000
            AS INTEGER) AS duration_seconds,
       CAST(user_id % 3 + 1 AS INTEGER) AS device_id,
       CAST(user_id % 6 + 1 AS INTEGER) AS browser_id,
       CAST(count(*) AS INTEGER) AS page_count, count(*) = 1 AS is_bounce
FROM c_events GROUP BY session_id, user_id"""
BLOCKS["c_orders"] = f"""
SELECT o_orderkey AS order_id, o_custkey AS user_id, first_session AS session_id,
       CAST(NULL AS BIGINT) AS event_id,
       timestamp '2024-01-01'
         + to_days(CAST((CAST(o_orderdate AS DATE) - date '1995-01-01') % 30 AS INTEGER))
         + to_hours(o_orderkey % 24) AS order_timestamp,
       CAST((CAST(round(o_totalprice * 100) AS BIGINT) % 120000 + 100) * 0.01 AS DECIMAL(12,2))
         AS order_value,
       CASE o_orderpriority {" ".join(f"WHEN '{p}' THEN '{m}'" for p, m in W.PAYMENT_BY_PRIORITY)}
         END AS payment_method,
       o_orderkey * 7 % 20 = 1 AS is_refund,
       CASE o_orderkey * 7 % 20 WHEN 0 THEN 'completed' WHEN 1 THEN 'refunded'
            WHEN 2 THEN 'failed' ELSE 'pending' END AS payment_status
FROM orders LEFT JOIN (SELECT user_id AS u, arg_min(session_id, session_start) AS first_session
                       FROM c_sessions GROUP BY user_id) ON u = o_custkey"""

CANONICAL = {
    "regions": "c_regions",
    "countries": "c_countries",
    "devices": "c_devices",
    "browsers": "c_browsers",
    "acquisition_channels": "c_channels",
    "event_types": "c_event_types",
    "users": "c_users",
    "experiments": "c_experiments",
    "sessions": "c_sessions",
    "events": "c_events",
    "orders": "c_orders",
}

BLOCKS["x_active"] = "SELECT * FROM c_experiments WHERE NOT is_holdout"
BLOCKS["x_sales"] = "SELECT * FROM c_orders WHERE payment_status = 'completed' AND NOT is_refund"
BLOCKS["x_arm_sales"] = """
SELECT experiment_name, variant, s.* FROM x_active JOIN x_sales s USING (user_id)"""
BLOCKS["x_profiles"] = """
SELECT user_id, device_type, country_name, country_code, region_name, channel_name, customer_type
FROM c_users JOIN c_devices USING (device_id) JOIN c_countries USING (country_id)
     JOIN c_regions USING (region_id) JOIN c_channels USING (channel_id)"""

# --- views --------------------------------------------------------------------------------

BLOCKS["v_summary"] = f"""
SELECT experiment_name, variant, total_users, coalesce(buyers, 0) AS purchasers,
       {money("coalesce(revenue, 0)")} AS total_revenue, coalesce(n_orders, 0) AS total_orders,
       {div0("coalesce(buyers, 0)", "total_users")} AS conversion_rate,
       {div0("coalesce(revenue, 0)", "total_users")} AS revenue_per_visitor,
       {div0("coalesce(revenue, 0)", "coalesce(n_orders, 0)")} AS average_order_value,
       experiment_start, experiment_end
FROM (SELECT experiment_name, variant, count(DISTINCT user_id) AS total_users,
             min(assignment_timestamp) AS experiment_start,
             max(assignment_timestamp) AS experiment_end
      FROM x_active GROUP BY ALL)
LEFT JOIN (SELECT experiment_name, variant, count(DISTINCT user_id) AS buyers,
                  sum(order_value) AS revenue, count(DISTINCT order_id) AS n_orders
           FROM x_arm_sales GROUP BY ALL) USING (experiment_name, variant)"""
BLOCKS["v_daily"] = f"""
SELECT *, {div0("cumulative_purchasers", "cumulative_users")} AS cumulative_conversion_rate
FROM (
  SELECT metric_date, experiment_name, variant, users_assigned,
         coalesce(buyers, 0) AS purchasing_users, coalesce(n_orders, 0) AS order_count,
         {money("coalesce(revenue, 0)")} AS daily_revenue,
         {div0("coalesce(buyers, 0)", "users_assigned")} AS daily_conversion_rate,
         {div0("coalesce(revenue, 0)", "users_assigned")} AS daily_revenue_per_visitor,
         {big("sum(users_assigned) OVER upto")} AS cumulative_users,
         {big("sum(coalesce(buyers, 0)) OVER upto")} AS cumulative_purchasers,
         {div("sum(coalesce(buyers, 0)) OVER seven", "sum(users_assigned) OVER seven")}
           AS rolling_7d_conversion_rate
  FROM (SELECT CAST(assignment_timestamp AS DATE) AS metric_date, experiment_name, variant,
               count(DISTINCT user_id) AS users_assigned FROM x_active GROUP BY ALL)
  LEFT JOIN (SELECT CAST(order_timestamp AS DATE) AS metric_date, experiment_name, variant,
                    count(DISTINCT user_id) AS buyers, count(DISTINCT order_id) AS n_orders,
                    sum(order_value) AS revenue
             FROM x_arm_sales GROUP BY ALL) USING (metric_date, experiment_name, variant)
  WINDOW upto AS (PARTITION BY experiment_name, variant ORDER BY metric_date
                  ROWS UNBOUNDED PRECEDING),
         seven AS (PARTITION BY experiment_name, variant ORDER BY metric_date
                   ROWS 6 PRECEDING))"""
_REACHED = ",\n       ".join(
    f"count(DISTINCT user_id) FILTER (event_name = '{event}') AS {column}"
    for _, _, column, event in S.FUNNEL_STEPS
)
BLOCKS["v_funnel"] = f"""
SELECT *, {div0("product_users", "landing_users")} AS landing_to_product_rate,
       {div0("cart_users", "product_users")} AS product_to_cart_rate,
       {div0("checkout_users", "cart_users")} AS cart_to_checkout_rate,
       {div0("purchase_users", "checkout_users")} AS checkout_to_purchase_rate,
       {div0("purchase_users", "total_users")} AS overall_funnel_rate
FROM (SELECT experiment_name, variant, count(DISTINCT user_id) AS total_users,
       {_REACHED}
      FROM x_active LEFT JOIN (SELECT s.user_id, event_name FROM c_events e
                               JOIN c_sessions s ON s.session_id = e.session_id
                               JOIN c_event_types USING (event_type_id)
                               WHERE funnel_step IS NOT NULL) USING (user_id)
      GROUP BY experiment_name, variant)"""
BLOCKS["v_sessions"] = f"""
SELECT experiment_name, variant, n AS total_sessions, users AS unique_users,
       {half_up("seconds", "n", 2)} AS avg_session_duration_seconds,
       round(p50, 2) AS median_session_duration_seconds,
       {half_up("pages", "n", 2)} AS avg_pages_per_session,
       {half_up("bounces", "n", 4)} AS bounce_rate, bounces AS bounced_sessions,
       {half_up("users", "n", 3)} AS sessions_per_user,
       {half_up("n", "users", 3)} AS avg_sessions_per_user,
       p25 AS p25_duration_seconds, p75 AS p75_duration_seconds, p95 AS p95_duration_seconds
FROM (SELECT experiment_name, variant, count(*) AS n, count(DISTINCT user_id) AS users,
             sum(duration_seconds) AS seconds, sum(page_count) AS pages,
             count(*) FILTER (is_bounce) AS bounces,
             quantile_cont(duration_seconds, 0.5) AS p50,
             quantile_cont(duration_seconds, 0.25) AS p25,
             quantile_cont(duration_seconds, 0.75) AS p75,
             quantile_cont(duration_seconds, 0.95) AS p95
      FROM x_active JOIN c_sessions USING (user_id) GROUP BY ALL)"""
_SEGMENT = "device_type, country_name, country_code, region_name, channel_name, customer_type"
BLOCKS["x_segment_users"] = f"""
SELECT experiment_name, variant, user_id, {_SEGMENT},
       user_id IN (SELECT user_id FROM x_sales) AS bought
FROM x_active JOIN x_profiles USING (user_id)"""


def _rates_by(columns: str, source: str = "x_segment_users") -> str:
    return f"""SELECT {columns}, count(DISTINCT user_id) AS total_users,
       count(DISTINCT user_id) FILTER (bought) AS purchasers,
       {div0("count(DISTINCT user_id) FILTER (bought)", "count(DISTINCT user_id)")}
         AS conversion_rate
FROM {source} GROUP BY {columns}"""


BLOCKS["v_segments"] = _rates_by(f"experiment_name, variant, {_SEGMENT}")
_SALE = "payment_status = 'completed' AND NOT is_refund"
BLOCKS["v_revenue"] = f"""
SELECT experiment_name, variant, total_users, {money("gross")} AS gross_revenue,
       {money("refunded")} AS refunded_revenue,
       {money("gross - coalesce(refunded, 0)")} AS net_revenue,
       done AS completed_orders, undone AS refunded_orders, failed AS failed_orders,
       {div0("gross", "total_users")} AS revenue_per_visitor,
       {div0("gross", "done")} AS average_order_value, {div0("undone", "done")} AS refund_rate
FROM (SELECT experiment_name, variant, sum(order_value) FILTER ({_SALE}) AS gross,
             sum(order_value) FILTER (is_refund) AS refunded,
             count(DISTINCT order_id) FILTER ({_SALE}) AS done,
             count(DISTINCT order_id) FILTER (is_refund) AS undone,
             count(DISTINCT order_id) FILTER (payment_status = 'failed') AS failed
      FROM x_active JOIN c_orders USING (user_id) GROUP BY ALL)
JOIN (SELECT experiment_name, variant, count(DISTINCT user_id) AS total_users
      FROM x_active GROUP BY ALL) USING (experiment_name, variant)"""
BLOCKS["v_user_level"] = f"""
SELECT a.user_id, experiment_name, variant, assignment_timestamp,
       CAST(assignment_timestamp AS DATE) AS assignment_date, customer_type, device_type,
       country_name, country_code, region_name, channel_name,
       coalesce(bought, false) AS made_purchase, coalesce(n_orders, 0) AS order_count,
       {money("coalesce(revenue, 0)")} AS total_revenue, last_purchase_date,
       coalesce(n_sessions, 0) AS session_count,
       coalesce({div("seconds", "n_sessions")}, 0.0) AS avg_session_duration_seconds,
       coalesce({div("pages", "n_sessions")}, 0.0) AS avg_page_count,
       coalesce({div("bounces", "n_sessions")}, 0.0) AS bounce_rate
FROM x_active a JOIN x_profiles USING (user_id)
LEFT JOIN (SELECT user_id, bool_or({_SALE}) AS bought, count(*) FILTER ({_SALE}) AS n_orders,
                  sum(order_value) FILTER ({_SALE}) AS revenue,
                  max(order_timestamp) AS last_purchase_date
           FROM c_orders GROUP BY user_id) USING (user_id)
LEFT JOIN (SELECT user_id, count(*) AS n_sessions, sum(duration_seconds) AS seconds,
                  sum(page_count) AS pages, count(*) FILTER (is_bounce) AS bounces
           FROM c_sessions GROUP BY user_id) USING (user_id)"""


def _round_all(source: str, doubles: str) -> str:
    names = doubles.split()
    swaps = ", ".join(r9(n, n) for n in names)
    return f"SELECT * REPLACE ({swaps}) FROM {source}"


expect(
    "experiment_summary",
    _round_all("v_summary", "conversion_rate revenue_per_visitor average_order_value"),
)
_DAILY_DOUBLES = "daily_conversion_rate daily_revenue_per_visitor rolling_7d_conversion_rate"
expect(
    "daily_metrics_view",
    _round_all("(SELECT * EXCLUDE (cumulative_conversion_rate) FROM v_daily)", _DAILY_DOUBLES),
)
expect(
    "mv_daily_conversion", _round_all("v_daily", _DAILY_DOUBLES + " cumulative_conversion_rate")
)
expect(
    "funnel_steps_view",
    _round_all(
        "v_funnel",
        "landing_to_product_rate product_to_cart_rate cart_to_checkout_rate "
        "checkout_to_purchase_rate overall_funnel_rate",
    ),
)
expect(
    "session_metrics_view",
    _round_all("v_sessions", "p25_duration_seconds p75_duration_seconds p95_duration_seconds"),
)
expect("segment_conversion", _round_all("v_segments", "conversion_rate"))
_REVENUE_DOUBLES = "revenue_per_visitor average_order_value refund_rate"
expect("revenue_summary", _round_all("v_revenue", _REVENUE_DOUBLES))
_USER_DOUBLES = "avg_session_duration_seconds avg_page_count bounce_rate"
expect("mv_user_experiment_summary", _round_all("v_user_level", _USER_DOUBLES))

# --- reports ------------------------------------------------------------------------------


def _versus_control(rate: str) -> str:
    return (
        f"CASE WHEN variant = 'control' THEN 0.0 "
        f"ELSE ({rate} - base) / nullif(base, 0) END"
    )


expect(
    "conversion_metrics",
    f"""SELECT experiment_name, variant, total_users, purchasers, {r9("conversion_rate", "conversion_rate")},
       total_revenue, total_orders,
       {r9("CASE WHEN variant = 'control' THEN 0.0 ELSE conversion_rate - base END", "lift_absolute")},
       {r9(_versus_control("conversion_rate"), "lift_relative")}
FROM v_summary LEFT JOIN (SELECT experiment_name, conversion_rate AS base FROM v_summary
                          WHERE variant = 'control') USING (experiment_name)""",
)
expect(
    "daily_metrics",
    f"""SELECT metric_date, experiment_name, variant, users_assigned AS daily_users,
       purchasing_users AS daily_conversions, {r9("daily_conversion_rate", "daily_conversion_rate")},
       cumulative_users, cumulative_purchasers AS cumulative_conversions,
       {r9("cumulative_conversion_rate", "cumulative_conversion_rate")},
       {r9("rolling_7d_conversion_rate", "rolling_7d_conversion_rate")}, daily_revenue,
       {money("sum(daily_revenue) OVER (arm ROWS UNBOUNDED PRECEDING)")} AS cumulative_revenue,
       {r9("daily_conversion_rate - lag(daily_conversion_rate) OVER arm", "dod_conversion_change")}
FROM v_daily WINDOW arm AS (PARTITION BY experiment_name, variant ORDER BY metric_date)""",
)
expect(
    "session_metrics",
    f"""SELECT experiment_name, variant, total_sessions, unique_users,
       avg_session_duration_seconds AS avg_session_duration,
       median_session_duration_seconds AS median_session_duration,
       {r9("p75_duration_seconds", "p75_session_duration")}, avg_pages_per_session, bounce_rate,
       bounced_sessions, sessions_per_user FROM v_sessions""",
)
BLOCKS["x_steps"] = " UNION ALL ".join(
    f"SELECT experiment_name, variant, total_users, {order} AS step_order, "
    f"'{label}' AS step_name, {column} AS reached FROM v_funnel"
    for order, label, column, _ in S.FUNNEL_STEPS
)
BLOCKS["v_steps"] = f"""
SELECT experiment_name, variant, step_name, step_order, reached AS users_reached,
       entering AS users_at_step, {div0("reached", "entering")} AS step_conversion_rate,
       {div0("reached", "total_users")} AS cumulative_conversion_rate,
       entering - reached AS drop_off_count, {div0("entering - reached", "entering")} AS drop_off_rate
FROM (SELECT *, coalesce(lag(reached) OVER (PARTITION BY experiment_name, variant
                                            ORDER BY step_order), total_users) AS entering
      FROM x_steps)"""
expect(
    "funnel_steps",
    _round_all("v_steps", "step_conversion_rate cumulative_conversion_rate drop_off_rate"),
)
expect(
    "funnel_completion",
    f"""SELECT experiment_name, step_order, step_name, reached AS variant_users_reached,
       total_users AS variant_total_users, {r9("b", "control_rate")}, {r9("a", "variant_rate")},
       {r9("a - b", "absolute_lift")}, {r9("(a - b) / nullif(b, 0)", "relative_lift")}
FROM (SELECT *, {div0("reached", "total_users")} AS a FROM x_steps WHERE variant = 'variant')
JOIN (SELECT experiment_name, step_order, {div0("reached", "total_users")} AS b FROM x_steps
      WHERE variant = 'control') USING (experiment_name, step_order)""",
)
BLOCKS["x_user_revenue"] = f"""
SELECT experiment_name, variant, user_id, {money("sum(order_value)")} AS revenue
FROM x_arm_sales GROUP BY ALL"""
_PCT = ", ".join(
    f"quantile_cont(CAST(revenue AS DOUBLE), {p}) AS {n}"
    for n, p in (
        ("median_order_value", 0.5), ("p25_order_value", 0.25), ("p75_order_value", 0.75),
        ("p95_order_value", 0.95),
    )
)
expect(
    "revenue_per_visitor",
    _round_all(
        f"""(SELECT experiment_name, variant, total_users, gross_revenue AS total_revenue,
        revenue_per_visitor, average_order_value AS avg_order_value, median_order_value,
        p25_order_value, p75_order_value, p95_order_value, refund_rate
 FROM v_revenue LEFT JOIN (SELECT experiment_name, variant, {_PCT} FROM x_user_revenue
                           GROUP BY ALL) USING (experiment_name, variant))""",
        "revenue_per_visitor avg_order_value median_order_value p25_order_value "
        "p75_order_value p95_order_value refund_rate",
    ),
)
expect(
    "order_analysis",
    f"""SELECT experiment_name, variant, CAST(order_timestamp AS DATE) AS order_date,
       payment_method,
       CASE {" ".join(f"WHEN order_value < {u} THEN '{n}'" for u, n in S.VALUE_BUCKETS if u)}
            ELSE '{S.VALUE_BUCKETS[-1][1]}' END AS order_value_bucket,
       count(*) AS total_orders, {money("sum(order_value)")} AS total_revenue,
       count(*) FILTER (is_refund) AS refunded_orders,
       {money("coalesce(sum(order_value) FILTER (is_refund), 0)")} AS refunded_revenue
FROM x_active JOIN c_orders USING (user_id) WHERE payment_status = 'completed' GROUP BY ALL""",
)
expect(
    "device_segment",
    f"""SELECT * REPLACE ({r9("conversion_rate", "conversion_rate")}),
       rank() OVER (PARTITION BY experiment_name, variant ORDER BY conversion_rate DESC) AS cr_rank
FROM ({_rates_by("experiment_name, device_type, variant")})""",
)
_BY_COUNTRY = _rates_by("experiment_name, country_name, country_code, region_name, variant")
expect(
    "country_segment",
    f"""SELECT m.* REPLACE ({r9("conversion_rate", "conversion_rate")}),
       {r9(_versus_control("conversion_rate"), "lift_vs_control")}
FROM ({_BY_COUNTRY}) m LEFT JOIN (SELECT experiment_name, country_name, conversion_rate AS base
  FROM ({_BY_COUNTRY}) WHERE variant = 'control') USING (experiment_name, country_name)""",
)
expect(
    "channel_segment",
    f"""SELECT experiment_name, channel_name, variant, total_users, purchasers,
       {r9("conversion_rate", "conversion_rate")}, {money("coalesce(revenue, 0)")} AS total_revenue,
       {r9(div0("coalesce(revenue, 0)", "total_users"), "revenue_per_visitor")},
       rank() OVER (PARTITION BY experiment_name, variant ORDER BY conversion_rate DESC) AS cr_rank
FROM ({_rates_by("experiment_name, channel_name, variant")})
LEFT JOIN (SELECT experiment_name, channel_name, variant, sum(order_value) AS revenue
           FROM x_arm_sales JOIN c_users USING (user_id) JOIN c_channels USING (channel_id)
           GROUP BY ALL) USING (experiment_name, channel_name, variant)""",
)
_DAILY_SRM = (
    f"""SELECT metric_date, experiment_name, CAST(0.5 AS DOUBLE) AS expected_variant_fraction,
       {r9(div0("dv", "dc + dv"), "actual_daily_variant_fraction")},
       {r9(div0("cv", "cc + cv"), "actual_cumulative_variant_fraction")},
       dc AS daily_users_control, dv AS daily_users_variant, cc AS cumulative_control,
       cv AS cumulative_variant,
       cc + cv > 1000 AND abs({div0("cv", "cc + cv")} - 0.5) > 0.05 AS srm_warning_flag
FROM (SELECT metric_date, experiment_name,
             {big("coalesce(sum(users_assigned) FILTER (variant = 'control'), 0)")} AS dc,
             {big("coalesce(sum(users_assigned) FILTER (variant = 'variant'), 0)")} AS dv,
             {big("coalesce(sum(cumulative_users) FILTER (variant = 'control'), 0)")} AS cc,
             {big("coalesce(sum(cumulative_users) FILTER (variant = 'variant'), 0)")} AS cv
      FROM v_daily GROUP BY ALL)"""
)
expect("daily_srm_check", _DAILY_SRM)
expect(
    "data_quality_monitor",
    f"""SELECT (SELECT count(*) FROM c_events WHERE experiment_id IS NULL) AS events_without_experiment,
       (SELECT count(*) FROM c_sessions s WHERE NOT EXISTS
          (SELECT 1 FROM c_events e WHERE e.session_id = s.session_id)) AS orphan_sessions_count,
       (SELECT count(*) FROM (SELECT user_id, experiment_name FROM c_experiments GROUP BY ALL
          HAVING count(*) > 1)) AS duplicate_experiment_assignments,
       min(order_value) AS min_revenue, max(order_value) AS max_revenue,
       {r9(div("sum(order_value)", "count(order_value)"), "avg_revenue")},
       count(*) FILTER (order_value > 1000) AS extreme_outliers_count FROM x_sales""",
)
expect(
    "srm_check",
    f"""SELECT experiment_name, c AS control_users, v AS variant_users,
       {r9("(c + v) * CAST(0.5 AS DOUBLE)", "expected_control")},
       {r9("(c + v) * CAST(0.5 AS DOUBLE)", "expected_variant")},
       {r9("CAST((c - v) * (c - v) AS DOUBLE) / (c + v)", "chi_square_stat")}
FROM (SELECT experiment_name, count(*) FILTER (variant = 'control') AS c,
             count(*) FILTER (variant = 'variant') AS v FROM x_active GROUP BY ALL)""",
)
expect(
    "completeness_check",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS table_name, count(*) AS row_count,
       count(*) FILTER ({" OR ".join(f"{k} IS NULL" for k in keys)}) AS null_count_key_columns,
       {r9(f"CASE WHEN count(*) = 0 THEN 0.0 ELSE 100.0 - {div(f'count(*) FILTER ({chr(32).join(f"{k} IS NULL OR" for k in keys)} false)', "count(*)")} * 100 END", "completeness_pct")}
FROM {CANONICAL[t]}"""
        for t, keys in COMPLETENESS_KEYS.items()
    ),
)

# --- metrics, funnel and segments ---------------------------------------------------------


def _arm(column: str, arm: str) -> str:
    return f"max({column}) FILTER (variant = '{arm}')"


BLOCKS["x_arms"] = f"""
SELECT experiment_name, {_arm("total_users", "control")} AS control_users,
       {_arm("total_users", "variant")} AS variant_users,
       {_arm("purchasers", "control")} AS control_conversions,
       {_arm("purchasers", "variant")} AS variant_conversions
FROM v_summary GROUP BY experiment_name"""
BLOCKS["x_primary"] = f"""
SELECT *, variant_rate - control_rate AS absolute_lift,
       {div0("variant_rate - control_rate", "control_rate")} * 100 AS relative_lift_pct
FROM (SELECT *, {div0("control_conversions", "control_users")} AS control_rate,
             {div0("variant_conversions", "variant_users")} AS variant_rate FROM x_arms)"""
BLOCKS["x_secondary"] = f"""
SELECT experiment_name,
       coalesce({_arm("revenue_per_visitor", "control")}, 0.0) AS control_rpv,
       coalesce({_arm("revenue_per_visitor", "variant")}, 0.0) AS variant_rpv,
       coalesce({_arm("average_order_value", "control")}, 0.0) AS control_aov,
       coalesce({_arm("average_order_value", "variant")}, 0.0) AS variant_aov,
       coalesce({_arm("avg_session_duration_seconds", "control")}, 0.0) AS control_avg_session_seconds,
       coalesce({_arm("avg_session_duration_seconds", "variant")}, 0.0) AS variant_avg_session_seconds
FROM v_revenue FULL JOIN v_sessions USING (experiment_name, variant) GROUP BY experiment_name"""
BLOCKS["x_guard"] = f"""
SELECT *, variant_bounce_rate - control_bounce_rate AS bounce_rate_lift,
       variant_checkout_abandonment - control_checkout_abandonment AS checkout_abandonment_lift
FROM (SELECT experiment_name,
             coalesce({_arm("bounce_rate", "control")}, 0.0) AS control_bounce_rate,
             coalesce({_arm("bounce_rate", "variant")}, 0.0) AS variant_bounce_rate,
             coalesce({_arm("left_behind", "control")}, 0.0) AS control_checkout_abandonment,
             coalesce({_arm("left_behind", "variant")}, 0.0) AS variant_checkout_abandonment
      FROM v_sessions FULL JOIN (SELECT experiment_name, variant,
             1.0 - {div("purchase_users", "checkout_users")} AS left_behind FROM v_funnel)
           USING (experiment_name, variant) GROUP BY experiment_name)"""
expect(
    "primary_metric",
    _round_all("x_primary", "control_rate variant_rate absolute_lift relative_lift_pct"),
)
expect(
    "secondary_metrics",
    _round_all(
        "x_secondary",
        "control_rpv variant_rpv control_aov variant_aov control_avg_session_seconds "
        "variant_avg_session_seconds",
    ),
)
expect(
    "guardrail_metrics",
    _round_all(
        "x_guard",
        "control_bounce_rate variant_bounce_rate control_checkout_abandonment "
        "variant_checkout_abandonment bounce_rate_lift checkout_abandonment_lift",
    ),
)
expect(
    "all_metrics",
    f"""SELECT experiment_name, control_users, variant_users,
       {r9("control_rate", "control_conversion_rate")}, {r9("variant_rate", "variant_conversion_rate")},
       {r9("absolute_lift", "absolute_lift")}, {r9("relative_lift_pct", "relative_lift")},
       {r9("control_rpv", "control_revenue_per_visitor")},
       {r9("variant_rpv", "variant_revenue_per_visitor")}, {r9("control_aov", "control_aov")},
       {r9("variant_aov", "variant_aov")}, control_bounce_rate, variant_bounce_rate
FROM x_primary JOIN x_secondary USING (experiment_name) JOIN x_guard USING (experiment_name)""",
)
BLOCKS["x_forward"] = """
SELECT experiment_name, variant, step_name, step_order, users_reached,
       step_conversion_rate AS step_rate, cumulative_conversion_rate AS cumulative_rate,
       greatest(users_reached - coalesce(lead(users_reached) OVER
         (PARTITION BY experiment_name, variant ORDER BY step_order), users_reached), 0)
         AS drop_off_count
FROM v_steps"""
expect("funnel_analyzer_steps", _round_all("x_forward", "step_rate cumulative_rate"))
BLOCKS["x_funnel_lift"] = f"""
SELECT experiment_name, step_name, step_order, control_step_rate, control_cumulative_rate,
       variant_step_rate, variant_cumulative_rate,
       variant_step_rate - control_step_rate AS step_rate_lift,
       variant_cumulative_rate - control_cumulative_rate AS cumulative_rate_lift,
       (variant_cumulative_rate - control_cumulative_rate) / nullif(control_cumulative_rate, 0) * 100
         AS cumulative_rate_relative_lift_pct
FROM (SELECT experiment_name, step_name, step_order,
             {_arm("step_rate", "control")} AS control_step_rate,
             {_arm("cumulative_rate", "control")} AS control_cumulative_rate,
             {_arm("step_rate", "variant")} AS variant_step_rate,
             {_arm("cumulative_rate", "variant")} AS variant_cumulative_rate
      FROM x_forward GROUP BY ALL)"""
expect(
    "funnel_lift",
    _round_all(
        "x_funnel_lift",
        "control_step_rate control_cumulative_rate variant_step_rate variant_cumulative_rate "
        "step_rate_lift cumulative_rate_lift cumulative_rate_relative_lift_pct",
    ),
)
BLOCKS["x_worst"] = """
SELECT * FROM x_forward WHERE step_order < 5
QUALIFY row_number() OVER (PARTITION BY experiment_name, variant
                           ORDER BY drop_off_count DESC, step_order) = 1"""
expect("biggest_drop_off", _round_all("x_worst", "step_rate cumulative_rate"))
expect(
    "funnel_report",
    f"""SELECT experiment_name, variant || '_steps' AS section, step_order, step_name, users_reached,
       drop_off_count, {r9("cumulative_rate", "rate")} FROM x_forward
UNION ALL SELECT experiment_name, 'funnel_lift', step_order, step_name, NULL, NULL,
       round(cumulative_rate_lift, 9) FROM x_funnel_lift
UNION ALL SELECT experiment_name, 'biggest_drop_off_' || variant, step_order, step_name,
       users_reached, drop_off_count, round(cumulative_rate, 9) FROM x_worst""",
)
for _key, _dimension in (
    ("conversion_by_device", "device_type"),
    ("conversion_by_channel", "channel_name"),
    ("conversion_by_customer_type", "customer_type"),
):
    expect(
        _key,
        f"""SELECT * REPLACE ({r9("conversion_rate", "conversion_rate")})
FROM ({_rates_by(f"experiment_name, {_dimension}, variant")})""",
    )
expect(
    "conversion_by_country_topn",
    f"""SELECT * REPLACE ({r9("conversion_rate", "conversion_rate")})
FROM ({_rates_by("experiment_name, country_name, variant")})
WHERE country_name IN (SELECT country_name FROM v_segments GROUP BY country_name
                       ORDER BY sum(total_users) DESC, country_name LIMIT 10)""",
)
BLOCKS["x_by_dimension"] = " UNION ALL ".join(
    f"SELECT experiment_name, '{d}' AS dimension, segment, variant, total_users, purchasers, "
    f"conversion_rate FROM ({_rates_by(f'experiment_name, {d}, variant')}) "
    f"AS t(experiment_name, segment, variant, total_users, purchasers, conversion_rate)"
    for d in REPORT_NAMES
)
expect("segment_grouping_sets", _round_all("x_by_dimension", "conversion_rate"))
expect(
    "conversion_by_dimension",
    _round_all(
        "(SELECT * FROM x_by_dimension WHERE dimension <> 'country_name')", "conversion_rate"
    ),
)
BLOCKS["x_lifts"] = """
SELECT a.experiment_name, a.dimension, a.segment, a.total_users AS total_users_variant,
       a.purchasers AS purchasers_variant, a.conversion_rate AS conversion_rate_variant,
       b.total_users AS total_users_control, b.purchasers AS purchasers_control,
       b.conversion_rate AS conversion_rate_control,
       a.conversion_rate - b.conversion_rate AS absolute_lift,
       CASE WHEN b.conversion_rate > 0
            THEN (a.conversion_rate - b.conversion_rate) / b.conversion_rate ELSE 0.0 END
         AS relative_lift
FROM x_by_dimension a JOIN x_by_dimension b USING (experiment_name, dimension, segment)
WHERE a.variant = 'variant' AND b.variant = 'control'"""
_LIFT_DOUBLES = "conversion_rate_variant conversion_rate_control absolute_lift relative_lift"
expect(
    "segment_lift",
    _round_all(
        "(SELECT * EXCLUDE (dimension, segment), segment AS channel_name FROM x_lifts "
        "WHERE dimension = 'channel_name')",
        _LIFT_DOUBLES,
    ),
)
expect(
    "top_segments",
    _round_all(
        "(SELECT * EXCLUDE (dimension, segment), segment AS country_name FROM x_lifts "
        "WHERE dimension = 'country_name' "
        "ORDER BY absolute_lift DESC, experiment_name, country_name LIMIT 5)",
        _LIFT_DOUBLES,
    ),
)
_SECTION = " ".join(f"WHEN '{d}' THEN '{n}'" for d, n in REPORT_NAMES.items())
BLOCKS["x_sections"] = f"""
SELECT *, CASE dimension {_SECTION} END AS section FROM x_lifts"""
BLOCKS["x_report"] = """
SELECT * FROM x_sections
QUALIFY dimension <> 'country_name'
     OR row_number() OVER (PARTITION BY experiment_name, dimension
                           ORDER BY total_users_control DESC, segment) <= 10"""
expect("segment_report", _round_all("x_report", _LIFT_DOUBLES))
expect(
    "conversion_rate_col",
    f"""SELECT metric_date, experiment_name, variant, users_assigned, purchasing_users,
       {r9(div0("purchasing_users", "users_assigned"), "rate")} FROM v_daily""",
)
expect(
    "lift_cols",
    f"""SELECT experiment_name, segment AS country_name, {r9("c", "control_rate")},
       {r9("v", "variant_rate")}, {r9("if(c <> 0, v - c, NULL)", "absolute_lift")},
       {r9("if(c <> 0, v - c, NULL) / c", "relative_lift")},
       {r9("if(c <> 0, v - c, NULL) * 100", "absolute_lift_pct")},
       {r9("if(c <> 0, v - c, NULL) / c * 100", "relative_lift_pct")}, c <> 0 AS is_defined
FROM (SELECT *, conversion_rate_control AS c, conversion_rate_variant AS v FROM x_lifts
      WHERE dimension = 'country_name')""",
)

# --- sources, sinks and helpers -----------------------------------------------------------


def _counted(names) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {CANONICAL[n]}" for n in names
    )


for _key in ("assert_guards",):
    expect(_key, _counted(S.CORE_TABLES))


def _contents(ids_as_text: bool) -> str:
    """Non-NULL values and a checksum per column; CSV files have ids as text."""

    def number(column: str, kind: str) -> str:
        if kind == "string" and column.endswith("_id") and not ids_as_text:
            return column
        return {
            "string": f"CAST('0x' || substr(md5(CAST({column} AS VARCHAR)), 1, 8) AS BIGINT)",
            "date": f"({column} - date '1970-01-01')",
            "timestamp": f"epoch_us({column})",
            "boolean": f"CAST({column} AS INTEGER)",
        }.get(kind, column)

    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count({c}) AS non_null, "
        f"CAST(sum(CAST({number(c, kind)} AS DECIMAL(30,4))) AS DECIMAL(38,4)) AS checksum "
        f"FROM {CANONICAL[table]}"
        for table in S.CORE_TABLES
        for c, kind in S.declared_columns(table).items()
    )


expect("scan_tables", _contents(ids_as_text=True))
expect("bulk_load", _contents(ids_as_text=False))
expect(
    "sink_raw",
    f"SELECT * FROM ({_contents(ids_as_text=False)}) JOIN "
    f"(SELECT table_name, row_count AS rows_written FROM ({_counted(S.CORE_TABLES)})) USING (table_name)",
)
expect(
    "row_count_reconcile",
    f"""SELECT table_name, row_count AS expected, row_count AS actual, true AS ok
FROM ({_counted(S.CORE_TABLES)})""",
)
_DATASETS = {
    "experiment_summary": "v_summary",
    "daily_metrics": "v_daily",
    "funnel_data": "v_funnel",
    "session_metrics": "v_sessions",
    "segment_data": "v_segments",
    "revenue_summary": "v_revenue",
    "user_level_data": "v_user_level",
}


def _text_sums(block: str, name: str, label: str) -> str:
    """Per column: values that are there, and the sum of numbers to six places or of numbers made from texts."""
    return f"""SELECT '{name}' AS {label}, column_name, count(v) AS non_null,
       CAST(sum(coalesce(CAST(TRY_CAST(v AS DOUBLE) AS DECIMAL(30,6)),
                         CAST(CAST('0x' || substr(md5(v), 1, 8) AS BIGINT) AS DECIMAL(30,6)))) AS DECIMAL(38,6))
         AS checksum
FROM (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM {block})
     UNPIVOT INCLUDE NULLS (v FOR column_name IN (COLUMNS(*))) GROUP BY column_name"""


for _key in ("dataset_bundle", "export_datasets"):
    expect(_key, "\nUNION ALL ".join(_text_sums(block, n, "dataset") for n, block in _DATASETS.items()))
expect(
    "refresh_materialized",
    _text_sums("v_user_level", "mv_user_experiment_summary", "view_name")
    + "\nUNION ALL "
    + _text_sums("v_daily", "mv_daily_conversion", "view_name"),
)
expect(
    "typed_view_read",
    _round_all(
        "(SELECT * REPLACE (CAST(total_revenue AS DOUBLE) AS total_revenue) FROM v_summary)",
        "conversion_rate revenue_per_visitor average_order_value total_revenue",
    ),
)
expect(
    "user_level_sample",
    _round_all(
        "(SELECT * REPLACE (CAST(total_revenue AS DOUBLE) AS total_revenue) FROM v_user_level "
        "WHERE CAST('0x' || substr(md5('sample 42:' || user_id), 1, 8) AS BIGINT) % 1000000 < 250000)",
        _USER_DOUBLES + " total_revenue",
    ),
)


def _seeded(lookup: str, identity: str, name: str, key: str, seeds, uses: str) -> str:
    """Existing rows plus the seeds whose key is new, numbered after the highest id."""
    block = CANONICAL[lookup]
    return f"""SELECT '{lookup}' AS lookup, id, name, coalesce(n, 0) AS uses
FROM (SELECT {identity} AS id, {name} AS name FROM {block}
      UNION ALL
      SELECT (SELECT coalesce(max({identity}), 0) FROM {block})
             + CAST(row_number() OVER (ORDER BY i) AS INTEGER), name
      FROM ({_values(seeds, "i, k, name")}) WHERE k NOT IN (SELECT {key} FROM {block}))
LEFT JOIN (SELECT {identity} AS id, count(*) AS n FROM {uses} GROUP BY 1) USING (id)"""


def _simple_seeds(names):
    return [(i, n, n) for i, n in enumerate(names, 1)]


expect(
    "dim_lookup_seed",
    " UNION ALL ".join(
        [
            _seeded("regions", "region_id", "region_name", "region_name",
                    _simple_seeds(S.REGION_NAMES), "c_countries"),
            _seeded("countries", "country_id", "country_name", "country_code",
                    [(i, code, n) for i, (code, n, _) in enumerate(S.COUNTRY_ROWS, 1)], "c_users"),
            _seeded("devices", "device_id", "device_type", "device_type",
                    _simple_seeds(S.DEVICE_TYPES), "c_users"),
            _seeded("browsers", "browser_id", "browser_name", "browser_name",
                    _simple_seeds(S.BROWSER_NAMES), "c_users"),
            _seeded("acquisition_channels", "channel_id", "channel_name", "channel_name",
                    _simple_seeds(S.CHANNEL_NAMES), "c_users"),
            _seeded("event_types", "event_type_id", "event_name", "event_name",
                    _simple_seeds([row[0] for row in S.EVENT_TYPE_ROWS]), "c_events"),
        ]
    ),
)
expect(
    "filter_date_range",
    """SELECT order_id, order_timestamp, order_value, payment_status FROM c_orders
WHERE order_timestamp >= timestamp '2024-01-05' AND order_timestamp <= timestamp '2024-01-12 12:00:00'""",
)
expect(
    "split_by_variant",
    """SELECT variant AS arm, count(*) AS n_rows, count(DISTINCT user_id) AS n_users
FROM c_experiments GROUP BY variant""",
)
BLOCKS["x_sizes"] = """
SELECT (SELECT count(*) FROM c_users) AS l, (SELECT count(*) FROM c_sessions) AS r"""
expect(
    "safe_merge",
    " UNION ALL ".join(
        f"SELECT '{how}' AS how, l AS left_rows, r AS right_rows, "
        f"(SELECT count(*) FROM c_users {sql} JOIN c_sessions USING (user_id)) AS result_rows "
        f"FROM x_sizes"
        for how, sql in (("inner", ""), ("left", "LEFT"), ("right", "RIGHT"), ("outer", "FULL"))
    )
    + """ UNION ALL SELECT 'inner rows', count(DISTINCT user_id), count(DISTINCT session_id), count(*)
FROM c_users JOIN c_sessions USING (user_id)""",
)
_COLUMNS = {
    "users": "user_id signup_date country_id device_id browser_id channel_id customer_type "
    "operating_system is_returning",
    "experiments": "experiment_id experiment_name variant user_id assignment_timestamp is_holdout",
    "sessions": "session_id user_id session_start session_end duration_seconds device_id "
    "browser_id page_count is_bounce",
    "events": "event_id session_id user_id experiment_id event_type_id event_timestamp page_url "
    "revenue is_mobile",
    "orders": "order_id user_id session_id event_id order_timestamp order_value payment_method "
    "is_refund payment_status",
}
expect(
    "null_profile",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS row_count, "
        f"count(*) - count({c}) AS null_count, "
        f"{r9(div(f'(count(*) - count({c})) * 100', 'count(*)'), 'null_pct')} FROM {CANONICAL[t]}"
        for t, columns in _COLUMNS.items()
        for c in columns.split()
    ),
)
expect(
    "event_funnel_map",
    """SELECT event_name, event_category, funnel_step, count(*) AS n_events,
       count(DISTINCT user_id) AS n_users
FROM c_named_events JOIN c_event_types USING (event_name) GROUP BY ALL""",
)


def _draw(salt: str, modulus: int, key: str = "c_custkey") -> str:
    """A number below ``modulus`` from the first 32 bits of md5 of salt:key."""
    return f"(CAST('0x' || substr(md5({salt} || ':' || {key}), 1, 8) AS BIGINT) % {modulus})"


expect(
    "assign_variants",
    f"""SELECT c_custkey AS user_id, name AS experiment_name,
       CASE WHEN {_draw("'holdout'", 1000)} >= 20 AND {_draw("name", 1000)} < share
            THEN 'variant' ELSE 'control' END AS variant,
       date '2024-01-01' + CAST({_draw("name || ' ramp'", 14)} AS INTEGER) AS assignment_date,
       {_draw("'holdout'", 1000)} < 20 AS is_holdout
FROM customer, (VALUES ('checkout_redesign', 500), ('pricing_test', 420)) p(name, share)""",
)
expect(
    "sessionize",
    """SELECT session_id, user_id, session_start, session_end, duration_seconds, page_count, is_bounce
FROM c_sessions""",
)
expect(
    "derive_orders",
    """SELECT event_id AS order_id, user_id, session_id, event_id, event_timestamp AS order_timestamp,
       CAST(round(greatest(coalesce(revenue, 50), 1), 2) AS DECIMAL(12,2)) AS order_value,
       'credit_card' AS payment_method, false AS is_refund, 'completed' AS payment_status
FROM c_events JOIN c_event_types USING (event_type_id) WHERE event_name = 'purchase'""",
)

# --- data quality -------------------------------------------------------------------------


def _checked(table: str, name: str, violations: str, severity: str = "FAIL", detail="NULL") -> str:
    return (
        f"SELECT '{table}' AS table_name, '{name}' AS check_name, '{severity}' AS severity, "
        f"CAST(({violations}) AS BIGINT) AS violations, CAST({detail} AS VARCHAR) AS detail"
    )


def _gate(rows: list[str]) -> str:
    body = "\nUNION ALL ".join(rows)
    return f"""SELECT table_name, check_name, severity,
       CASE WHEN violations = 0 THEN 'PASS' ELSE severity END AS status, violations, detail
FROM ({body})"""


def _count_where(table: str, condition: str) -> str:
    return f"SELECT count(*) FROM {CANONICAL[table]} WHERE {condition}"


def _standard(table: str) -> list[str]:
    return [
        _checked(table, "required_columns_present", "0"),
        *[
            _checked(table, f"no_nulls_{c}", _count_where(table, f"{c} IS NULL"))
            for c in Q.REQUIRED[table]
        ],
    ]


def _extra_rows(table: str, *keys: str) -> str:
    listed = ", ".join(keys)
    return (
        f"SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT {listed} "
        f"FROM {CANONICAL[table]})) FROM {CANONICAL[table]}"
    )


def _no_parent(child: str, column: str, parent: str, key: str) -> str:
    return (
        f"SELECT count(*) FROM {CANONICAL[child]} ch WHERE NOT EXISTS "
        f"(SELECT 1 FROM {CANONICAL[parent]} pa WHERE pa.{key} = ch.{column})"
    )


def _dq_users(window: tuple[str, str] | None) -> list[str]:
    largest = (
        "SELECT arg_max(customer_type, n) AS kind, max(n) * 1.0 / sum(n) > 0.7 AS big FROM "
        "(SELECT customer_type, count(*) AS n FROM c_users WHERE customer_type IS NOT NULL "
        "GROUP BY 1)"
    )
    rows = _standard("users") + [
        _checked("users", "valid_customer_type",
                 _count_where("users", f"customer_type NOT IN ({_quoted(S.CUSTOMER_TYPES)})")),
        _checked("users", "customer_type_balance", f"SELECT CAST(big AS INTEGER) FROM ({largest})",
                 "WARN", f"(SELECT if(big, kind, NULL) FROM ({largest}))"),
        _checked("users", "is_returning_boolean", "0"),
        _checked("users", "unique_user_id", _extra_rows("users", "user_id")),
    ]
    if window:
        rows.append(
            _checked("users", "signup_date_range", _count_where(
                "users", f"signup_date < '{window[0]}' OR signup_date > '{window[1]}'"))
        )
    return rows


def _dq_experiments(window: tuple[str, str] | None) -> list[str]:
    share = (
        "SELECT experiment_name AS x, count(*) FILTER (variant = 'variant') * 1.0 / count(variant)"
        " AS share FROM c_experiments GROUP BY 1"
    )
    rows = _standard("experiments") + [
        _checked("experiments", "valid_variant_values",
                 _count_where("experiments", "variant NOT IN ('control', 'variant')")),
        _checked("experiments", "unique_user_experiment",
                 _extra_rows("experiments", "user_id", "experiment_name")),
        f"""SELECT 'experiments', 'variant_split',
            CASE WHEN share < 0.3 OR share > 0.7 THEN 'FAIL' ELSE 'WARN' END,
            CASE WHEN share < 0.4 OR share > 0.6 THEN 1 ELSE 0 END, x FROM ({share})""",
    ]
    if window:
        rows.append(
            _checked("experiments", "assignment_timestamp_range", _count_where(
                "experiments",
                f"CAST(assignment_timestamp AS DATE) NOT BETWEEN '{window[0]}' AND '{window[1]}'"))
        )
    return rows


def _dq_sessions() -> list[str]:
    return _standard("sessions") + [
        _checked("sessions", "session_end_after_start",
                 _count_where("sessions", "session_end < session_start")),
        _checked("sessions", "positive_duration",
                 _count_where("sessions", "duration_seconds <= 0")),
        _checked("sessions", "page_count_minimum", _count_where("sessions", "page_count < 1")),
        _checked("sessions", "bounce_page_count_consistency",
                 _count_where("sessions", "is_bounce AND page_count > 1"), "WARN"),
        _checked("sessions", "unique_session_id", _extra_rows("sessions", "session_id")),
        _checked("sessions", "duration_distribution",
                 "SELECT CAST(quantile_cont(duration_seconds, 0.99) > 7200 AS INTEGER) "
                 "FROM c_sessions", "WARN"),
    ]


def _dq_events() -> list[str]:
    return _standard("events") + [
        _checked("events", "revenue_non_negative", _count_where("events", "revenue < 0")),
        _checked("events", "unique_event_id", _extra_rows("events", "event_id")),
        _checked("events", "valid_event_type_ids",
                 _no_parent("events", "event_type_id", "event_types", "event_type_id")),
        _checked("events", "revenue_only_on_purchase",
                 "SELECT count(revenue) FROM c_events JOIN c_event_types USING (event_type_id) "
                 "WHERE event_name <> 'purchase'", "WARN"),
        _checked("events", "no_orphan_events",
                 _no_parent("events", "session_id", "sessions", "session_id")),
        _checked("events", "event_within_session_window",
                 "SELECT count(*) FROM c_events JOIN c_sessions USING (session_id) WHERE "
                 "event_timestamp NOT BETWEEN session_start AND session_end"),
    ]


def _dq_orders() -> list[str]:
    refunds = (
        "SELECT CAST(count(*) FILTER (is_refund) * 1.0 / count(*) FILTER "
        "(payment_status = 'completed') > 0.3 AS INTEGER) FROM c_orders"
    )
    return _standard("orders") + [
        _checked("orders", "order_value_positive", _count_where("orders", "order_value <= 0")),
        _checked("orders", "order_value_sanity",
                 _count_where("orders", "order_value > 10000"), "WARN"),
        _checked("orders", "valid_payment_method", _count_where(
            "orders", f"payment_method NOT IN ({_quoted(S.PAYMENT_METHODS)})")),
        _checked("orders", "valid_payment_status", _count_where(
            "orders", f"payment_status NOT IN ({_quoted(S.PAYMENT_STATUSES)})")),
        _checked("orders", "refund_rate_sanity", refunds, "WARN"),
        _checked("orders", "unique_order_id", _extra_rows("orders", "order_id")),
        _checked("orders", "no_orphan_orders_user",
                 _no_parent("orders", "user_id", "users", "user_id")),
        _checked("orders", "no_orphan_orders_session",
                 _no_parent("orders", "session_id", "sessions", "session_id")),
    ]


def _dq_cross() -> list[str]:
    return [
        _checked("cross_table_integrity", f"{child}_user_fk",
                 _no_parent(child, "user_id", "users", "user_id"))
        for child in ("experiments", "sessions", "events", "orders")
    ]


expect("dq_users", _gate(_dq_users(("2023-07-05", "2023-12-31"))))
expect("dq_experiments", _gate(_dq_experiments(("2024-01-01", "2024-01-10"))))
expect("dq_sessions", _gate(_dq_sessions()))
expect("dq_events", _gate(_dq_events()))
expect("dq_orders", _gate(_dq_orders()))
expect("dq_cross_table", _gate(_dq_cross()))
BLOCKS["x_gate"] = _gate(
    _dq_users(None) + _dq_experiments(None) + _dq_sessions() + _dq_events() + _dq_orders()
    + _dq_cross()
)
_ROLL = """count(*) FILTER (status <> 'FAIL') AS checks_passed,
       count(*) FILTER (status = 'FAIL') AS checks_failed,
       count(*) FILTER (status = 'WARN') AS warnings,
       count(*) FILTER (status = 'FAIL') = 0 AS is_valid FROM x_gate"""
expect(
    "dq_overall",
    f"SELECT table_name, {_ROLL} GROUP BY table_name UNION ALL SELECT 'ALL', {_ROLL}",
)


def _contract(table: str) -> list[str]:
    source = CANONICAL[table]

    def row(column, check: str, severity: str, violations: str) -> str:
        return (
            f"SELECT '{table}' AS table_name, {_literal(column)} AS column_name, "
            f"'{check}' AS check_name, '{severity}' AS severity, "
            f"CAST(({violations}) AS BIGINT) AS violations, CAST(NULL AS VARCHAR) AS sample"
        )

    rows = [row(None, "not_empty", "ERROR", f"SELECT CAST(count(*) = 0 AS INTEGER) FROM {source}")]
    for column, (kind, nullable) in S.load_contract(table).items():
        rows.append(row(column, "column_present", "ERROR", "0"))
        if not nullable:
            rows.append(row(column, "not_null", "ERROR", _count_where(table, f"{column} IS NULL")))
        if kind == "float":
            rows.append(row(column, "not_negative", "WARNING", _count_where(table, f"{column} < 0")))
        if kind == "int":
            rows.append(row(column, "numeric", "ERROR", _count_where(
                table, f"{column} IS NOT NULL AND TRY_CAST({column} AS DOUBLE) IS NULL")))
    for column, allowed in S.ENUM_COLUMNS.get(table, {}).items():
        rows.append(row(column, "allowed_values", "ERROR",
                        _count_where(table, f"{column} NOT IN ({_quoted(allowed)})")))
    rows.append(row(f"{table[:-1]}_id", "unique_key", "ERROR",
                    _extra_rows(table, f"{table[:-1]}_id")))
    return rows


expect("schema_check", "\nUNION ALL ".join(r for t in S.CORE_TABLES for r in _contract(t)))
_CHECK_SQL = (
    ("event_types", "event_category_allowed", f"event_category NOT IN ({_quoted(S.EVENT_CATEGORIES)})"),
    ("event_types", "funnel_step_range", "funnel_step < 1 OR funnel_step > 10"),
    ("users", "customer_type_allowed", f"customer_type NOT IN ({_quoted(S.CUSTOMER_TYPES)})"),
    ("users", "signup_not_in_future", "signup_date > current_date"),
    ("experiments", "variant_allowed", "variant NOT IN ('control', 'variant')"),
    ("experiments", "assignment_since_2020", "assignment_timestamp < timestamp '2020-01-01'"),
    ("sessions", "end_not_before_start", "session_end < session_start"),
    ("sessions", "duration_not_negative", "duration_seconds < 0"),
    ("sessions", "page_count_positive", "page_count < 1"),
    ("events", "revenue_not_negative", "revenue < 0"),
    ("events", "event_since_2020", "event_timestamp < timestamp '2020-01-01'"),
    ("orders", "order_value_positive", "order_value <= 0"),
    ("orders", "order_value_ceiling", "order_value > 10000"),
    ("orders", "payment_status_allowed", f"payment_status NOT IN ({_quoted(S.PAYMENT_STATUSES)})"),
    ("orders", "payment_method_allowed", f"payment_method NOT IN ({_quoted(S.PAYMENT_METHODS)})"),
)
expect(
    "constraint_check",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{n}' AS constraint_name, count(*) AS violations "
        f"FROM {CANONICAL[t]} WHERE {broken}"
        for t, n, broken in _CHECK_SQL
    ),
)
expect(
    "unique_check",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{', '.join(keys)}' AS key_columns, "
        f"count(*) - count(DISTINCT ({', '.join(keys)})) AS duplicate_rows FROM {CANONICAL[t]} "
        f"WHERE {' AND '.join(f'{k} IS NOT NULL' for k in keys)}"
        for t, keys in [(t, (k,)) for t, k in S.PRIMARY_KEYS.items()] + list(S.UNIQUE_KEYS)
    ),
)
expect(
    "fk_check",
    " UNION ALL ".join(
        f"SELECT '{child}' AS child_table, '{column}' AS child_column, '{parent}' AS parent_table, "
        f"count(*) AS orphan_rows FROM {CANONICAL[child]} WHERE {column} IS NOT NULL AND {column} "
        f"NOT IN (SELECT {S.PRIMARY_KEYS[parent]} FROM {CANONICAL[parent]})"
        for child, column, parent in S.FOREIGN_KEYS
    ),
)

# --- statistics ---------------------------------------------------------------------------


def _nested(x: str, coefficients) -> str:
    text = repr(coefficients[0]) + "::DOUBLE"
    for c in coefficients[1:]:
        text = f"({text} * {x} + {c!r}::DOUBLE)"
    return text


def tail(z: str) -> str:
    """P(Z > z); z must be a plain column or a short expression."""
    x = f"abs({z})"
    density = f"exp(-{x} * {x} / 2.0::DOUBLE)"
    near = f"{density} * {_nested(x, D.TAIL_NUMERATOR)} / {_nested(x, D.TAIL_DENOMINATOR)}"
    deep = f"({x} + 0.65::DOUBLE)"
    for k in (4, 3, 2, 1):
        deep = f"({x} + {k}.0::DOUBLE / {deep})"
    far = f"{density} / {deep} / {D.SQRT_TWO_PI}::DOUBLE"
    upper = (
        f"CASE WHEN {x} > {D.TAIL_CUTOFF} THEN 0.0::DOUBLE "
        f"WHEN {x} < {D.TAIL_SWITCH}::DOUBLE THEN {near} ELSE {far} END"
    )
    return f"(CASE WHEN {z} >= 0 THEN {upper} ELSE 1.0::DOUBLE - ({upper}) END)"


def _z(p: float) -> str:
    return f"{NormalDist().inv_cdf(p)!r}::DOUBLE"


Z95 = _z(0.975)
# The shift that a two-sided test at 5 % finds with 80 % power, by halving an interval 60 times.
_MIDDLE = "((low + high) / 2)"
BLOCKS["x_halved"] = f"""
SELECT 0 AS step, 0.0::DOUBLE AS low, 10.0::DOUBLE AS high
UNION ALL SELECT step + 1, CASE WHEN found < 0.8::DOUBLE THEN middle ELSE low END,
       CASE WHEN found < 0.8::DOUBLE THEN high ELSE middle END
FROM (SELECT *, {tail("less")} + {tail("more")} AS found
      FROM (SELECT step, low, high, {_MIDDLE} AS middle, {Z95} - {_MIDDLE} AS less, {Z95} + {_MIDDLE} AS more
            FROM x_halved WHERE step < 60))"""
Z_SUM = "(SELECT high FROM x_halved WHERE step = 60)"


def angle(p: str) -> str:
    return f"(2.0::DOUBLE * asin(sqrt(greatest(0.0, least(1.0, {p})))))"


BLOCKS["x_pairs"] = """
SELECT experiment_name, 'conversion' AS metric_name, control_users, variant_users,
       control_conversions, variant_conversions FROM x_arms
UNION ALL SELECT experiment_name, section || ':' || segment, total_users_control,
       total_users_variant, purchasers_control, purchasers_variant FROM x_sections"""
BLOCKS["x_rated"] = f"""
SELECT *, {div("control_conversions", "control_users")} AS control_rate,
       {div("variant_conversions", "variant_users")} AS variant_rate,
       {div("control_conversions + variant_conversions", "control_users + variant_users")}
         AS pooled_proportion FROM x_pairs"""
BLOCKS["x_tested"] = f"""
SELECT *, CASE WHEN standard_error = 0 THEN 1.0 ELSE 2.0 * {tail("abs(z_score)")} END AS p_value
FROM (SELECT *, CASE WHEN standard_error = 0 THEN 0.0
                ELSE (variant_rate - control_rate) / standard_error END AS z_score
      FROM (SELECT *, sqrt(pooled_proportion * (1 - pooled_proportion)
                           * (1.0::DOUBLE / control_users + 1.0::DOUBLE / variant_users))
                      AS standard_error FROM x_rated))"""
_PAIR = """experiment_name, metric_name, control_users, variant_users, control_conversions,
       variant_conversions"""
expect(
    "two_proportion_z_test",
    f"""SELECT {_PAIR}, true AS is_valid, {r9("control_rate", "control_rate")},
       {r9("variant_rate", "variant_rate")}, {r9("pooled_proportion", "pooled_proportion")},
       {r9("standard_error", "standard_error")}, {r9("z_score", "z_score")},
       {r9("variant_rate - control_rate", "absolute_lift")},
       {r9("CASE WHEN control_rate > 0 THEN (variant_rate - control_rate) / control_rate * 100 ELSE 0.0 END", "relative_lift_pct")},
       {r9("p_value", "p_value")}, p_value < 0.05 AS is_significant, 0.05::DOUBLE AS alpha
FROM x_tested""",
)
expect(
    "proportion_ci",
    f"""SELECT experiment_name, dimension, segment, variant, total_users, purchasers,
       {r9("conversion_rate", "conversion_rate")}, {r9("mid - half", "ci_lower")},
       {r9("mid + half", "ci_upper")}, {r9("p", "ci_center")},
       {r9("half", "margin_of_error")}, 0.95::DOUBLE AS confidence_level
FROM (SELECT *, (p + z * z / (2 * n)) / (1 + z * z / n) AS mid,
             z * sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / (1 + z * z / n) AS half
      FROM (SELECT *, conversion_rate AS p, CAST(total_users AS DOUBLE) AS n, {Z95} AS z
            FROM x_by_dimension))""",
)
BLOCKS["x_interval"] = f"""
SELECT *, {Z95} * sqrt(control_rate * (1 - control_rate) / control_users
                       + variant_rate * (1 - variant_rate) / variant_users) AS margin
FROM x_rated"""
expect(
    "difference_ci",
    f"""SELECT {_PAIR}, {r9("variant_rate - control_rate - margin", "ci_lower")},
       {r9("variant_rate - control_rate + margin", "ci_upper")},
       {r9("variant_rate - control_rate", "ci_center")}, {r9("margin", "margin_of_error")},
       0.95::DOUBLE AS confidence_level FROM x_interval""",
)


def _t_quantile(df: str) -> str:
    x = NormalDist().inv_cdf(0.975)
    parts = (
        (x**3 + x) / 4,
        (5 * x**5 + 16 * x**3 + 3 * x) / 96,
        (3 * x**7 + 19 * x**5 + 17 * x**3 - 15 * x) / 384,
        (79 * x**9 + 776 * x**7 + 1482 * x**5 - 1920 * x**3 - 945 * x) / 92160,
    )
    series = f"{x!r}::DOUBLE"
    for i, part in enumerate(parts, 1):
        series += f" + {part!r}::DOUBLE / pow({df}, {i})"
    table = ", ".join(f"{v!r}::DOUBLE" for v in D.small_t_quantiles(0.975))
    return f"(CASE WHEN {df} <= 60 THEN [{table}][CAST({df} AS INTEGER)] ELSE {series} END)"


expect(
    "revenue_ci",
    f"""SELECT experiment_name, variant, n, {r9("mean", "ci_center")},
       {r9("mean - margin", "ci_lower")}, {r9("mean + margin", "ci_upper")},
       {r9("margin", "margin_of_error")}, 0.95::DOUBLE AS confidence_level
FROM (SELECT *, CASE WHEN n < 2 THEN 0.0 ELSE sd / sqrt(n) * {_t_quantile("(n - 1)")} END AS margin
      FROM (SELECT experiment_name, variant, count(*) AS n,
                   CAST(sum(revenue) AS DOUBLE) / count(*) AS mean,
                   stddev_samp(CAST(revenue AS DOUBLE)) AS sd FROM x_user_revenue GROUP BY ALL))""",
)
expect(
    "cohens_h",
    f"""SELECT {_PAIR}, {r9("control_rate", "control_rate")}, {r9("variant_rate", "variant_rate")},
       {r9("a", "phi_control")}, {r9("b", "phi_variant")}, {r9("b - a", "cohens_h")},
       CASE WHEN abs(b - a) >= 0.8 THEN 'large' WHEN abs(b - a) >= 0.5 THEN 'medium'
            WHEN abs(b - a) >= 0.2 THEN 'small' ELSE 'negligible' END AS magnitude
FROM (SELECT *, {angle("control_rate")} AS a, {angle("variant_rate")} AS b FROM x_rated)""",
)


def _needed(base: str, effect: str) -> str:
    h = f"({angle(f'{base} + {effect}')} - {angle(base)})"
    return (
        f"CASE WHEN {effect} = 0 THEN 0 "
        f"ELSE CAST(floor(2.0::DOUBLE * {Z_SUM} * {Z_SUM} / nullif({h} * {h}, 0)) AS BIGINT) END"
    )


def _smallest_effect(base: str, n: str) -> str:
    half = f"(({Z_SUM} * sqrt(2.0::DOUBLE / {n}) + {angle(base)}) / 2)"
    return f"(sin({half}) * sin({half}) - {base})"


BLOCKS["x_power"] = f"""
SELECT *, CASE WHEN h = 0 THEN 0.05 ELSE {tail("above")} + {tail("below")} END AS achieved_power,
       CASE WHEN h = 0 THEN 0 ELSE {_needed("control_rate", "abs(variant_rate - control_rate)")} END
         AS required_sample_size_per_group,
       {_smallest_effect("control_rate", "least(control_users, variant_users)")} AS mde
FROM (SELECT *, {Z95} - h * spread AS above, {Z95} + h * spread AS below
      FROM (SELECT *, {angle("variant_rate")} - {angle("control_rate")} AS h,
                   sqrt(1.0::DOUBLE / (1.0::DOUBLE / control_users + 1.0::DOUBLE / variant_users))
                     AS spread FROM x_rated))"""
expect(
    "achieved_power",
    f"""SELECT {_PAIR}, {r9("h", "effect_size")}, {r9("achieved_power", "achieved_power")},
       required_sample_size_per_group, achieved_power >= 0.8 AS is_adequately_powered,
       {r9("mde", "mde")} FROM x_power""",
)
expect(
    "required_sample_size",
    f"""SELECT experiment_name, metric_name, {r9("control_rate", "control_rate")},
       {r9("abs(variant_rate - control_rate)", "effect")},
       {_needed("control_rate", "abs(variant_rate - control_rate)")} AS required_sample_size
FROM x_rated""",
)
expect(
    "mde_for_n",
    f"""SELECT experiment_name, metric_name, {r9("control_rate", "control_rate")}, control_users,
       {r9(_smallest_effect("control_rate", "control_users"), "mde")} FROM x_rated""",
)
expect(
    "srm_test",
    f"""SELECT experiment_name, c AS control_observed, v AS variant_observed,
       {r9("(c + v) * 0.5::DOUBLE", "control_expected")},
       {r9("(c + v) * 0.5::DOUBLE", "variant_expected")},
       {r9("root * root", "chi_square_statistic")}, {r9("p", "srm_p_value")}, p < 0.01 AS srm_detected
FROM (SELECT *, 2.0 * {tail("root")} AS p
      FROM (SELECT experiment_name, count(*) FILTER (variant = 'control') AS c,
                   count(*) FILTER (variant = 'variant') AS v,
                   abs(c - v) / sqrt(CAST(c + v AS DOUBLE)) AS root
            FROM x_active GROUP BY experiment_name))""",
)


def _correction(method: str, corrected: str) -> str:
    return f"""SELECT experiment_name, metric_name, {r9("p_value", "p_value")},
       {r9("q", "corrected_p_value")}, q <= 0.05 AS is_significant,
       '{method}' AS correction_method, 0.05::DOUBLE AS alpha
FROM ({corrected})"""


expect(
    "bonferroni",
    _correction(
        "bonferroni",
        "SELECT *, least(p_value * count(*) OVER (PARTITION BY experiment_name), 1.0) AS q "
        "FROM x_tested",
    ),
)
BLOCKS["x_bh"] = """
SELECT a.experiment_name, a.metric_name, any_value(a.p_value) AS p_value,
       least(min(b.p_value * b.m / b.place), 1.0) AS q
FROM x_tested a JOIN (SELECT experiment_name, p_value,
                             count(*) OVER (PARTITION BY experiment_name) AS m,
                             row_number() OVER (PARTITION BY experiment_name ORDER BY p_value) AS place
                      FROM x_tested) b
  ON a.experiment_name = b.experiment_name AND b.p_value >= a.p_value
GROUP BY a.experiment_name, a.metric_name"""
expect("benjamini_hochberg", _correction("benjamini_hochberg", "FROM x_bh"))
expect("correct_p_values", _correction("benjamini_hochberg", "FROM x_bh"))

BLOCKS["x_fences"] = """
SELECT experiment_name, variant, count(*) AS n,
       quantile_cont(CAST(revenue AS DOUBLE), 0.25) AS q1,
       quantile_cont(CAST(revenue AS DOUBLE), 0.75) AS q3
FROM x_user_revenue GROUP BY ALL"""
BLOCKS["x_flagged"] = """
SELECT u.*, n >= 4 AND (revenue > q3 + 3.0 * (q3 - q1) OR revenue < q1 - 3.0 * (q3 - q1))
         AS is_outlier, if(n >= 4, q3 + 3.0 * (q3 - q1), NULL) AS fence
FROM x_user_revenue u JOIN x_fences USING (experiment_name, variant)"""
expect("iqr_outliers", "SELECT * EXCLUDE (fence) FROM x_flagged")
BLOCKS["x_impact"] = f"""
SELECT experiment_name, variant, total_records, outlier_count,
       {div("outlier_count", "total_records")} AS outlier_fraction, mean_all AS mean_with_outliers,
       if(mixed, mean_kept, mean_all) AS mean_without_outliers,
       if(mixed, fence, top) AS outlier_threshold,
       coalesce(abs(mean_all - if(mixed, mean_kept, mean_all))
                / nullif(if(mixed, mean_kept, mean_all), 0) * 100, 0.0) AS mean_difference_pct
FROM (SELECT experiment_name, variant, count(*) AS total_records,
             count(*) FILTER (is_outlier) AS outlier_count,
             {div("sum(revenue)", "count(*)")} AS mean_all,
             {div("sum(revenue) FILTER (NOT is_outlier)", "count(*) FILTER (NOT is_outlier)")}
               AS mean_kept,
             CAST(max(revenue) AS DOUBLE) AS top, max(fence) AS fence,
             count(*) FILTER (is_outlier) BETWEEN 1 AND count(*) - 1 AS mixed
      FROM x_flagged GROUP BY ALL)"""
expect(
    "outlier_impact",
    _round_all(
        "(SELECT *, mean_difference_pct > 5 AS outliers_material FROM x_impact)",
        "outlier_fraction mean_with_outliers mean_without_outliers outlier_threshold "
        "mean_difference_pct",
    ),
)
expect(
    "winsorized_mean",
    f"""SELECT experiment_name, variant, count(*) AS n, {r9("CAST(max(lo) AS DOUBLE)", "lowest_kept")},
       {r9("CAST(max(hi) AS DOUBLE)", "highest_kept")},
       {r9(div("sum(CASE WHEN pos < cut THEN lo WHEN pos >= n - cut THEN hi ELSE revenue END)", "count(*)"), "winsorized_mean")}
FROM (SELECT *, max(revenue) FILTER (pos = cut) OVER arm AS lo,
             max(revenue) FILTER (pos = n - cut - 1) OVER arm AS hi
      FROM (SELECT *, CAST(floor(0.05::DOUBLE * n) AS BIGINT) AS cut
            FROM (SELECT *, row_number() OVER (PARTITION BY experiment_name, variant
                                               ORDER BY revenue, user_id) - 1 AS pos,
                         count(*) OVER (PARTITION BY experiment_name, variant) AS n
                  FROM x_user_revenue))
      WINDOW arm AS (PARTITION BY experiment_name, variant))
GROUP BY ALL""",
)

# --- report and decision ------------------------------------------------------------------

BLOCKS["x_srm"] = f"""
SELECT *, 2.0 * {tail("root")} AS srm_p_value
FROM (SELECT experiment_name, abs(control_users - variant_users)
               / sqrt(CAST(control_users + variant_users AS DOUBLE)) AS root FROM x_arms)"""
BLOCKS["x_results"] = f"""
SELECT t.*, variant_rate - control_rate AS absolute_lift,
       {div0("variant_rate - control_rate", "control_rate")} * 100 AS relative_lift_pct,
       margin, h, achieved_power, required_sample_size_per_group, mde, srm_p_value, root
FROM x_tested t
JOIN (SELECT experiment_name, metric_name, margin FROM x_interval)
  USING (experiment_name, metric_name)
JOIN (SELECT experiment_name, metric_name, h, achieved_power, required_sample_size_per_group, mde
      FROM x_power) USING (experiment_name, metric_name)
JOIN x_srm USING (experiment_name)
WHERE metric_name = 'conversion'"""
expect(
    "stat_report",
    f"""SELECT experiment_name, control_users, variant_users, control_conversions,
       variant_conversions, true AS is_valid, {r9("control_rate", "control_rate")},
       {r9("variant_rate", "variant_rate")}, {r9("pooled_proportion", "pooled_proportion")},
       {r9("standard_error", "standard_error")}, {r9("z_score", "z_score")},
       {r9("absolute_lift", "absolute_lift")}, {r9("relative_lift_pct", "relative_lift_pct")},
       {r9("x_results.p_value", "p_value")}, x_results.p_value < 0.05 AS is_significant,
       0.05::DOUBLE AS alpha,
       {r9("absolute_lift - margin", "ci_lower")}, {r9("absolute_lift + margin", "ci_upper")},
       {r9("absolute_lift", "ci_center")}, {r9("margin", "margin_of_error")},
       0.95::DOUBLE AS confidence_level, {r9("h", "effect_size")},
       {r9("achieved_power", "achieved_power")}, required_sample_size_per_group,
       achieved_power >= 0.8 AS is_adequately_powered, {r9("mde", "mde")},
       {r9(angle("control_rate"), "phi_control")}, {r9(angle("variant_rate"), "phi_variant")},
       {r9("h", "cohens_h")},
       CASE WHEN abs(h) >= 0.8 THEN 'large' WHEN abs(h) >= 0.5 THEN 'medium'
            WHEN abs(h) >= 0.2 THEN 'small' ELSE 'negligible' END AS magnitude,
       {r9("(control_users + variant_users) * 0.5::DOUBLE", "control_expected")},
       {r9("(control_users + variant_users) * 0.5::DOUBLE", "variant_expected")},
       {r9("root * root", "chi_square_statistic")}, {r9("srm_p_value", "srm_p_value")},
       srm_p_value < 0.01 AS srm_detected, {r9("q", "corrected_p_value")},
       control_outliers, variant_outliers, control_outliers_material, variant_outliers_material,
       control_worst_step, variant_worst_step
FROM x_results JOIN (SELECT experiment_name, metric_name, q FROM x_bh)
       USING (experiment_name, metric_name)
LEFT JOIN (SELECT experiment_name, {_arm("outlier_count", "control")} AS control_outliers,
             {_arm("outlier_count", "variant")} AS variant_outliers,
             bool_or(mean_difference_pct > 5) FILTER (variant = 'control') AS control_outliers_material,
             bool_or(mean_difference_pct > 5) FILTER (variant = 'variant') AS variant_outliers_material
           FROM x_impact GROUP BY 1) USING (experiment_name)
LEFT JOIN (SELECT experiment_name, {_arm("step_name", "control")} AS control_worst_step,
             {_arm("step_name", "variant")} AS variant_worst_step
           FROM x_worst GROUP BY 1) USING (experiment_name)""",
)
expect(
    "export_stat_results",
    f"""SELECT experiment_name, '2024-02-01T00:00:00' AS generated_at, {r9("p_value", "p_value")},
       {r9("z_score", "z_score")}, p_value < 0.05 AS is_significant,
       {r9("absolute_lift", "absolute_lift")}, {r9("relative_lift_pct", "relative_lift_pct")},
       {r9("absolute_lift - margin", "ci_lower")}, {r9("absolute_lift + margin", "ci_upper")},
       {r9("achieved_power", "achieved_power")}, {r9("h", "cohens_h")},
       srm_p_value < 0.01 AS srm_detected, {r9("srm_p_value", "srm_p_value")} FROM x_results""",
)
BLOCKS["x_inputs"] = f"""
SELECT experiment_name, p_value, achieved_power, relative_lift_pct / 100 AS lift,
       control_bounce_rate AS bc, variant_bounce_rate AS bv, srm_p_value < 0.01 AS srm,
       control_users AS n, required_sample_size_per_group AS need
FROM x_results JOIN x_guard USING (experiment_name)"""
_CHANGE = "((bv - bc) / nullif(bc, 0))"
_SHARE = "(CAST(n AS DOUBLE) / nullif(need, 0))"
_RULE_SQL = {
    "rule_srm": (
        "srm_rule", "NOT srm", "CAST(srm AS INTEGER)", "0.0",
        "if(srm, 'Traffic split deviates from the plan; results can not be trusted.', "
        "'Traffic split is consistent with the plan.')",
    ),
    "rule_significance": (
        "significance_rule", "p_value < 0.05", "p_value", "0.05",
        "printf(if(p_value < 0.05, 'Significant: p = %.4f, alpha = 0.0500.', "
        "'Not significant: p = %.4f, alpha = 0.0500.'), p_value)",
    ),
    "rule_power": (
        "power_rule", "achieved_power >= 0.8", "achieved_power", "0.8",
        "printf(if(achieved_power >= 0.8, 'Power %.2f%% reaches the target of 80.00%%.', "
        "'Power %.2f%% misses the target of 80.00%%.'), achieved_power * 100)",
    ),
    "rule_practical_uplift": (
        "practical_uplift_rule", "lift >= 0.05", "lift", "0.05",
        "printf(if(lift >= 0.05, 'Relative lift %.2f%% reaches the minimum of 5.00%%.', "
        "'Relative lift %.2f%% is below the minimum of 5.00%%.'), lift * 100)",
    ),
    "rule_guardrail_bounce": (
        "guardrail_bounce_rate_rule", f"bc = 0 OR {_CHANGE} <= 0.02",
        f"if(bc = 0, 0.0, {_CHANGE})", "0.02",
        "if(bc = 0, 'Bounce rate not compared: control has no bounces.', "
        f"printf(if({_CHANGE} <= 0.02, 'Bounce rate change %.2f%% is within the tolerance of "
        f"2.00%%.', 'Bounce rate change %.2f%% exceeds the tolerance of 2.00%%.'), {_CHANGE} * 100))",
    ),
    "rule_sample_size": (
        "sample_size_rule", f"need <= 0 OR {_SHARE} >= 1",
        f"if(need <= 0, 1.0, {_SHARE})", "1.0",
        "if(need <= 0, 'Sample size not compared: none is required.', "
        "'Sample size ' || if(n >= need, 'reached: ', 'not reached: ') || n || ' of ' || need "
        "|| ' users.')",
    ),
}


def _rule_row(key: str, order: str = "") -> str:
    name, passed, actual, threshold, message = _RULE_SQL[key]
    return (
        f"SELECT experiment_name, {order}'{name}' AS rule_name, {passed} AS passed, "
        f"{r9(f'CAST({actual} AS DOUBLE)', 'actual_value')}, {threshold}::DOUBLE AS threshold, "
        f"{message} AS message FROM x_inputs"
    )


for _key in _RULE_SQL:
    expect(_key, _rule_row(_key))
BLOCKS["x_rules"] = " UNION ALL ".join(
    _rule_row(key, f"{i} AS rule_order, ") for i, key in enumerate(_RULE_SQL, 1)
)
expect("evaluate_rules", "SELECT * FROM x_rules")
BLOCKS["x_confidence"] = """
SELECT experiment_name, count(*) FILTER (passed) AS rules_passed, count(*) AS rules_total,
       CASE count(*) FILTER (NOT passed) WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MEDIUM'
            WHEN 2 THEN 'MEDIUM' ELSE 'LOW' END AS confidence
FROM x_rules GROUP BY experiment_name"""
expect("recommendation_confidence", "SELECT * FROM x_confidence")
BLOCKS["x_advice"] = f"""
SELECT experiment_name, recommendation,
       CASE recommendation WHEN 'LAUNCH' THEN 'Launch'
            WHEN 'CONTINUE_EXPERIMENT' THEN 'Continue Experiment'
            WHEN 'STOP_FOR_FUTILITY' THEN 'Stop For Futility'
            ELSE 'Investigate Data Quality' END AS decision, confidence,
       CASE recommendation
         WHEN 'LAUNCH' THEN printf('Conversion rose by %.2f%% (p = %.4f, power %.2f%%) and the guardrails hold: launch the variant to all users.', lift * 100, p_value, achieved_power * 100)
         WHEN 'CONTINUE_EXPERIMENT' THEN printf('Inconclusive at a lift of %.2f%% (p = %.4f, power %.2f%%): continue until %d users per arm are reached.', lift * 100, p_value, achieved_power * 100, need)
         WHEN 'STOP_FOR_FUTILITY' THEN printf('No significant change (p = %.4f) although the required %d users per arm were reached: stop and keep control.', p_value, need)
         ELSE printf('The allocation or a guardrail is off, so the result (p = %.4f) can not be trusted: investigate the data first.', p_value)
       END AS summary
FROM (SELECT *, CASE WHEN srm THEN 'INVESTIGATE_DATA_QUALITY'
                     WHEN p_value >= 0.05 AND n < need THEN 'CONTINUE_EXPERIMENT'
                     WHEN p_value >= 0.05 THEN 'STOP_FOR_FUTILITY'
                     WHEN achieved_power < 0.8 OR lift < 0.05 THEN 'CONTINUE_EXPERIMENT'
                     WHEN bc = 0 OR {_CHANGE} <= 0.02 THEN 'LAUNCH'
                     ELSE 'INVESTIGATE_DATA_QUALITY' END AS recommendation
      FROM x_inputs) JOIN x_confidence USING (experiment_name)"""
expect(
    "recommendation",
    f"""SELECT a.*, rules, {r9("p_value", "p_value")}, {r9("lift * 100", "relative_lift_pct")},
       {r9("achieved_power", "achieved_power")}, CAST(n AS DOUBLE) AS control_n, CAST(need AS DOUBLE) AS required_n
FROM x_advice a JOIN x_inputs USING (experiment_name)
JOIN (SELECT experiment_name, string_agg(rule_name || '=' || passed, ';' ORDER BY rule_order) AS rules
      FROM x_rules GROUP BY experiment_name) USING (experiment_name)""",
)
expect(
    "export_recommendation", "SELECT *, '2024-02-01T00:00:00' AS generated_at FROM x_advice"
)

# --- streams: the same as their batch operators --------------------------------------------

expect(
    "stream_sessionize",
    """SELECT session_id, user_id, session_start, session_end, duration_seconds, page_count, is_bounce
FROM c_sessions""",
)
expect("stream_daily_srm", _DAILY_SRM)

# --- continuing streams: their batch operators over what has arrived ------------------------

BLOCKS["x_readings"] = "SELECT unnest(range(3)) AS reading"


def _arriving(rows: str, ts: str, row_id: str) -> str:
    due = f"(epoch_us({ts}) + {row_id} % 13 * 3600000000)"
    return (
        f"SELECT *, ({due} - min({due}) OVER ()) * 3 // (max({due}) OVER () - min({due}) OVER () + 1) "
        f"AS arrival FROM {rows}"
    )


BLOCKS["x_arriving"] = _arriving("events", "ts", "event_id")
BLOCKS["x_read_events"] = "SELECT * FROM x_arriving JOIN x_readings ON arrival <= reading"
BLOCKS["x_read_numbered"] = """
SELECT *, sum(opens) OVER (PARTITION BY reading, user_id ORDER BY ts, event_id) AS session_no
FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY reading, user_id ORDER BY ts, event_id)
                          <= INTERVAL 240 MINUTE THEN 0 ELSE 1 END AS opens FROM x_read_events)"""
expect(
    "stream_continuing_sessions",
    """SELECT CAST(reading AS INTEGER) AS arrival, min(event_id) AS session_id, user_id, min(ts) AS session_start,
       max(ts) AS session_end,
       CAST((epoch_us(max(ts)) - epoch_us(min(ts))) // 1000000 AS INTEGER) AS duration_seconds,
       CAST(count(*) AS INTEGER) AS page_count, count(*) = 1 AS is_bounce,
       max(ts) + INTERVAL 240 MINUTE > any_value(newest) - INTERVAL 1 DAY AS is_open
FROM x_read_numbered JOIN (SELECT reading, max(ts) AS newest FROM x_read_events GROUP BY ALL) USING (reading)
GROUP BY reading, user_id, session_no""",
)
BLOCKS["x_arriving_users"] = _arriving("c_experiments", "assignment_timestamp", "experiment_id")
BLOCKS["x_read_days"] = """
SELECT reading, CAST(assignment_timestamp AS DATE) AS metric_date, experiment_name, variant,
       count(DISTINCT user_id) AS users_assigned
FROM x_arriving_users JOIN x_readings ON arrival <= reading WHERE NOT is_holdout GROUP BY ALL"""
BLOCKS["x_read_daily"] = f"""
SELECT *, {big("sum(users_assigned) OVER (PARTITION BY reading, experiment_name, variant ORDER BY metric_date)")}
         AS cumulative_users FROM x_read_days"""
expect(
    "stream_continuing_srm",
    _DAILY_SRM.replace("FROM v_daily", "FROM x_read_daily")
    .replace("SELECT metric_date, experiment_name,", "SELECT reading, metric_date, experiment_name,", 2)
    .replace("SELECT reading, metric_date,", "SELECT CAST(reading AS INTEGER) AS arrival, metric_date,", 1),
)
expect(
    "stream_late_rows",
    """SELECT event_id, user_id, ts AS event_timestamp FROM x_arriving
WHERE (event_id % 50 = 0 OR arrival = 2)
  AND ts <= (SELECT max(ts) FROM x_arriving WHERE arrival < 2 AND event_id % 50 <> 0) - INTERVAL 1 DAY""",
)
expect(
    "stream_daily_active",
    """SELECT CAST(reading AS INTEGER) AS arrival, CAST(ts AS DATE) AS metric_date, experiment_name, variant,
       count(DISTINCT user_id) AS active_users
FROM x_read_events JOIN x_active USING (user_id)
WHERE reading > 0 OR user_id % 3 <> 0 GROUP BY ALL""",
)

# --- views brought up to date from changes: the same as when they are computed at once --------

EXPECTED_SQL["refresh_users_from_changes"] = EXPECTED_SQL["mv_user_experiment_summary"]
EXPECTED_SQL["refresh_daily_from_changes"] = EXPECTED_SQL["mv_daily_conversion"]

# --- purchases from the assignment on --------------------------------------------------------

BLOCKS["x_first"] = """
SELECT experiment_name, variant, user_id, min(assignment_timestamp) AS first_assigned
FROM x_active GROUP BY ALL"""
BLOCKS["x_orders_after"] = """
SELECT a.*, o.* EXCLUDE (user_id) FROM x_active a JOIN x_first f USING (experiment_name, variant, user_id)
JOIN c_orders o ON o.user_id = a.user_id AND o.order_timestamp >= f.first_assigned"""
BLOCKS["x_sales_after"] = f"SELECT * FROM x_orders_after WHERE {_SALE}"


def _after(block: str) -> str:
    """A view whose purchases are those from the assignment on."""
    return (
        BLOCKS[block]
        .replace("FROM x_arm_sales", "FROM x_sales_after")
        .replace("FROM x_active JOIN c_orders USING (user_id)", "FROM x_orders_after")
    )


expect(
    "experiment_summary_after",
    _round_all(f"({_after('v_summary')})", "conversion_rate revenue_per_visitor average_order_value"),
)
expect(
    "daily_metrics_after",
    _round_all(f"(SELECT * EXCLUDE (cumulative_conversion_rate) FROM ({_after('v_daily')}))", _DAILY_DOUBLES),
)
expect(
    "revenue_summary_after",
    _round_all(f"({_after('v_revenue')})", "revenue_per_visitor average_order_value refund_rate"),
)

# --- dense days, states and estimates ---------------------------------------------------------

BLOCKS["x_watched"] = """
SELECT experiment_name, country_name, variant, CAST(assignment_timestamp AS DATE) AS metric_date, user_id
FROM x_active JOIN x_profiles USING (user_id)"""
BLOCKS["x_spine"] = """
SELECT experiment_name, country_name, variant, CAST(unnest(range(first, last + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE)
         AS metric_date
FROM (SELECT DISTINCT experiment_name, country_name, variant FROM x_watched)
JOIN (SELECT experiment_name, min(metric_date) AS first, max(metric_date) AS last FROM x_watched GROUP BY ALL)
  USING (experiment_name)"""
BLOCKS["x_dense"] = """
SELECT s.*, (SELECT count(DISTINCT user_id) FROM x_watched w WHERE w.experiment_name = s.experiment_name
             AND w.country_name = s.country_name AND w.variant = s.variant AND w.metric_date = s.metric_date)
         AS users_assigned
FROM x_spine s"""
BLOCKS["x_dense_daily"] = """
SELECT *, sum(users_assigned) OVER (PARTITION BY experiment_name, country_name, variant ORDER BY metric_date)
         AS cumulative_users FROM x_dense"""
expect(
    "dense_daily_srm",
    _DAILY_SRM.replace("FROM v_daily", "FROM x_dense_daily")
    .replace("SELECT metric_date, experiment_name,", "SELECT metric_date, experiment_name, country_name,")
    .replace("cc + cv > 1000", "cc + cv > 20"),
)
BLOCKS["x_active_days"] = """
SELECT DISTINCT CASE WHEN CAST(session_start AS DATE) < date '2024-01-11' THEN 'first' ELSE 'second' END AS period,
       experiment_name, variant, CAST(u.device_id AS VARCHAR) AS segment, user_id
FROM c_sessions JOIN x_active USING (user_id) JOIN c_users u USING (user_id)"""
expect(
    "distinct_users_sketch",
    "\nUNION ALL ".join(
        f"SELECT {period} AS period, experiment_name, variant, {segment} AS segment, "
        "count(DISTINCT user_id) AS active_users, true AS within_bound FROM x_active_days GROUP BY ALL"
        for period in ("period", "'all'")
        for segment in ("segment", "'all'")
    ),
)
_NEAR = ", ".join(f"true AS {p}_near" for p in ("p25", "p50", "p75", "p95"))
expect(
    "session_metrics_approx",
    f"""SELECT experiment_name, variant, total_sessions, unique_users, avg_session_duration_seconds,
       avg_pages_per_session, bounce_rate, bounced_sessions, sessions_per_user, avg_sessions_per_user, {_NEAR}
FROM v_sessions""",
)
expect(
    "revenue_per_visitor_approx",
    f"""SELECT experiment_name, variant, total_users, gross_revenue AS total_revenue,
       {r9("revenue_per_visitor", "revenue_per_visitor")}, {r9("average_order_value", "avg_order_value")},
       {r9("refund_rate", "refund_rate")}, {_NEAR} FROM v_revenue""",
)

# --- the report laid out, and blocks -----------------------------------------------------------


def _long(section: str, item: str, metrics: str, source: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT experiment_name, '{section}' AS section, {item} AS item, '{m}' AS metric, "
        f"{r9(f'CAST({m} AS DOUBLE)', 'value')} FROM {source}"
        for m in metrics.split()
    )


expect(
    "experiment_report",
    "\nUNION ALL ".join(
        [
            _long(
                "metrics", "'all'",
                "control_users variant_users control_conversion_rate variant_conversion_rate absolute_lift "
                "relative_lift control_revenue_per_visitor variant_revenue_per_visitor control_aov variant_aov "
                "control_bounce_rate variant_bounce_rate",
                f"({EXPECTED_SQL['all_metrics']})",
            ),
            _long("funnel", "variant || ' ' || step_name", "users_reached drop_off_count cumulative_rate", "x_forward"),
            _long(
                "segments", "dimension || ' ' || segment",
                "total_users_control total_users_variant purchasers_control purchasers_variant absolute_lift "
                "relative_lift",
                "x_report",
            ),
            _long(
                "daily", "metric_date || ' ' || variant",
                "users_assigned purchasing_users order_count daily_revenue cumulative_users cumulative_purchasers "
                "cumulative_conversion_rate",
                "v_daily",
            ),
        ]
    ),
)
expect(
    "block_sample",
    f"""SELECT order_date, count(*) AS orders, {money("sum(order_value)")} AS revenue, count(DISTINCT user_id) AS users
FROM (SELECT *, CAST(order_timestamp AS DATE) AS order_date FROM c_orders)
WHERE CAST('0x' || substr(md5('block 42:' || order_date), 1, 8) AS BIGINT) % 1000000 < 250000
GROUP BY order_date""",
)
