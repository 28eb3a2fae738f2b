"""Canonical tables of an experiment warehouse: schemas, enums, lookup rows, keys.

Spark does not enforce CHECK / UNIQUE / FOREIGN KEY, so the rules are declared here as
plain data and evaluated by the operators in ``trialscope.operators.constraints``.
"""

from __future__ import annotations

CONTROL = "control"
VARIANT = "variant"

CORE_TABLES = ("users", "experiments", "sessions", "events", "orders")
LOOKUP_TABLES = (
    "regions",
    "countries",
    "devices",
    "browsers",
    "acquisition_channels",
    "event_types",
)

# Allowed values of the enum columns.
CUSTOMER_TYPES = ("new", "returning", "high_value")
VARIANTS = (CONTROL, VARIANT)
PAYMENT_STATUSES = ("completed", "failed", "pending", "refunded")
PAYMENT_METHODS = (
    "credit_card",
    "debit_card",
    "paypal",
    "apple_pay",
    "google_pay",
    "bank_transfer",
)
EVENT_CATEGORIES = ("navigation", "engagement", "commerce", "error", "system")

# Lookup rows; surrogate ids are the 1-based positions.
REGION_NAMES = (
    "North America",
    "Europe",
    "Asia Pacific",
    "Latin America",
    "Middle East & Africa",
)
COUNTRY_ROWS = (
    ("US", "United States", "North America"),
    ("CA", "Canada", "North America"),
    ("MX", "Mexico", "Latin America"),
    ("BR", "Brazil", "Latin America"),
    ("AR", "Argentina", "Latin America"),
    ("GB", "United Kingdom", "Europe"),
    ("DE", "Germany", "Europe"),
    ("FR", "France", "Europe"),
    ("IT", "Italy", "Europe"),
    ("ES", "Spain", "Europe"),
    ("NL", "Netherlands", "Europe"),
    ("SE", "Sweden", "Europe"),
    ("AU", "Australia", "Asia Pacific"),
    ("JP", "Japan", "Asia Pacific"),
    ("IN", "India", "Asia Pacific"),
    ("SG", "Singapore", "Asia Pacific"),
    ("KR", "South Korea", "Asia Pacific"),
    ("CN", "China", "Asia Pacific"),
    ("AE", "United Arab Emirates", "Middle East & Africa"),
    ("ZA", "South Africa", "Middle East & Africa"),
)
DEVICE_TYPES = ("desktop", "mobile", "tablet")
BROWSER_NAMES = ("Chrome", "Firefox", "Safari", "Edge", "Opera", "Samsung Internet")
CHANNEL_NAMES = (
    "organic_search",
    "paid_search",
    "paid_social",
    "organic_social",
    "email",
    "direct",
    "referral",
    "display_ads",
    "affiliate",
)
EVENT_TYPE_ROWS = (
    ("page_view", "navigation", 1),
    ("product_view", "navigation", 2),
    ("search", "engagement", None),
    ("add_to_cart", "commerce", 3),
    ("cart_view", "navigation", 3),
    ("checkout_start", "commerce", 4),
    ("checkout_address", "commerce", 4),
    ("checkout_payment", "commerce", 4),
    ("purchase", "commerce", 5),
    ("purchase_failed", "error", 5),
    ("refund", "commerce", None),
    ("session_start", "system", None),
    ("session_end", "system", None),
    ("scroll", "engagement", None),
    ("click", "engagement", None),
    ("wishlist_add", "engagement", None),
    ("coupon_applied", "commerce", None),
    ("checkout_abandoned", "commerce", None),
)

# The five funnel steps reported, in order, with the event that marks each.
FUNNEL_STEPS = (
    (1, "1. Landing", "landing_users", "page_view"),
    (2, "2. Product", "product_users", "product_view"),
    (3, "3. Cart", "cart_users", "add_to_cart"),
    (4, "4. Checkout", "checkout_users", "checkout_start"),
    (5, "5. Purchase", "purchase_users", "purchase"),
)


# Order value buckets, as (upper bound, label); the last takes the rest.
VALUE_BUCKETS = (
    (20, "1. Under $20"),
    (50, "2. $20 - $49.99"),
    (100, "3. $50 - $99.99"),
    (200, "4. $100 - $199.99"),
    (None, "5. $200+"),
)


def event_type_id(name: str) -> int:
    return [row[0] for row in EVENT_TYPE_ROWS].index(name) + 1


# DDL strings so the schemas can be built without a running session.
TABLE_DDL: dict[str, str] = {
    "regions": "region_id int, region_name string",
    "countries": "country_id int, country_code string, country_name string, region_id int",
    "devices": "device_id int, device_type string",
    "browsers": "browser_id int, browser_name string",
    "acquisition_channels": "channel_id int, channel_name string",
    "event_types": "event_type_id int, event_name string, event_category string, funnel_step int",
    "users": (
        "user_id string, signup_date date, country_id int, device_id int, browser_id int, "
        "channel_id int, customer_type string, operating_system string, is_returning boolean"
    ),
    "experiments": (
        "experiment_id string, experiment_name string, variant string, user_id string, "
        "assignment_timestamp timestamp, is_holdout boolean"
    ),
    "sessions": (
        "session_id string, user_id string, session_start timestamp, session_end timestamp, "
        "duration_seconds int, device_id int, browser_id int, page_count int, is_bounce boolean"
    ),
    "events": (
        "event_id string, session_id string, user_id string, experiment_id string, "
        "event_type_id int, event_timestamp timestamp, page_url string, revenue decimal(12,4), "
        "is_mobile boolean"
    ),
    "orders": (
        "order_id string, user_id string, session_id string, event_id string, "
        "order_timestamp timestamp, order_value decimal(12,2), payment_method string, "
        "is_refund boolean, payment_status string"
    ),
}

# Primary keys.
PRIMARY_KEYS: dict[str, str] = {
    "regions": "region_id",
    "countries": "country_id",
    "devices": "device_id",
    "browsers": "browser_id",
    "acquisition_channels": "channel_id",
    "event_types": "event_type_id",
    "users": "user_id",
    "experiments": "experiment_id",
    "sessions": "session_id",
    "events": "event_id",
    "orders": "order_id",
}

# Further UNIQUE constraints, (table, columns).
UNIQUE_KEYS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("regions", ("region_name",)),
    ("countries", ("country_code",)),
    ("countries", ("country_name",)),
    ("devices", ("device_type",)),
    ("browsers", ("browser_name",)),
    ("acquisition_channels", ("channel_name",)),
    ("event_types", ("event_name",)),
    ("experiments", ("user_id", "experiment_name")),
)

# Foreign keys, (child table, child column, parent table).  The parent column is its primary key.
FOREIGN_KEYS: tuple[tuple[str, str, str], ...] = (
    ("countries", "region_id", "regions"),
    ("users", "country_id", "countries"),
    ("users", "device_id", "devices"),
    ("users", "browser_id", "browsers"),
    ("users", "channel_id", "acquisition_channels"),
    ("experiments", "user_id", "users"),
    ("sessions", "user_id", "users"),
    ("sessions", "device_id", "devices"),
    ("sessions", "browser_id", "browsers"),
    ("events", "session_id", "sessions"),
    ("events", "user_id", "users"),
    ("events", "experiment_id", "experiments"),
    ("events", "event_type_id", "event_types"),
    ("orders", "user_id", "users"),
    ("orders", "session_id", "sessions"),
    ("orders", "event_id", "events"),
)

# Columns of TABLE_DDL that may be NULL; all others are NOT NULL.
NULLABLE: dict[str, tuple[str, ...]] = {
    "event_types": ("funnel_step",),
    "users": ("operating_system",),
    "events": ("experiment_id", "page_url", "revenue"),
    "orders": ("event_id",),
}

# Columns that may be NULL but must be there when a table is loaded.
PRESENT_THOUGH_NULLABLE = ("experiment_id", "revenue")

_KINDS = {"string": "str", "date": "datetime", "timestamp": "datetime", "int": "int", "boolean": "bool"}


def declared_columns(table: str) -> dict[str, str]:
    """Column name -> declared type."""
    return dict(column.split() for column in TABLE_DDL[table].split(", "))


def not_null(table: str) -> list[str]:
    return [c for c in declared_columns(table) if c not in NULLABLE.get(table, ())]


def load_contract(table: str) -> dict[str, tuple[str, bool]]:
    """Columns that a loaded table must have: name -> (kind, nullable)."""
    required = not_null(table)
    return {
        column: (_KINDS.get(kind, "float"), column not in required)
        for column, kind in declared_columns(table).items()
        if column in required or column in PRESENT_THOUGH_NULLABLE
    }


ENUM_COLUMNS: dict[str, dict[str, tuple[str, ...]]] = {
    "users": {"customer_type": CUSTOMER_TYPES},
    "experiments": {"variant": VARIANTS},
    "orders": {"payment_status": PAYMENT_STATUSES, "payment_method": PAYMENT_METHODS},
}
