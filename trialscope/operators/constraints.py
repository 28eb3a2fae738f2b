"""CHECK, UNIQUE, FOREIGN KEY and load-contract checks as counting jobs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialscope import schemas as S


class SchemaViolation(ValueError):
    """Raised by ``assert_schema`` when a table breaks the load contract."""


def _check_rules() -> list[tuple[str, str, Column]]:
    c = F.col
    earliest = F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    return [
        ("event_types", "event_category_allowed", c("event_category").isin(*S.EVENT_CATEGORIES)),
        ("event_types", "funnel_step_range", c("funnel_step").between(1, 10)),
        ("users", "customer_type_allowed", c("customer_type").isin(*S.CUSTOMER_TYPES)),
        ("users", "signup_not_in_future", c("signup_date") <= F.current_date()),
        ("experiments", "variant_allowed", c("variant").isin(*S.VARIANTS)),
        (
            "experiments",
            "assignment_since_2020",
            c("assignment_timestamp").cast("timestamp_ntz") >= earliest,
        ),
        ("sessions", "end_not_before_start", c("session_end") >= c("session_start")),
        ("sessions", "duration_not_negative", c("duration_seconds") >= 0),
        ("sessions", "page_count_positive", c("page_count") >= 1),
        ("events", "revenue_not_negative", c("revenue") >= 0),
        ("events", "event_since_2020", c("event_timestamp").cast("timestamp_ntz") >= earliest),
        ("orders", "order_value_positive", c("order_value") > 0),
        ("orders", "order_value_ceiling", c("order_value") <= 10_000),
        ("orders", "payment_status_allowed", c("payment_status").isin(*S.PAYMENT_STATUSES)),
        ("orders", "payment_method_allowed", c("payment_method").isin(*S.PAYMENT_METHODS)),
    ]


def constraint_check(t) -> DataFrame:
    """Violations of every CHECK rule; a NULL passes, as in SQL.  One pass per table."""
    by_table: dict[str, list[tuple[str, Column]]] = {}
    for table, name, holds in _check_rules():
        by_table.setdefault(table, []).append((name, holds))
    parts = []
    for table, rules in by_table.items():
        counted = t[table].agg(*[F.count_if(~holds).alias(name) for name, holds in rules])
        rows = F.array(
            *[
                F.struct(F.lit(name).alias("constraint_name"), F.col(name).alias("violations"))
                for name, _ in rules
            ]
        )
        parts.append(counted.select(F.lit(table).alias("table_name"), F.inline(rows)))
    return reduce(DataFrame.unionByName, parts)


def unique_check(t) -> DataFrame:
    """Rows beyond the first per primary or unique key; rows with a NULL key part are exempt."""
    keys = [(table, (key,)) for table, key in S.PRIMARY_KEYS.items()] + list(S.UNIQUE_KEYS)
    parts = []
    for table, columns in keys:
        present = reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])
        parts.append(
            t[table]
            .where(present)
            .groupBy(*columns)
            .agg(F.count(F.lit(1)).alias("c"))
            .agg(
                F.lit(table).alias("table_name"),
                F.lit(", ".join(columns)).alias("key_columns"),
                F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("duplicate_rows"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _lookup_orphans(t, child: str, keys: Sequence[tuple[str, str]]) -> DataFrame:
    """All lookup references of a child in one pass.

    The child is folded to its combinations of lookup keys, which are few, and these meet the
    lookup tables.
    """
    columns = [column for column, _ in keys]
    folded = t[child].groupBy(*columns).agg(F.count(F.lit(1)).alias("c"))
    sums = []
    for column, parent in keys:
        known = t[parent].select(
            F.col(S.PRIMARY_KEYS[parent]).alias(f"_{column}"), F.lit(True).alias(f"_{column}_known")
        )
        folded = folded.join(known, F.col(column) == F.col(f"_{column}"), "left")
        lost = F.col(column).isNotNull() & F.col(f"_{column}_known").isNull()
        sums.append(F.sum(F.when(lost, F.col("c")).otherwise(0)).alias(f"_{column}_lost"))
    counted = folded.agg(*sums)
    rows = F.array(
        *[
            F.struct(
                F.lit(child).alias("child_table"),
                F.lit(column).alias("child_column"),
                F.lit(parent).alias("parent_table"),
                F.coalesce(f"_{column}_lost", F.lit(0)).alias("orphan_rows"),
            )
            for column, parent in keys
        ]
    )
    return counted.select(F.inline(rows))


def _entity_orphans(t, child: str, column: str, parent: str) -> DataFrame:
    """One reference to a large table: the child is folded to one row per key first, so a key
    that many rows share is looked up once."""
    keys = (
        t[child]
        .where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_k"))
        .agg(F.count(F.lit(1)).alias("c"))
    )
    parents = t[parent].select(F.col(S.PRIMARY_KEYS[parent]).alias("_p"))
    return keys.join(parents, F.col("_k") == F.col("_p"), "left_anti").agg(
        F.lit(child).alias("child_table"),
        F.lit(column).alias("child_column"),
        F.lit(parent).alias("parent_table"),
        F.coalesce(F.sum("c"), F.lit(0)).alias("orphan_rows"),
    )


def fk_check(t) -> DataFrame:
    """Child rows without a parent for each foreign key; a NULL key passes."""
    lookups: dict[str, list[tuple[str, str]]] = {}
    parts = []
    for child, column, parent in S.FOREIGN_KEYS:
        if parent in S.LOOKUP_TABLES:
            lookups.setdefault(child, []).append((column, parent))
        else:
            parts.append(_entity_orphans(t, child, column, parent))
    parts += [_lookup_orphans(t, child, keys) for child, keys in lookups.items()]
    return reduce(DataFrame.unionByName, parts)


def _sample(df: DataFrame, column: str, bad: Column, size: int = 5) -> DataFrame:
    """The first few distinct bad values, in order, as one string."""
    return (
        df.where(bad)
        .select(F.col(column).cast("string").alias("v"))
        .distinct()
        .orderBy("v")
        .limit(size)
        .agg(F.array_join(F.sort_array(F.collect_list("v")), ", ").alias("sample"))
    )


def _contract_rows(df: DataFrame, table: str) -> DataFrame:
    contract = S.load_contract(table)
    enums = {c: v for c, v in S.ENUM_COLUMNS.get(table, {}).items() if c in df.columns}
    counters = [F.count(F.lit(1)).alias("_rows")]
    checks: list[tuple[str | None, str, str, Column]] = []

    def add(column: str | None, check: str, severity: str, counter: Column) -> None:
        name = f"_c{len(counters)}"
        counters.append(counter.alias(name))
        checks.append((column, check, severity, F.col(name)))

    for column, (kind, nullable) in contract.items():
        if column not in df.columns:
            add(column, "column_present", "ERROR", F.max(F.lit(1)))
            continue
        c = F.col(column)
        add(column, "column_present", "ERROR", F.max(F.lit(0)))
        if not nullable:
            add(column, "not_null", "ERROR", F.count_if(c.isNull()))
        if kind == "float":
            add(column, "not_negative", "WARNING", F.count_if(c.try_cast("double") < 0))
        if kind == "int":
            unreadable = c.isNotNull() & c.cast("string").try_cast("double").isNull()
            add(column, "numeric", "ERROR", F.count_if(unreadable))
    for column, allowed in enums.items():
        bad = F.col(column).isNotNull() & ~F.col(column).isin(*allowed)
        add(column, "allowed_values", "ERROR", F.count_if(bad))

    def record(column, check, severity, violations) -> Column:
        return F.struct(
            F.lit(column).cast("string").alias("column_name"),
            F.lit(check).alias("check_name"),
            F.lit(severity).alias("severity"),
            violations.cast("bigint").alias("violations"),
        )

    # An empty table reports nothing else.
    empty = F.array(record(None, "not_empty", "ERROR", F.lit(1)))
    filled = F.array(
        record(None, "not_empty", "ERROR", F.lit(0)), *[record(*check) for check in checks]
    )
    rows = df.agg(*counters).select(
        F.inline(F.when(F.col("_rows") > 0, filled).otherwise(empty)),
        F.lit(None).cast("string").alias("sample"),
    )

    key = f"{table[:-1]}_id" if table.endswith("s") else f"{table}_id"
    if key in df.columns:
        extra = df.groupBy(key).agg(F.count(F.lit(1)).alias("c")).agg(
            F.sum(F.col("c") - 1).alias("violations")
        )
        rows = rows.unionByName(
            extra.where("violations is not null").select(
                F.lit(key).alias("column_name"),
                F.lit("unique_key").alias("check_name"),
                F.lit("ERROR").alias("severity"),
                "violations",
                F.lit(None).cast("string").alias("sample"),
            )
        )
    for column, allowed in enums.items():
        bad = F.col(column).isNotNull() & ~F.col(column).isin(*allowed)
        rows = rows.unionByName(
            _sample(df, column, bad).where("sample <> ''").select(
                F.lit(column).alias("column_name"),
                F.lit("allowed_values").alias("check_name"),
                F.lit("ERROR").alias("severity"),
                F.lit(0).cast("bigint").alias("violations"),
                "sample",
            )
        )
    return (
        rows.groupBy("column_name", "check_name", "severity")
        .agg(F.sum("violations").alias("violations"), F.max("sample").alias("sample"))
        .select(F.lit(table).alias("table_name"), "*")
    )


def schema_check(t, issues_only: bool = True) -> DataFrame:
    """Load contract of the five core tables; by default only violated checks are returned.

    Tables without a contract are skipped.  ``sample`` lists up to five bad enum values.
    """
    parts = [_contract_rows(t[name], name) for name in S.CORE_TABLES if name in t]
    rows = reduce(DataFrame.unionByName, parts)
    return rows.where(F.col("violations") > 0) if issues_only else rows


def assert_schema(t) -> DataFrame:
    """``schema_check`` that raises on ERROR rows; warnings are returned.

    There is at most one row per column and check of the contract, and the error names all of them.
    """
    issues = schema_check(t)
    errors = issues.where(F.col("severity") == "ERROR").collect()
    if errors:
        named = [f"{r.table_name}.{r.column_name}: {r.check_name} ({r.violations})" for r in errors]
        raise SchemaViolation("; ".join(named))
    return issues
