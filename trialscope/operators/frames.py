"""General DataFrame helpers: splitting, date filters, joins with counts, profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialscope import schemas as S
from trialscope.functions.guards import assert_columns_exist


def split_by_variant(
    df: DataFrame,
    column: str = "variant",
    control: str = S.CONTROL,
    variant: str = S.VARIANT,
    shown: int = 50,
) -> tuple[DataFrame, DataFrame]:
    """(control rows, variant rows).

    Raises ``ValueError`` when one of the two is absent, with the number of labels that are present
    and the ``shown`` first of them.
    """
    assert_columns_exist(df, [column], "split_by_variant")
    parts = df.where(F.col(column) == control), df.where(F.col(column) == variant)
    for label, part in zip((control, variant), parts):
        if part.isEmpty():
            labels = df.select(column).distinct()
            first = [row[0] for row in labels.orderBy(column).limit(shown).collect()]
            raise ValueError(f"no rows with {column} = {label!r}; found {labels.count()}: {first}")
    return parts


def filter_date_range(
    df: DataFrame, column: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Rows between two ISO dates or timestamps, both inclusive; an open side is None.

    The bounds are literals of the column's own type, so they reach the file scan.
    """
    assert_columns_exist(df, [column], "filter_date_range")
    kind = df.schema[column].dataType
    if start:
        df = df.where(F.col(column) >= F.lit(start).cast(kind))
    if end:
        df = df.where(F.col(column) <= F.lit(end).cast(kind))
    return df


def safe_merge(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join after checking that both sides have the keys."""
    keys = [on] if isinstance(on, str) else list(on)
    assert_columns_exist(left, keys, "safe_merge left side")
    assert_columns_exist(right, keys, "safe_merge right side")
    return left.join(right, keys, how)


def merge_counts(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner"
) -> DataFrame:
    """Row counts of both inputs and of their join: (left_rows, right_rows, result_rows).

    The join is not carried out: both sides are folded to a count per key, which also keeps a
    key that is frequent on both sides from multiplying out.
    """
    keys = [on] if isinstance(on, str) else list(on)
    assert_columns_exist(left, keys, "merge_counts left side")
    assert_columns_exist(right, keys, "merge_counts right side")
    l = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("l"))
    r = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("r"))
    n_left, n_right = F.col("l"), F.col("r")
    pairs = {
        "inner": n_left * n_right,
        "left": n_left * F.coalesce(n_right, F.lit(1)),
        "right": F.coalesce(n_left, F.lit(1)) * n_right,
        "outer": F.coalesce(n_left, F.lit(1)) * F.coalesce(n_right, F.lit(1)),
    }[how]
    return l.join(r, keys, "full").agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("r"), F.lit(0)).alias("right_rows"),
        F.coalesce(F.sum(pairs), F.lit(0)).cast("bigint").alias("result_rows"),
    )


def null_profile(df: DataFrame, name: str) -> DataFrame:
    """Rows, NULLs and NULL share per column, from one pass over the table."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns],
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count"))
            for c in df.columns
        ]
    )
    share = F.when(
        F.col("row_count") > 0, F.col("null_count") * F.lit(100.0) / F.col("row_count")
    )
    return (
        counted.select(F.col("_rows").alias("row_count"), F.inline(rows))
        .select(
            F.lit(name).alias("table_name"),
            "column_name",
            "row_count",
            "null_count",
            share.alias("null_pct"),
        )
    )
