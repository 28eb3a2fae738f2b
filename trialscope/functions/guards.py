"""Fail-fast checks used at the entry of operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def assert_columns_exist(df: DataFrame, required: Iterable[str], context: str = "") -> None:
    """Raise ``ValueError`` naming the columns that are absent.  Reads the schema only."""
    absent = sorted(set(required).difference(df.columns))
    if absent:
        where = f" in {context}" if context else ""
        raise ValueError(f"missing columns{where}: {absent}; present: {sorted(df.columns)}")


def assert_not_empty(df: DataFrame, context: str = "") -> None:
    """Raise ``ValueError`` when the frame has no row.  An action, but it stops at one row."""
    if df.isEmpty():
        where = f" in {context}" if context else ""
        raise ValueError(f"no rows{where}")
