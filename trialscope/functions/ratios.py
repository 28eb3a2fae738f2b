"""Column helpers for rates and lifts.

ANSI mode is on in Spark 4, so every division states what a zero denominator means.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialscope.functions.guards import assert_columns_exist

MONEY = "decimal(38,2)"


def null_if_zero(denominator: Column) -> Column:
    return F.when(denominator != 0, denominator)


def ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double; NULL when the denominator is 0 or NULL."""
    return numerator.cast("double") / null_if_zero(denominator.cast("double"))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double; 0 for a zero denominator, NULL stays NULL."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(ratio(numerator, denominator))


def rounded_quotient(numerator: Column, denominator: Column, places: int) -> Column:
    """Quotient of two non-negative integers, rounded half away from zero.

    Integer arithmetic keeps the tie rule exact, which rounding a double would not.
    """
    scale = 10**places
    doubled = (numerator * F.lit(2 * scale) + denominator).cast("decimal(38,0)")
    steps = F.floor(doubled / null_if_zero(denominator * F.lit(2)).cast("decimal(38,0)"))
    return steps.cast("double") / F.lit(float(scale))


def with_conversion_rate(
    df: DataFrame, numerator: str, denominator: str, output: str = "conversion_rate"
) -> DataFrame:
    """Append a rate column that is 0 where the denominator is 0."""
    assert_columns_exist(df, [numerator, denominator], "with_conversion_rate")
    return df.withColumn(output, ratio_or_zero(F.col(numerator), F.col(denominator)))


def with_lift(df: DataFrame, control_rate: str, variant_rate: str) -> DataFrame:
    """Append absolute and relative lift, as fractions and in percent.

    A zero control rate leaves the lift undefined: all four are NULL and ``is_defined`` is false
    (a column can not raise for one row and keep the others).
    """
    assert_columns_exist(df, [control_rate, variant_rate], "with_lift")
    control, variant = F.col(control_rate), F.col(variant_rate)
    defined = control != 0
    absolute = F.when(defined, variant - control)
    relative = ratio(absolute, control)
    return df.select(
        "*",
        absolute.alias("absolute_lift"),
        relative.alias("relative_lift"),
        (absolute * 100).alias("absolute_lift_pct"),
        (relative * 100).alias("relative_lift_pct"),
        F.coalesce(defined, F.lit(False)).alias("is_defined"),
    )
