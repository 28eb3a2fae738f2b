"""Outliers and trimmed means of per-user values.

Inputs are (group, value, weight) histograms, e.g. ``reports.revenue_histogram``; no group is
gathered in one task (see ``functions.quantiles``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialscope.functions.quantiles import percentiles, values_at_ranks, with_known_groups
from trialscope.functions.ratios import ratio

GROUP = ("experiment_name", "variant")


def iqr_bounds(
    hist: DataFrame,
    groups: Sequence[str] = GROUP,
    value: str = "revenue",
    weight: str = "w",
    multiplier: float = 3.0,
    resolution: float = 0.01,
) -> DataFrame:
    """Group size and the outlier fences; a group of fewer than four values has no fences."""
    marks = percentiles(
        hist, groups, value, weight, {"q1": 0.25, "q3": 0.75}, resolution
    )
    enough = F.col("n") >= 4
    spread = F.lit(multiplier) * (F.col("q3") - F.col("q1"))
    return marks.select(
        *groups,
        "n",
        F.when(enough, F.col("q1") - spread).alias("lower_fence"),
        F.when(enough, F.col("q3") + spread).alias("upper_fence"),
    )


def _parts(rows: DataFrame) -> int:
    """Into how many parts the rows of a group are dealt where they meet the group's marks: enough for
    all shuffle partitions if one group has most rows."""
    return max(64, 2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _with_marks(rows: DataFrame, marks: DataFrame, groups: Sequence[str], how: str) -> DataFrame:
    """Rows joined to the one row that ``marks`` has for their group.

    There are few groups, so rows are not dealt by group alone: each row goes to one of the group's
    parts by its hash, and the marks are repeated for every part.
    """
    parts = _parts(rows)
    part = F.pmod(F.xxhash64(*rows.columns), F.lit(parts)).cast("int")
    repeated = marks.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    return rows.withColumn("_part", part).join(repeated, [*groups, "_part"], how).drop("_part")


def _is_outside(value: Column) -> Column:
    v = value.cast("double")
    return F.coalesce(
        (v > F.col("upper_fence")) | (v < F.col("lower_fence")), F.lit(False)
    )


def iqr_outliers(
    values: DataFrame,
    groups: Sequence[str] = GROUP,
    value: str = "revenue",
    multiplier: float = 3.0,
    resolution: float = 0.01,
) -> DataFrame:
    """The rows of ``values`` with ``is_outlier``."""
    hist = values.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("w"))
    fences = iqr_bounds(hist, groups, value, "w", multiplier, resolution).drop("n")
    return (
        _with_marks(values, fences, groups, "left")
        .withColumn("is_outlier", _is_outside(F.col(value)))
        .drop("lower_fence", "upper_fence")
    )


def outlier_impact(
    hist: DataFrame,
    groups: Sequence[str] = GROUP,
    value: str = "revenue",
    weight: str = "w",
    multiplier: float = 3.0,
    resolution: float = 0.01,
    material_pct: float = 5.0,
) -> DataFrame:
    """Means with and without outliers per group and whether the difference is material."""
    fences = iqr_bounds(hist, groups, value, weight, multiplier, resolution)
    outside = _is_outside(F.col(value))
    w, v = F.col(weight), F.col(value)
    known = v.isNotNull()
    sums = (
        _with_marks(with_known_groups(hist, groups), fences.drop("n"), groups, "inner")
        .groupBy(*groups)
        .agg(
            F.sum(F.when(known, w)).alias("total_records"),
            F.sum(F.when(outside, w).otherwise(0)).alias("outlier_count"),
            F.sum(v * w).alias("_all"),
            F.sum(F.when(~outside, v * w)).alias("_kept"),
            F.max(v).cast("double").alias("_max"),
            F.max("upper_fence").alias("_fence"),
        )
    )
    n, bad = F.col("total_records"), F.col("outlier_count")
    mixed = (bad > 0) & (bad < n)
    with_all = ratio(F.col("_all"), n)
    staged = sums.select(
        *groups,
        "total_records",
        "outlier_count",
        ratio(bad, n).alias("outlier_fraction"),
        with_all.alias("mean_with_outliers"),
        F.when(mixed, ratio(F.col("_kept"), n - bad)).otherwise(with_all)
        .alias("mean_without_outliers"),
        F.when(mixed, F.col("_fence")).otherwise(F.col("_max")).alias("outlier_threshold"),
    )
    base = F.col("mean_without_outliers")
    moved = F.abs(F.col("mean_with_outliers") - base)
    return staged.withColumn(
        "mean_difference_pct", F.when(base > 0, ratio(moved, base) * 100).otherwise(0.0)
    ).withColumn("outliers_material", F.col("mean_difference_pct") > material_pct)


def winsorized_mean(
    hist: DataFrame,
    groups: Sequence[str] = GROUP,
    value: str = "revenue",
    weight: str = "w",
    limits: tuple[float, float] = (0.05, 0.05),
    resolution: float = 0.01,
) -> DataFrame:
    """Mean after the lowest and highest shares take the nearest kept value.

    The shares are truncated to whole counts.  Replacing the tails equals clamping every value
    between the two kept order statistics, so only those two are looked up.
    """
    low, high = limits
    n = F.col("n")
    kept = values_at_ranks(
        hist,
        groups,
        value,
        weight,
        {
            "lowest_kept": F.floor(F.lit(float(low)) * n),
            "highest_kept": n - 1 - F.floor(F.lit(float(high)) * n),
        },
        resolution,
    ).drop("n")
    v = F.col(value)
    # greatest() and least() skip NULLs, so rows without a value are given no weight.
    w = F.when(v.isNotNull(), F.col(weight))
    clamped = F.least(F.greatest(v, F.col("lowest_kept")), F.col("highest_kept"))
    return (
        _with_marks(with_known_groups(hist, groups), kept, groups, "inner")
        .groupBy(*groups)
        .agg(
            F.sum(w).alias("n"),
            F.max("lowest_kept").cast("double").alias("lowest_kept"),
            F.max("highest_kept").cast("double").alias("highest_kept"),
            ratio(F.sum(clamped * w), F.sum(w)).alias("winsorized_mean"),
        )
    )
