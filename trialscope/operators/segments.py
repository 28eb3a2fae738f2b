"""Conversion by user segment, over the rows of ``views.segment_conversion``.

Everything here works on the segment summary, whose size is bounded by the product of the
dimension cardinalities, not by the number of users.  Results are per experiment;
``per_experiment=False`` pools the experiments.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trialscope import schemas as S
from trialscope.functions.guards import assert_columns_exist
from trialscope.functions.ratios import ratio, with_conversion_rate

DIMENSIONS = ("device_type", "channel_name", "customer_type", "country_name")
REPORT_NAMES = {
    "device_type": "device",
    "channel_name": "channel",
    "customer_type": "customer_type",
    "country_name": "top_countries",
}


def _scope(per_experiment: bool) -> list[str]:
    return ["experiment_name"] if per_experiment else []


def conversion_by_dimension(
    segments: DataFrame, dimension: str, per_experiment: bool = True
) -> DataFrame:
    assert_columns_exist(
        segments, [dimension, "variant", "total_users", "purchasers"], "conversion_by_dimension"
    )
    summed = segments.groupBy(*_scope(per_experiment), dimension, "variant").agg(
        F.sum("total_users").alias("total_users"), F.sum("purchasers").alias("purchasers")
    )
    return with_conversion_rate(summed, "purchasers", "total_users")


def conversion_by_country(
    segments: DataFrame, top_n: int = 10, per_experiment: bool = True
) -> DataFrame:
    """Conversion of the ``top_n`` countries with most users over both arms.

    The ranking pools the experiments; equal counts are ordered by name.
    """
    largest = (
        segments.groupBy("country_name")
        .agg(F.sum("total_users").alias("n"))
        .orderBy(F.col("n").desc(), "country_name")
        .limit(top_n)
    )
    rows = conversion_by_dimension(segments, "country_name", per_experiment)
    return rows.join(largest, "country_name", "left_semi").select(
        *_scope(per_experiment),
        "country_name",
        "variant",
        "total_users",
        "purchasers",
        "conversion_rate",
    )


def _lift(rates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both arms side by side for the keys that have both; relative lift 0 without a base."""
    picks = [
        F.max(F.when(F.col("variant") == arm, F.col(column))).alias(f"{column}_{arm}")
        for arm in (S.VARIANT, S.CONTROL)
        for column in ("total_users", "purchasers", "conversion_rate")
    ]
    both = (
        rates.groupBy(*keys)
        .agg(*picks)
        .where(F.col("total_users_variant").isNotNull() & F.col("total_users_control").isNotNull())
    )
    base = F.col("conversion_rate_control")
    difference = F.col("conversion_rate_variant") - base
    return both.select(
        "*",
        difference.alias("absolute_lift"),
        F.when(base > 0, ratio(difference, base)).otherwise(F.lit(0.0)).alias("relative_lift"),
    )


def segment_lift(
    segments: DataFrame, dimension: str, per_experiment: bool = True
) -> DataFrame:
    rates = conversion_by_dimension(segments, dimension, per_experiment)
    return _lift(rates, [*_scope(per_experiment), dimension])


def top_segments(
    segments: DataFrame, dimension: str, top_n: int = 5, per_experiment: bool = True
) -> DataFrame:
    """The ``top_n`` dimension values (over all rows) with the highest absolute lift."""
    lift = segment_lift(segments, dimension, per_experiment)
    return lift.orderBy(
        F.col("absolute_lift").desc(), *[F.col(c) for c in (*_scope(per_experiment), dimension)]
    ).limit(top_n)


def segment_grouping_sets(
    segments: DataFrame, dimensions: Sequence[str] = DIMENSIONS
) -> DataFrame:
    """Conversion per value of each dimension, in one pass with grouping sets."""
    base = ["experiment_name", "variant"]
    label, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for d in dimensions:
        grouped = F.grouping(d) == 0
        label = F.when(grouped, F.lit(d)).otherwise(label)
        value = F.when(grouped, F.col(d)).otherwise(value)
    summed = segments.groupingSets(
        [[F.col(c) for c in (*base, d)] for d in dimensions], *base, *dimensions
    ).agg(
        label.alias("dimension"),
        value.alias("segment"),
        F.sum("total_users").alias("total_users"),
        F.sum("purchasers").alias("purchasers"),
    )
    return with_conversion_rate(
        summed.select(
            "experiment_name", "dimension", "segment", "variant", "total_users", "purchasers"
        ),
        "purchasers",
        "total_users",
    )


def all_lifts(segments: DataFrame) -> DataFrame:
    """Lift of every value of every dimension that both arms have."""
    names = F.create_map(*[F.lit(x) for pair in REPORT_NAMES.items() for x in pair])
    lift = _lift(
        segment_grouping_sets(segments), ["experiment_name", "dimension", "segment"]
    )
    return lift.withColumn("section", names[F.col("dimension")])


def segment_report(segments: DataFrame, top_countries: int = 10) -> DataFrame:
    """Lift tables of all dimensions; countries limited to those with most control users.

    The limit is for display; tests and their corrections use ``all_lifts``.
    """
    by_size = Window.partitionBy("experiment_name", "dimension").orderBy(
        F.col("total_users_control").desc(), "segment"
    )
    return (
        all_lifts(segments)
        .withColumn("_size_rank", F.row_number().over(by_size))
        .where((F.col("dimension") != "country_name") | (F.col("_size_rank") <= top_countries))
        .drop("_size_rank")
    )
