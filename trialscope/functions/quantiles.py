"""Exact order statistics of large groups without gathering a group in one task.

``percentile`` keeps every distinct value of a group in the memory of a single task.  Here a
group is first reduced to a (value, weight) histogram, the histogram is summed over coarse
value buckets, and only the few buckets that hold a wanted rank are looked at value by value.

* A bucket is the integer part of ``1024 * ln(1 + |value| / resolution)`` with the sign of the
  value.  It never decreases with the value, so buckets can be cumulated in value order, and a
  group has at most 1024 * ln(1 + max / resolution) of them on each side of zero (42 000 for
  values up to 10^18 resolutions).  That bounds the window over the buckets of a group.
* Values that are multiples of ``resolution`` leave at most about value / (1024 * resolution)
  distinct values in a bucket, which bounds the window inside a bucket.

The histogram is partitioned by (group, bucket) once; the bucket sums and the look inside the
buckets both read that exchange.  Its counters travel in one array column, because columns of
their own would be pruned differently in the two branches and the exchange not be shared.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Bucket of rows without a value; below every other bucket.
NO_VALUE = -(2**62)


def _bucket(value: Column, resolution: float) -> Column:
    v = value.cast("double") / F.lit(float(resolution))
    magnitude = F.floor(F.lit(1024.0) * F.log1p(F.abs(v)))
    return F.when(v < 0, -magnitude).otherwise(magnitude)


def with_known_groups(hist: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The rows whose group columns are all known.

    Joins on the group would add this filter to the one branch they are in, and branches over
    the same histogram would no longer share their exchanges.
    """
    for g in groups:
        hist = hist.where(F.col(g).isNotNull())
    return hist


def values_at_ranks(
    hist: DataFrame,
    groups: Sequence[str],
    value: str,
    weight: str,
    ranks: Mapping[str, Column],
    resolution: float = 1.0,
    totals: Sequence[str] = (),
) -> DataFrame:
    """One row per group: ``n`` (total weight) and, per entry of ``ranks``, the value there.

    ``hist`` has one row per (group, value).  A rank is a Column over ``n`` giving a 0-based
    position in the ascending multiset in which every value is repeated ``weight`` times; rows
    with a NULL value have no rank.  ``totals`` names integer columns of ``hist`` whose sums per
    group are wanted too; these include the rows with a NULL value.  Groups with a NULL key or
    without any value are left out.
    """
    groups = list(groups)
    known = F.col(value).isNotNull()
    counters = [F.when(known, F.col(weight)).otherwise(0), *[F.col(c) for c in totals]]
    bucket = F.coalesce(_bucket(F.col(value), resolution), F.lit(NO_VALUE))
    cells = with_known_groups(hist, groups).select(
        *groups,
        F.col(value).alias("_v"),
        bucket.alias("_b"),
        F.array(*[c.cast("bigint") for c in counters]).alias("_counters"),
    ).repartition(*groups, "_b")

    in_group = Window.partitionBy(*groups)
    # Ordered by value, which keeps the value in the shared exchange; buckets order the same way,
    # and the bucket of rows without a value has no weight.
    upto_bucket = in_group.orderBy("_first").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    hit = F.filter(
        F.col("_ranks"),
        lambda r: (r["rank"] >= F.col("_before")) & (r["rank"] < F.col("_before") + F.col("_bw")),
    )
    wanted = (
        cells.groupBy(*groups, "_b")
        .agg(
            F.sum(F.col("_counters")[0]).alias("_bw"),
            F.min("_v").alias("_first"),
            *[F.sum(F.col("_counters")[i]).alias(c) for i, c in enumerate(totals, 1)],
        )
        .select(
            *groups,
            "_b",
            "_bw",
            (F.sum("_bw").over(upto_bucket) - F.col("_bw")).alias("_before"),
            F.sum("_bw").over(in_group).alias("n"),
            *[F.sum(c).over(in_group).alias(c) for c in totals],
        )
        .withColumn(
            "_ranks",
            F.array(
                *[
                    F.struct(F.lit(name).alias("name"), rank.cast("bigint").alias("rank"))
                    for name, rank in ranks.items()
                ]
            ),
        )
        .withColumn("_ranks", hit)
        .where(F.size("_ranks") > 0)
        .select(
            *[F.col(g).alias(f"_{g}") for g in groups],
            F.col("_b").alias("_wb"),
            "_before",
            "n",
            "_ranks",
            *totals,
        )
    )

    same_bucket = F.col("_b") == F.col("_wb")
    for g in groups:
        same_bucket = same_bucket & (F.col(g) == F.col(f"_{g}"))
    upto_value = (
        Window.partitionBy(*groups, "_b")
        .orderBy("_v")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = F.filter(
        F.col("_ranks"),
        lambda r: (r["rank"] < F.col("_end")) & (r["rank"] >= F.col("_end") - F.col("_w")),
    )
    hits = (
        cells.join(wanted, same_bucket)
        .withColumn("_w", F.col("_counters")[0])
        .withColumn("_end", F.col("_before") + F.sum("_w").over(upto_value))
        .select(*groups, "n", "_v", *totals, F.explode(found).alias("_hit"))
    )
    return hits.groupBy(*groups).agg(
        F.max("n").alias("n"),
        *[F.max(c).alias(c) for c in totals],
        *[F.max(F.when(F.col("_hit.name") == name, F.col("_v"))).alias(name) for name in ranks],
    )


def percentiles(
    hist: DataFrame,
    groups: Sequence[str],
    value: str,
    weight: str,
    probabilities: Mapping[str, float],
    resolution: float = 1.0,
    totals: Sequence[str] = (),
) -> DataFrame:
    """Continuous percentiles (linear interpolation) per group, as doubles, plus ``n``."""

    def position(p: float) -> Column:
        return F.lit(float(p)) * (F.col("n") - 1)

    ranks: dict[str, Column] = {}
    for name, p in probabilities.items():
        ranks[f"{name}__lo"] = F.floor(position(p))
        ranks[f"{name}__hi"] = F.ceil(position(p))
    found = values_at_ranks(hist, groups, value, weight, ranks, resolution, totals)
    columns = []
    for name, p in probabilities.items():
        lo = F.col(f"{name}__lo").cast("double")
        hi = F.col(f"{name}__hi").cast("double")
        columns.append((lo + (hi - lo) * (position(p) - F.floor(position(p)))).alias(name))
    return found.select(*groups, "n", *totals, *columns)
