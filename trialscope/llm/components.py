"""Connected components of an edge list, as joins: nothing is gathered in one task or the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import compact


def _starred(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours of each node onto its smallest one: the larger neighbours, or the smaller ones."""
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = both.join(least, "a")
    if large:
        out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
    return out.where("a <> b")


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b): root is the smallest node of its component.

    Large-star and small-star steps alternate until the edges form stars around the roots, which
    takes about log(n) rounds.  Edges with a null end and loops are left out.
    """
    edges = compact(edges.where("a <> b").select("a", "b").distinct())
    mark = None
    for _ in range(rounds):
        # As many partitions as the edges had before: no step makes more of them than it got.
        parts = edges.rdd.getNumPartitions()
        edges = _starred(edges, True).coalesce(parts).distinct()
        edges = compact(_starred(edges, False).coalesce(parts).distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
