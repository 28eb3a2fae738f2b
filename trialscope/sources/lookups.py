"""Seeding of lookup tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialscope import schemas as S


def insert_missing(existing: DataFrame, seeds: DataFrame, key: str, identity: str) -> DataFrame:
    """Append the seeds whose key is not there yet, numbered after the highest id.

    ``seeds`` has ``seed_order`` and all columns but the id.  The missing seeds are gathered in
    one array to be numbered; they are a fixed list of a few rows.
    """
    columns = [c for c in existing.columns if c != identity]
    seed = F.struct("seed_order", *columns)
    fresh = seeds.join(existing.select(key), key, "left_anti").select(
        seed.alias("seed"), F.lit(None).cast("int").alias("top")
    )
    highest = existing.agg(F.coalesce(F.max(identity), F.lit(0)).cast("int").alias("top"))
    added = (
        fresh.unionByName(highest, allowMissingColumns=True)
        .agg(F.array_sort(F.collect_list("seed")).alias("seeds"), F.max("top").alias("top"))
        .select("top", F.posexplode("seeds").alias("pos", "seed"))
        .select(
            (F.col("top") + F.col("pos") + 1)
            .cast(existing.schema[identity].dataType)
            .alias(identity),
            *[F.col(f"seed.{c}").alias(c) for c in columns],
        )
    )
    return existing.unionByName(added)


def with_parent_id(
    child: DataFrame, parent: DataFrame, name: str, identity: str
) -> DataFrame:
    """Resolve a parent by its name to its id."""
    return child.join(parent.select(name, identity), name).drop(name)


def literal_rows(spark: SparkSession, ddl: str, rows: Iterable[tuple]) -> DataFrame:
    """A few constant rows as a local relation.

    Its exact size is known to the planner, so joins with it are broadcast because it is small;
    a frame made of Python rows has no size and would make the large side move instead.
    """
    columns = [column.split() for column in ddl.split(", ")]

    def literal(value) -> str:
        if value is None:
            return "NULL"
        return str(value) if isinstance(value, int) else "'" + value.replace("'", "\\'") + "'"

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    names = ", ".join(name for name, _ in columns)
    typed = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in columns)
    return spark.sql(f"SELECT {typed} FROM VALUES {body} AS v({names})")


def _ordered(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    numbered = [(i, *row) for i, row in enumerate(rows, start=1)]
    return literal_rows(spark, f"seed_order int, {ddl}", numbered)


def seed_lookups(spark: SparkSession, t) -> dict[str, DataFrame]:
    """The six lookup tables after inserting the standard rows that are not there yet."""
    regions = insert_missing(
        t["regions"], _ordered(spark, [(r,) for r in S.REGION_NAMES], "region_name string"),
        "region_name", "region_id",
    )
    countries = with_parent_id(
        _ordered(
            spark, S.COUNTRY_ROWS,
            "country_code string, country_name string, region_name string",
        ),
        regions, "region_name", "region_id",
    )
    simple = {
        "devices": ("device_type", "device_id", S.DEVICE_TYPES),
        "browsers": ("browser_name", "browser_id", S.BROWSER_NAMES),
        "acquisition_channels": ("channel_name", "channel_id", S.CHANNEL_NAMES),
    }
    seeded = {
        "regions": regions,
        "countries": insert_missing(t["countries"], countries, "country_code", "country_id"),
        "event_types": insert_missing(
            t["event_types"],
            _ordered(
                spark, S.EVENT_TYPE_ROWS,
                "event_name string, event_category string, funnel_step int",
            ),
            "event_name", "event_type_id",
        ),
    }
    for table, (name, identity, values) in simple.items():
        seeds = _ordered(spark, [(v,) for v in values], f"{name} string")
        seeded[table] = insert_missing(t[table], seeds, name, identity)
    return seeded


def standard_lookups(spark: SparkSession) -> dict[str, DataFrame]:
    """The six lookup tables with their standard rows, ids by position."""
    region_ids = {name: i for i, name in enumerate(S.REGION_NAMES, start=1)}
    rows = {
        "regions": [(r,) for r in S.REGION_NAMES],
        "countries": [(code, name, region_ids[region]) for code, name, region in S.COUNTRY_ROWS],
        "devices": [(d,) for d in S.DEVICE_TYPES],
        "browsers": [(b,) for b in S.BROWSER_NAMES],
        "acquisition_channels": [(c,) for c in S.CHANNEL_NAMES],
        "event_types": S.EVENT_TYPE_ROWS,
    }
    return {
        table: literal_rows(
            spark, S.TABLE_DDL[table], [(i, *row) for i, row in enumerate(values, start=1)]
        )
        for table, values in rows.items()
    }
