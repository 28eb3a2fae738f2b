"""Command line: run the pipeline over CSV tables or over a warehouse folder.

    python -m trialscope --csv data/raw --out data/out
    python -m trialscope --warehouse /data/warehouse --out data/out --no-gate
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from trialscope import schemas as S
from trialscope.plans import pipeline
from trialscope.sources import lookups, storage, warehouse
from trialscope.sources.tables import Tables


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="trialscope")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--csv", help="folder with the five core tables as CSV")
    source.add_argument("--warehouse", help="folder with customer, orders and events Parquet")
    parser.add_argument("--out", help="folder for tables, views and exports")
    parser.add_argument("--dry-run", action="store_true", help="only check the input")
    parser.add_argument("--no-gate", action="store_true", help="load without checking")
    options = parser.parse_args(arguments)
    if not options.dry_run and not options.out:
        parser.error("--out is needed unless --dry-run is given")

    spark = (
        SparkSession.builder.appName("trialscope")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    if options.csv:
        # A missing file counts as an empty table, which the gate reports.
        empty = {name: spark.createDataFrame([], S.TABLE_DDL[name]) for name in S.CORE_TABLES}
        core = storage.scan_tables(spark, options.csv)
        t = Tables({**lookups.standard_lookups(spark), **empty, **core})
    else:
        t = warehouse.load(spark, options.warehouse)
    try:
        if options.dry_run:
            pipeline.gate(t)
            print("the input passes the gate")
            return 0
        written = pipeline.run(spark, t, options.out, check=not options.no_gate)
    except pipeline.GateFailed as failure:
        print(f"the input fails the gate: {failure}", file=sys.stderr)
        return 1
    for name, rows in sorted(written.items()):
        print(f"{name}: {rows} rows")
    return 0


if __name__ == "__main__":
    sys.exit(main())
