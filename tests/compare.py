"""Side-by-side comparison of the named queries with their SQL on the same files."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(path: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9f}".replace("-0.000000000", "0.000000000")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_result(build, spark, path):
    df = build(spark, path)
    return _sorted_rows(df.columns, [tuple(row) for row in df.collect()])


def duck_result(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return _sorted_rows(columns, cursor.fetchall())


def mismatch(build, sql, spark, path, con) -> str | None:
    """None when both agree, otherwise what differs."""
    names, rows = spark_result(build, spark, path)
    expected_names, expected = duck_result(con, sql)
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if len(rows) != len(expected):
        return f"{len(rows)} rows != {len(expected)}"
    for got, want in zip(rows, expected):
        if got != want:
            return f"{names}\n  got  {got}\n  want {want}"
    return None


def main(path: str, only: list[str]) -> int:
    import os
    import sys

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tests.conftest import make_session

    spark, con = make_session(), duck(path)
    bad = 0
    expected = entry.oracle_sql()
    for name, build in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            found = mismatch(build, expected[name], spark, path, con)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += found is not None
        print(f"{time.time() - start:6.2f}s {name}: {found or 'ok'}", flush=True)
    print(f"{bad} mismatches")
    return bad


if __name__ == "__main__":
    import sys

    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
