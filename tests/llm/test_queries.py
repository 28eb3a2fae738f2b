"""The queries that SQL can express against their SQL, and all of them on an empty folder."""

from __future__ import annotations

import duckdb
import pytest

from tests.compare import mismatch
from trialscope.llm import queries

PATH = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    out = duckdb.connect()
    for table in ("documents", "benchmark"):
        out.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{PATH}/{table}.parquet')")
    return out


@pytest.mark.parametrize("name", sorted(queries.EXPECTED_SQL))
def test_query(name, spark, con):
    assert mismatch(queries.QUERIES[name], queries.EXPECTED_SQL[name], spark, PATH, con) is None


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    for table in ("documents", "embeddings", "benchmark", "labels"):
        spark.read.parquet(f"{PATH}/{table}.parquet").limit(0).write.parquet(f"{folder}/{table}.parquet")
    return folder


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_empty_tables(name, spark, nothing):
    assert queries.QUERIES[name](spark, nothing).count() == 0
