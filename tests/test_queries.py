"""Every named query against its SQL on the smallest files."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.compare import duck, mismatch
from trialscope.plans.expected_sql import EXPECTED_SQL
from trialscope.plans.registry import QUERIES as OWN

PATH = "/root/testdata/sf0.001"
QUERIES = {name: entry.queries()[name] for name in OWN}
EXPECTED = {name: entry.oracle_sql()[name] for name in EXPECTED_SQL}


@pytest.fixture(scope="module")
def con():
    return duck(PATH)


def test_every_query_has_sql():
    assert set(QUERIES) == set(EXPECTED)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, con):
    assert mismatch(QUERIES[name], EXPECTED[name], spark, PATH, con) is None


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {r.experiment_name for r in rows} == {"checkout_redesign", "pricing_test"}
