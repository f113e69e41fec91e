"""Every registered query of the harvest tables against DuckDB. Those of the training-data operators are tested in tests/llm."""

import pytest

import __spark_entry__ as entry
from workload.check import compare, duck
from workload.registry import QUERIES

SF = "/root/testdata/sf0.001"
KEYS = list(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_sql(spark, con, key):
    said = compare(spark, con, key, entry.queries()[key], entry.oracle_sql().get(key), SF)
    assert said.startswith(("ok", "rows")), said


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 120


def test_entry(spark):
    assert entry.entry(spark).count() == 25
