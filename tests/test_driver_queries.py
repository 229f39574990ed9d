"""Every registered driver query against its DuckDB oracle (sf0.001)."""

import pytest

import __spark_entry__ as E
from surveylake.plans import catalog
from surveylake.plans.verify import compare, duckdb_connection

SF = "/root/testdata/sf0.001"
NAMES = sorted(catalog.queries())


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF)


def test_every_query_has_an_oracle():
    assert set(catalog.oracle_sql()) == set(NAMES)
    assert set(NAMES) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "origin" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(E.queries()[name](spark, SF), con, E.oracle_sql()[name])
    assert ok, msg
