"""Every registered query with SQL against DuckDB on the smallest tables; the others run."""

import pytest

import __spark_entry__ as entry
from weirflow import catalog
from parity import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, con, name):
    ok, note = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    assert ok, note


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs_without_sql(spark, name):
    assert QUERIES[name](spark, SF).columns


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(ORACLE) <= set(QUERIES) <= set(entry.queries())
