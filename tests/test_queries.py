"""Every registered query against its SQL counterpart in DuckDB."""

import pytest
from conftest import SMALL

from spendlens.checks.compare import check, duckdb_tables
from spendlens.checks.oracles import ORACLES
from spendlens.checks.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    return duckdb_tables(SMALL)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert check(spark, duck, name, SMALL) is None


def test_entry_module(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())
