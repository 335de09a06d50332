"""Every registered query against its DuckDB text on the smallest tables."""

import oracle
import pytest
from conftest import SF_DIR

import __spark_entry__ as contract
from candlewick import catalog, catalog_sql

QUERIES, ORACLES = catalog.QUERIES, catalog_sql.ORACLES


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows_and_a_stable_schema(spark):
    first, second = contract.entry(spark), contract.entry(spark)
    assert first.count() > 0 and first.schema == second.schema


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_duckdb(spark, con, name):
    assert oracle.differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == ""
