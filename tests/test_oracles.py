"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01)."""

import pytest

from inkwell.plans.compare import compare, duckdb_connection
from inkwell.plans.registry import ORACLES, QUERIES, load_all

SF_SMALL = "/root/testdata/sf0.001"

load_all()


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF_SMALL), con, ORACLES[name])
    assert r["columns_match"], r
    assert r["rows_spark"] == r["rows_oracle"], r
    assert r["hash_match"], r


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_runs(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() >= 0
