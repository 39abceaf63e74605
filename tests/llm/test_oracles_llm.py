"""Queries with DuckDB SQL against it; the others return a row per input row."""

import pytest
from helpers import SMALL

from inkwell.llm.queries import ORACLES, QUERIES
from inkwell.plans.compare import compare, duckdb_connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    r = compare(QUERIES[name](spark, SMALL), duckdb_connection(SMALL), ORACLES[name])
    assert r["columns_match"] and r["rows_spark"] == r["rows_oracle"] and r["hash_match"], r


def test_all_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))
    assert "pipeline" in names
