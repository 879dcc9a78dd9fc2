"""The queries that have a SQL twin, against DuckDB on the same files."""

from __future__ import annotations

import pytest
from samples import SF

from siltstone.llm import queries

duckdb = pytest.importorskip("duckdb")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for name_of_table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name_of_table} AS SELECT * FROM '{SF}/{name_of_table}.parquet'")
    expected = con.sql(queries.ORACLES[name])
    columns = expected.columns
    rows = queries.QUERIES[name](spark, SF).select(*columns).collect()
    assert sorted(map(tuple, rows)) == sorted(expected.fetchall())
