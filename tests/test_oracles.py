"""Every registered query against its SQL in DuckDB on the same files."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_points
from siltstone import catalog

duckdb = pytest.importorskip("duckdb")

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
SQL_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "float": "FLOAT",
    "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 5


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = entry_points.queries()[name](spark, SF_DIR)
    expected = duck.sql(entry_points.oracle_sql()[name])
    order = sorted(result.columns)
    assert order == sorted(expected.columns)
    types = {c: SQL_TYPES[t] for c, t in result.dtypes}
    assert types == dict(zip(expected.columns, map(str, expected.types)))
    got = [tuple(r) for r in result.select(*order).collect()]
    at = [expected.columns.index(c) for c in order]
    want = [tuple(r[i] for i in at) for r in expected.fetchall()]
    assert _sorted(got) == _sorted(want)
    assert want, "an oracle without rows checks nothing"
