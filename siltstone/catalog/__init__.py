"""Registered queries: each drives an operator over the given tables and states its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a function under its name together with the SQL that states its result."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        ORACLES[fn.__name__] = sql
        return fn

    return register


def load_all() -> None:
    from siltstone.catalog import dimensions, loads, merges, relational, streams, tables  # noqa: F401
