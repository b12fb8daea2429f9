"""All queries by name, with the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query of (spark, folder) under a name, with its SQL if it has one."""

    def add(run):
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return add
