"""Registry of queries and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register a query ``(spark, sf_dir) -> DataFrame``."""

    def add(fn: Callable) -> Callable:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return add
