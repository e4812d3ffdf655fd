"""All queries over the given tables and their SQL."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register a function (spark, sf_dir) as a query, with its SQL if it has any."""

    def put(function: Callable) -> Callable:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql:
            ORACLE_SQL[name] = sql
        return function

    return put


def load() -> None:
    """Import the modules that register queries."""
    from tidemark.plans import admission, catalog, chronology, coverage, features, lookups, maintenance, profiles, sampling, scans, selection  # noqa: F401
