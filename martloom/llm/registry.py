"""The subpackage's queries by name; SQL only where SQL gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(run: Query | None = None, *, oracle: str | None = None):
    """Register a query under its function's name."""

    def register(f: Query) -> Query:
        if f.__name__ in QUERIES:
            raise ValueError(f"two queries are called {f.__name__}")
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return register(run) if run else register
