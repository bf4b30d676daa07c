"""Queries by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query, by default under its function's name, with SQL that gives the same rows."""

    def register(run: Query) -> Query:
        key = name or run.__name__
        if key in QUERIES:
            raise ValueError(f"two queries are called {key}")
        QUERIES[key], ORACLES[key] = run, oracle
        return run

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
