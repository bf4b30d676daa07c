"""Every operator as a query over the given tables, with the same result as SQL."""

from martloom.queries import checks, landing_checks, loads, mart, merges, tables  # noqa: F401
from martloom.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
