"""Named queries: a Spark callable and the SQL with the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with its check where SQL can express it."""
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} exists already")
        QUERIES[name] = function
        if check is not None:
            CHECKS[name] = check
        return function

    return register
