"""Registration of a query together with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register the function under its name; ``sql`` is what DuckDB runs for comparison.

    A trailing underscore, which keeps a function from hiding the operator it calls, is
    not part of the name.
    """

    def add(function: Query) -> Query:
        name = function.__name__.rstrip("_")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


def with_(*ctes: str) -> str:
    """``WITH a AS (...), b AS (...)`` from shared table expressions, each named once."""
    return "WITH " + ",\n".join(dict.fromkeys(ctes)) + "\n"
