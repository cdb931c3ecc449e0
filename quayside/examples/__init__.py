"""Queries over the benchmark tables, each with the SQL that must give the same rows.

A query that needs landed files writes its whole table out first, in files whose
number grows with the table, and then runs the operators on those files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str, name: str | None = None):
    """Register a function and its SQL, under the function's name unless another is given."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = function
        ORACLES[key] = sql
        return function

    return register


def load_all() -> None:
    """Import every module that registers queries."""
    from quayside.examples import messages, paths, schema, structured, tables, text  # noqa: F401
