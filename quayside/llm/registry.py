"""The queries of this package and, where SQL can express them, their SQL."""

from __future__ import annotations

import importlib
import pkgutil
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import quayside.llm

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, and its SQL if there is one."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def load_all() -> None:
    """Import every module of the package, and the pipeline, so that their queries register."""
    for module in pkgutil.iter_modules(quayside.llm.__path__):
        importlib.import_module(f"quayside.llm.{module.name}")
    importlib.import_module("corpus_pipeline")
