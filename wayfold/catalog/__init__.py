"""Registered queries, one module per section, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def wrap(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return wrap


def load() -> None:
    """Import every section once, which fills the two tables above."""
    import importlib

    for section in ("files", "scalars", "joining", "aggregating", "ordering", "sets",
                    "texts", "samples", "scores", "models", "checks", "tables"):
        importlib.import_module(f"wayfold.catalog.{section}")
