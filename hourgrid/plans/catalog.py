"""Registry of named queries: a Spark plan and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


MODULES = ["feature_queries", "ingest_queries", "feed_queries", "drift_queries", "lookup_queries",
           "monitoring_queries", "forecast_queries", "store_queries", "stream_queries"]


def load_all() -> None:
    """Import every module that registers queries."""
    for module in MODULES:
        import_module(f"hourgrid.plans.{module}")
