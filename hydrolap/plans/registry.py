"""Register a query with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from .views import Tables, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_OPEN: dict[str, Tables] = {}


def _tables(spark: SparkSession, folder: str) -> Tables:
    """One set of views per session and folder: building and analysing them costs more than small queries do."""
    if folder not in _OPEN or _OPEN[folder].spark is not spark:
        _OPEN[folder] = Tables(spark, folder)
    return _OPEN[folder]


def query(name: str, sql: str | None = None, views: str | None = "measure"):
    """``sql`` may use the named views; without ``sql`` the query has no SQL twin."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(_tables(spark, folder))
        if sql is not None:
            ORACLES[name] = with_views(sql, views)
        return fn

    return register


def load() -> None:
    for module in ("scans", "scalars", "cube", "star", "indicators", "etl", "quality", "mining", "text"):
        import_module(f"hydrolap.plans.{module}_queries")
