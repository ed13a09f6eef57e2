"""Queries over the test tables, one per operator, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = ["sources", "sinks", "relational", "functions", "fuzzy", "jobs", "writes"]


class Tables:
    """Attribute access to the Parquet tables of one directory."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")


_QUERIES: dict[str, tuple[Callable[[Tables], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    """Register a query and the SQL that gives the same rows."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = (fn, sql)
        return fn

    return register


def load() -> dict[str, tuple[Callable[[Tables], DataFrame], str | None]]:
    for m in MODULES:
        import_module(f"touchline.catalog.{m}")
    return _QUERIES
