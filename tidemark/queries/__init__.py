"""One registered query per operator, each with the SQL that must give the same rows."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import prepare

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}
_MODULES = [
    "scans", "cursor", "change", "partition", "coerce", "shape", "select", "family", "timeseries",
    "formats", "clinical", "quality", "ingest", "reports",
]


class Tables:
    """The tables of one data folder as lazily read DataFrames (``t.orders``)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def query(name: str, oracle: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def add(fn):
        if name in _QUERIES:
            raise ValueError(f"query {name} registered twice")
        _QUERIES[name] = lambda spark, folder: fn(Tables(prepare(spark), folder))
        if oracle:
            _ORACLES[name] = oracle
        return fn

    return add


def load() -> tuple[dict, dict]:
    """(queries, oracle SQL) of all groups."""
    for m in _MODULES:
        importlib.import_module(f"tidemark.queries.{m}")
    return dict(_QUERIES), dict(_ORACLES)
