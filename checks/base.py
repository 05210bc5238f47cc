"""Registry of checked queries: a Spark plan and, beside it, SQL for the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siftload.sources.tables import Tables, parquet_tables

STAR_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


class Star:
    """The given tables of one scale, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._read: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in STAR_TABLES:
            raise AttributeError(name)
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]

    def tables(self, *names: str) -> Tables:
        return parquet_tables(self.spark, self.folder, names)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Registers ``fn(star)`` under ``key``."""

    def register(fn: Callable[[Star], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = lambda spark, folder: fn(Star(spark, folder))
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return register
