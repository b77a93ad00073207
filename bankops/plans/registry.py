"""The registry of queries: a key, a Spark callable and, where SQL can say it, its DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of one data folder, by attribute: ``Tables(spark, path).events``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(key: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``key``."""

    def add(fn: Callable[[Tables], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return add
