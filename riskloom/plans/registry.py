"""Registry of named queries: a Spark callable and, where SQL can express it, the same question in ANSI SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskloom.runtime import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function (spark, folder) -> DataFrame under ``name``."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            tune(spark)
            return fn(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add
