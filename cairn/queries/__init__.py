"""Every operator applied to the test tables, each with the SQL that gives the same answer."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cairn.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function ``(table reader) -> DataFrame`` under a name, with its SQL."""
    def register(fn: Callable):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            tune(spark)
            return fn(lambda table: read(spark, folder, table))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def load_all() -> None:
    from cairn.queries import geo, linking, model, storage, tables, words  # noqa: F401
