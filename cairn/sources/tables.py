"""The table registry: typed tables, views and write-once outputs."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn import fixed
from cairn.sources import versions
from cairn.sources.delimited import read_delimited, type_columns


def layout(ddl: str) -> T.StructType:
    """A schema from its one-line definition."""
    return T.StructType.fromDDL(" ".join(ddl.split()))


def registry() -> dict[str, T.StructType]:
    """Schemas of all known tables."""
    return {name: layout(ddl) for name, ddl in
            {**fixed.CODE_TABLES, **fixed.DIMENSION_TABLES, **fixed.FACT_TABLES}.items()}


def load_table(spark: SparkSession, text_path: str, schema: T.StructType, out_path: str,
               multiline: bool | None = None) -> tuple[str, int, DataFrame]:
    """Typed load of one delimited file into Parquet. Returns path, row count and rejects."""
    typed, rejects = type_columns(read_delimited(spark, text_path, multiline=multiline), schema)
    seen = Observation()
    (typed.observe(seen, F.count(F.lit(1)).alias("rows"))
          .write.mode("overwrite").parquet(out_path))
    return out_path, seen.get["rows"], rejects


def load_catalogue(spark: SparkSession, text_paths: dict[str, str], out_folder: str,
                   schemas: dict[str, T.StructType] | None = None,
                   multiline: bool | None = None) -> dict[str, int]:
    """Load a set of tables and register a view for each. Returns the row counts.

    Rows with a value that does not fit its type are written beside the tables, as JSON lines in
    ``rejects/<table>``, and open as the view ``rejects_<table>``.
    """
    schemas = schemas or registry()
    counts = {}
    for name, text_path in text_paths.items():
        out_path, counts[name], rejects = load_table(
            spark, text_path, schemas[name], os.path.join(out_folder, name), multiline)
        open_table(spark, out_path, name)
        bad_path = os.path.join(out_folder, "rejects", name)
        rejects.write.mode("overwrite").json(bad_path)
        spark.read.schema(rejects.schema).json(bad_path).createOrReplaceTempView(f"rejects_{name}")
    return counts


def open_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    df = spark.read.parquet(path)
    df.createOrReplaceTempView(name)
    return df


def create_empty(spark: SparkSession, folder: str,
                 schemas: dict[str, T.StructType] | None = None) -> list[str]:
    """(Re)create every table empty, so that views can be defined before data arrives."""
    names = []
    for name, schema in (schemas or registry()).items():
        path = os.path.join(folder, name)
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
        open_table(spark, path, name)
        names.append(name)
    return names


def create_views(views: dict[str, Callable[[], DataFrame]]) -> list[str]:
    """(Re)create views from the functions that define them."""
    for name, define in views.items():
        define().createOrReplaceTempView(name)
    return list(views)


def materialise(df: DataFrame, path: str, force: bool = False) -> DataFrame:
    """Write unless the output is there already; ``force`` writes anew. Returns the stored rows.

    The output is there when a whole version is committed: one that was cut short is written again, and
    of two writers at once all readers see the same one's rows.
    """
    spark = df.sparkSession
    if force or versions.read_latest(spark, path, "rows") is None:
        versions.write_version(path, {"rows": df})
    return versions.read_latest(spark, path, "rows")


def rows_since(df: DataFrame, column: str, first: int) -> DataFrame:
    """Rows whose column is at least ``first``; the filter reaches the scan."""
    return df.where(F.col(column) >= F.lit(first))
