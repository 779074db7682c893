"""Sets of tables in versions: each is written whole and then made visible by one small row.

Below a root, ``data/<version>/<table>`` holds a version's tables and ``manifest/<version>`` its commit:
one row that is written last. Readers follow the commits, so a write that was cut short is not seen,
and two writers leave two whole versions, of which all readers choose the same one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.session import delete_folder

_COMMIT = "ordinal BIGINT, version STRING, tables MAP<STRING, STRUCT<schema: STRING, rows: BIGINT>>"


def _read_commits(spark: SparkSession, path: str, **options) -> list[Row]:
    try:
        return spark.read.schema(_COMMIT).options(**options).json(path).collect()
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def commits(spark: SparkSession, root: str) -> list[Row]:
    """``(ordinal, version, tables)`` of all committed versions, oldest first: one row for each."""
    return sorted(_read_commits(spark, f"{root}/manifest", recursiveFileLookup="true"), key=lambda r: (r["ordinal"], r["version"]))


def write_version(root: str, tables: dict[str, DataFrame], version: str | None = None, ordinal: int | None = None,
                  partition_by: Iterable[str] = ()) -> Row | None:
    """Write a set of tables as one version and commit it. Returns the commit's row.

    A ``version`` that is named names what it holds, as a stream's batch does: if it is committed
    already, nothing is written and None is returned; what an interrupted writer of it left is written
    anew. Without ``ordinal`` the version follows all that are committed when it begins.
    """
    spark = next(iter(tables.values())).sparkSession
    if version is not None and _read_commits(spark, f"{root}/manifest/{version}"):
        return None
    if ordinal is None:
        ordinal = max((r["ordinal"] for r in commits(spark, root)), default=0) + 1
    version = version or uuid.uuid4().hex
    held = {}
    for name, df in tables.items():
        seen = Observation()
        (df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
           .partitionBy(*partition_by).parquet(f"{root}/data/{version}/{name}"))
        held[name] = (df.schema.json(), seen.get["rows"])
    commit = spark.createDataFrame([(ordinal, version, held)], _COMMIT).coalesce(1)
    commit.write.mode("overwrite").json(f"{root}/manifest/{version}")
    return Row(ordinal=ordinal, version=version, tables={k: Row(schema=s, rows=n) for k, (s, n) in held.items()})


def read_latest(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """The table in the newest version that has it; None where there is none."""
    for commit in reversed(commits(spark, root)):
        if table in commit["tables"]:
            return _open(spark, root, table, [commit])
    return None


def read_all(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """The rows of all versions of a table, as a stream's batches; None where there is none."""
    found = [c for c in commits(spark, root) if table in c["tables"]]
    return _open(spark, root, table, found) if found else None


def _open(spark: SparkSession, root: str, table: str, found: list[Row]) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(found[-1]["tables"][table]["schema"]))
    return spark.read.schema(schema).parquet(*(f"{root}/data/{c['version']}/{table}" for c in found))


def drop_versions(spark: SparkSession, root: str, keep: int = 1) -> list[str]:
    """Delete all but the newest versions; returns their names. Readers of a dropped version fail.

    The commit goes first, so that no reader is led to a folder that is half deleted.
    """
    old = [c["version"] for c in commits(spark, root)[:-keep or None]]
    for version in old:
        delete_folder(spark, f"{root}/manifest/{version}")
        delete_folder(spark, f"{root}/data/{version}")
    return old
