"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job here relies on. All of them may be set on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split over several tasks, even where that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "cairn", master: str | None = None, **conf: str) -> SparkSession:
    """Build a tuned session. The master and cluster sizes come from spark-submit unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh path for a written table, below the folder named in ``spark.checkpoint.dir``.

    Where the setting is missing, a local session gets a temporary folder of its own; on a
    cluster that would be machine-local, so the missing setting is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="cairn-")
        spark.conf.set("spark.checkpoint.dir", root)
    return os.path.join(root, f"{label}-{uuid.uuid4().hex}")


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder in whatever store its path names; False where there is none."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


#: Scratch tables made since the outermost open scope began.
_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end, when what they were made for has been written.

    Results that are read lazily must not leave the scope. Without a scope staged tables stay.
    """
    made: list[str] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.remove(made)
        for path in made:
            delete_folder(spark, path)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result that several branches read, and read it back.

    The table is in the shared folder, so it outlives a lost executor, and later plans start
    from its real size.
    """
    path = scratch_folder(df.sparkSession, label)
    if _scopes:
        _scopes[-1].append(path)
    return staged_at(df, path)


def staged_at(df: DataFrame, path: str) -> DataFrame:
    """Write a table to a folder of the caller's choice and read it back."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Deal rows out over all shuffle partitions, for steps that cost more than their bytes show.

    Without columns rows go round robin. Adaptive execution would merge such small partitions.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)
