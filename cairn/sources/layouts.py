"""Facts laid out for their joins and filters, with a catalogue of the layouts.

A fact is split into folders by the columns that filters ask for and into buckets by the key that it is
joined on. Two facts with equal buckets meet without an exchange, and a filter reads only its folders. A
bucket is one task's work when it is read, so a table whose key is too uneven is opened as a plain one:
its joins shuffle, and Spark splits the hot key.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A bucket may hold so many times the mean of all buckets before the table counts as uneven.
UNEVEN = 4.0

_ENTRY = "ordinal BIGINT, version STRING, schema STRING, key STRING, buckets INT, partitions ARRAY<STRING>, rows BIGINT, most BIGINT"


def _quoted(names: Iterable[str]) -> str:
    return ", ".join(f"`{n}`" for n in names)


def entries(spark: SparkSession, root: str) -> list[Row]:
    """The catalogue's entries, oldest first: one row for each layout that was written whole."""
    try:
        found = spark.read.schema(_ENTRY).option("recursiveFileLookup", "true").json(f"{root}/catalogue").collect()
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return sorted(found, key=lambda r: (r["ordinal"], r["version"]))


def write_layout(df: DataFrame, root: str, key: str, buckets: int | None = None, partition_by: Iterable[str] = (),
                 files: int = 1) -> Row:
    """Write a fact in buckets of ``key`` and folders of ``partition_by``; returns its catalogue entry.

    Each bucket is written by ``files`` tasks, which share a hot key's rows, and is sorted within
    its files. ``buckets`` are the session's shuffle partitions unless given; tables that are to meet
    without an exchange need equal ones. The entry is written last, so a layout that was cut short is
    not seen, and the newest entry is the table.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    others = [c for c in df.columns if c not in partition_by]
    dealt = df.repartition(buckets, key) if files == 1 else df.repartition(
        buckets * files, key, F.pmod(F.xxhash64(*df.columns), F.lit(files)))
    table = f"layout_{version}"
    writer = dealt.select(*others, *partition_by).write.format("parquet").bucketBy(buckets, key).sortBy(key)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.option("path", f"{root}/data/{version}").saveAsTable(table)
    # Spark deals rows to buckets by this function, so the counts are those of the buckets.
    sizes = spark.table(table).groupBy(F.expr(f"pmod(hash(`{key}`), {buckets})").alias("bucket")).count().agg(
        F.sum("count").alias("rows"), F.max("count").alias("most")).first()
    spark.sql(f"DROP TABLE {table}")  # its files stay
    entry = Row(ordinal=max((e["ordinal"] for e in entries(spark, root)), default=0) + 1, version=version,
                schema=df.select(*others, *partition_by).schema.json(), key=key, buckets=buckets,
                partitions=list(partition_by), rows=sizes["rows"] or 0, most=sizes["most"] or 0)
    spark.createDataFrame([entry], _ENTRY).coalesce(1).write.json(f"{root}/catalogue/{version}")
    return entry


def is_even(entry: Row) -> bool:
    """Whether no bucket holds far more rows than the others do on average."""
    return entry["most"] * entry["buckets"] <= UNEVEN * max(entry["rows"], entry["buckets"])


def open_layout(spark: SparkSession, root: str, name: str, bucketed: bool | None = None) -> DataFrame:
    """Register the newest layout below ``root`` as table ``name`` of this session and open it.

    ``bucketed`` is decided by the catalogue's row counts unless given. A table of this name that was
    opened before is replaced; no files are changed.
    """
    found = entries(spark, root)
    if not found:
        raise FileNotFoundError(f"no layout is listed below {root}")
    entry = found[-1]
    schema = T.StructType.fromJson(json.loads(entry["schema"]))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    folders = f" PARTITIONED BY ({_quoted(entry['partitions'])})" if entry["partitions"] else ""
    buckets = (f" CLUSTERED BY (`{entry['key']}`) SORTED BY (`{entry['key']}`) INTO {entry['buckets']} BUCKETS"
               if (is_even(entry) if bucketed is None else bucketed) else "")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{folders}{buckets} LOCATION '{root}/data/{entry['version']}'")
    if entry["partitions"]:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)
