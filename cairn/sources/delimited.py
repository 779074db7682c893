"""Delimited text: pipe-separated, quoted where needed, header row, UTF-8."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.functions.text import null_if_empty
from cairn.sources.records import read_records

# A doubled quote inside quotes is one quote; pads are kept; fields may hold line breaks.
_FORMAT = {
    "sep": "|", "quote": '"', "escape": '"', "header": "true", "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def read_delimited(spark: SparkSession, path: str, columns: list[str] | None = None,
                   multiline: bool | None = None) -> DataFrame:
    """Read as text columns; the header row names them and an empty field is NULL.

    ``columns`` picks columns by the header's names, in whatever order the file has them. Files are
    split over many tasks. ``multiline=False`` says that no field holds a line break, ``True`` reads a
    file in one task; with ``None`` files of one byte range are read so, and in larger ones records
    are cut at the right line breaks if any field holds one.
    """
    if multiline is None:
        if not has_large_files(spark, path):
            multiline = True
        elif has_line_breaks(spark, path):
            return read_ranges(spark, path, columns)
        else:
            multiline = False
    rows = spark.read.options(**_FORMAT).option("multiLine", multiline).csv(path)
    return _named(rows, columns)


def _named(rows: DataFrame, columns: list[str] | None) -> DataFrame:
    return rows.select(*[null_if_empty(F.col(f"`{c}`")).alias(c) for c in columns or rows.columns])


def read_ranges(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Read files of any size in byte ranges, whatever line breaks their quoted fields hold."""
    head = spark.read.options(**_FORMAT).option("multiLine", True).csv(path).schema
    options = {k: v for k, v in _FORMAT.items() if k != "header"} | {"multiLine": "true"}
    records = read_records(spark, path, _FORMAT["sep"], _FORMAT["quote"])
    parsed = records.select(F.from_csv("value", head.toDDL(), options).alias("row"))
    return _named(parsed.select("row.*"), columns)


def has_large_files(spark: SparkSession, path: str) -> bool:
    """Whether a file is larger than one byte range; looks at lengths only."""
    most = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0]
    return most is not None and most > range_bytes(spark)


def range_bytes(spark: SparkSession) -> int:
    """The most bytes of a file that one task reads, from a setting such as ``128m`` or ``134217728b``."""
    asked = spark.conf.get("spark.sql.files.maxPartitionBytes").lower().rstrip("b")
    unit = {"k": 10, "m": 20, "g": 30, "t": 40}.get(asked[-1])
    return int(asked[:-1]) << unit if unit else int(asked)


def has_line_breaks(spark: SparkSession, path: str) -> bool:
    """Whether a quoted field runs over its line's end; stops at the first one found."""
    lines = spark.read.text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not lines.where(quotes % 2 == 1).isEmpty()


def write_delimited(df: DataFrame, path: str, mode: str = "error") -> tuple[str, int]:
    """Write as delimited text, NULL and '' both empty; returns the path and the row count.

    The count is observed while writing, so the input is read once. In a table of one column an
    empty field is written as two quotes, as a blank line is no row.
    """
    seen = Observation()
    lone = len(df.columns) == 1
    fields = [F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]
    (df.select(*[F.coalesce(f, F.lit("")).alias(c) if lone else f
                 for f, c in zip(fields, df.columns, strict=True)])
       .observe(seen, F.count(F.lit(1)).alias("rows"))
       .write.options(**_FORMAT).option("emptyValue", '""' if lone else "").option("nullValue", "")
       .mode(mode).csv(path))
    return path, seen.get["rows"]


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def flags_as_int(df: DataFrame) -> DataFrame:
    """Booleans as 0/1 and lower-case column names, as the export format asks."""
    return lower_names(df.select(*[
        F.col(f"`{f.name}`").cast("int").alias(f.name)
        if isinstance(f.dataType, T.BooleanType) else F.col(f"`{f.name}`")
        for f in df.schema.fields]))


def type_columns(raw: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Bind text columns by name to a schema. Returns the typed rows and the rejects.

    An empty field is NULL. A column the text lacks is NULL. A value that does not fit its type
    becomes NULL in the typed rows, and its row is listed in the rejects with the raw values of
    the columns at fault.
    """
    raw = lower_names(raw)
    known = set(raw.columns)

    def text(name: str):
        return null_if_empty(F.col(f"`{name}`"))

    typed = raw.select(*[
        (text(f.name).try_cast(f.dataType) if f.name in known
         else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])
    fields = [f for f in schema.fields
              if f.name in known and not isinstance(f.dataType, T.StringType)]
    if not fields:
        return typed, raw.select(F.array().cast("array<string>").alias("bad_fields"),
                                 *raw.columns).where(F.lit(False))
    bad = F.filter(
        F.array(*[F.when(text(f.name).isNotNull() & text(f.name).try_cast(f.dataType).isNull(),
                         F.concat(F.lit(f.name + "="), text(f.name))) for f in fields]),
        lambda x: x.isNotNull())
    rejects = raw.select(bad.alias("bad_fields"), *raw.columns).where(F.size("bad_fields") > 0)
    return typed, rejects
