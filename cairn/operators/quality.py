"""Data quality: duplicate keys, key checks and cardinality guards.

No operator here sorts or collects a whole group: each aggregates first (combined map-side) and
joins the one row per key back. A key that holds a third of the table then only makes a skewed
join, which adaptive execution splits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.session import staged


def latest_per_key(df: DataFrame, keys: list[str], compare: str) -> DataFrame:
    """One row per key: its largest compare value (``_latest``)."""
    return df.groupBy(*[F.col(k).alias("_k_" + k) for k in keys]).agg(
        F.max(compare).alias("_latest"))


def _with_latest(df: DataFrame, keys: list[str], compare: str) -> DataFrame:
    """The key is one struct, in which NULL equals NULL, so the join finds the maxima where they were summed up."""
    keyed = df.withColumn("_key", F.struct(*keys))
    return keyed.join(keyed.groupBy("_key").agg(F.max(compare).alias("_latest")), "_key").drop("_key")


def _won(compare: str) -> Column:
    """Nothing exceeds the maximum. An equality would become a second join key, and one more exchange."""
    return F.coalesce(F.col(compare) >= F.col("_latest"), F.col("_latest").isNull())


def keep_latest(df: DataFrame, keys: list[str], compare: str) -> DataFrame:
    """Per key, every row whose compare value equals the largest; ties are all kept.

    NULL compare values lose against any value and are kept where a key has nothing else.
    """
    if list(keys) == [compare]:
        return df
    return (_with_latest(df, keys, compare)
            .where(_won(compare)).select(*df.columns))


def superseded(df: DataFrame, keys: list[str], compare: str) -> DataFrame:
    """The rows ``keep_latest`` drops: key columns, compare value and the value that won."""
    if list(keys) == [compare]:
        return df.select(*keys, F.col(compare).alias("kept_value")).where(F.lit(False))
    return (_with_latest(df, keys, compare)
            .where(~_won(compare))
            .select(*keys, compare, F.col("_latest").alias("kept_value")))


def split_latest(df: DataFrame, keys: list[str], compare: str) -> tuple[DataFrame, DataFrame]:
    """``keep_latest`` and ``superseded`` from one join, which is written and read by both."""
    if list(keys) == [compare]:
        return df, superseded(df, keys, compare)
    marked = staged(_with_latest(df, keys, compare), "latest")
    won = _won(compare)
    return (marked.where(won).select(*df.columns),
            marked.where(~won).select(*keys, compare, F.col("_latest").alias("kept_value")))


def duplicate_counts(df: DataFrame, keys: list[str], compare: str) -> DataFrame:
    """One row: rows kept and rows in total, from one aggregation and no join.

    Each key's rows are counted per compare value; the kept ones are those of the largest.
    """
    per_value = df.groupBy(*keys, compare).agg(F.count(F.lit(1)).alias("_n"))
    # NULL sorts lowest in a struct, so it only wins where nothing else is there.
    per_key = per_value.groupBy(*keys).agg(
        F.max(F.struct(F.col(compare), F.col("_n"))).getField("_n").alias("_kept"),
        F.sum("_n").alias("_total"))
    return per_key.agg(F.coalesce(F.sum("_kept"), F.lit(0)).alias("kept"),
                       F.coalesce(F.sum("_total"), F.lit(0)).alias("total"))


def key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that break a primary key: repeated ones and ones with a NULL part. Empty is a pass."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
            .select(*keys, "rows",
                    F.when(missing, "null key").when(F.col("rows") > 1, "repeated key")
                    .alias("problem"))
            .where(F.col("problem").isNotNull()))


def last_wins(df: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """One row per key: the one with the largest ordinal.

    A NULL ordinal loses against any other. Rows that tie are ordered by their content, column by
    column, so the answer does not depend on the order of reading.
    """
    others = [c for c in df.columns if c not in keys]
    # Maps have no order, so their text stands for them.
    content = [F.to_json(c) if _has_map(df.schema[c].dataType) else F.col(c) for c in others if c != ordinal]
    rank = F.struct(F.col(ordinal), *content)
    if any(_has_map(df.schema[c].dataType) for c in others):
        best = df.groupBy(*keys).agg(F.max_by(F.struct(*others), rank).alias("_row"))
        return best.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])
    best = df.groupBy(*keys).agg(F.max(F.struct(F.col(ordinal), *(c for c in others if c != ordinal))).alias("_row"))
    return best.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and _has_map(kind.elementType)


def unexpected_counts(df: DataFrame, keys: list[str], expected: int = 1) -> DataFrame:
    """Groups that do not hold exactly the expected number of rows."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
            .where(F.col("rows") != expected))
