"""Relational building blocks: flags, lookups, overrides and leaf selection.

Joins carry no broadcast hints. Spark broadcasts a side when its statistics put it below
``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise, so a lookup table may grow.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_zero(*flags: str) -> Column:
    """Every flag is 0; a NULL flag drops the row, as in SQL."""
    return reduce(lambda a, b: a & b, [F.col(c) == 0 for c in flags])


def not_both_zero(first: str, second: str) -> Column:
    """``NOT (first = 0 AND second = 0)`` with SQL's three-valued logic."""
    return ~((F.col(first) == 0) & (F.col(second) == 0))


def yes_no(condition: Column) -> Column:
    """'Y' where the condition holds, 'N' where it does not or is unknown."""
    return F.when(condition, "Y").otherwise("N")


def without_columns(df: DataFrame, ignore: set[str]) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in ignore])


def lookup(df: DataFrame, table: DataFrame, on: dict[str, str], take: dict[str, str],
           required: bool = False) -> DataFrame:
    """Add columns of a keyed table. ``on`` and ``take`` map our column to the table's.

    Rows without a partner get NULLs, or are dropped where the lookup is required.
    """
    side = table.select(*[F.col(theirs).alias("_on_" + ours) for ours, theirs in on.items()],
                        *[F.col(theirs).alias(ours) for ours, theirs in take.items()])
    condition = reduce(lambda a, b: a & b, [df[c] == side["_on_" + c] for c in on])
    return (df.join(side, condition, "inner" if required else "left")
            .select(*[df[c] for c in df.columns], *[side[c] for c in take]))


def decode(df: DataFrame, codes: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Decode several code columns: column -> (code table, its key, its description column).

    The description is added as ``<column>_name``.
    """
    for column, (table, key, description) in codes.items():
        df = lookup(df, table, {column: key}, {column + "_name": description})
    return df


def orphans(df: DataFrame, table: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows that name a target the table lacks; a strict lookup demands there are none."""
    side = table.select(*[F.col(theirs).alias("_on_" + ours) for ours, theirs in on.items()])
    condition = reduce(lambda a, b: a & b, [df[c] == side["_on_" + c] for c in on])
    return df.join(side, condition, "left_anti")


def merge_overrides(found: DataFrame, overrides: DataFrame, key: str) -> DataFrame:
    """Overrides win; the found rows fill in for keys without one. Both have the same columns."""
    return overrides.select(*found.columns).unionByName(
        found.join(overrides.select(key).distinct(), key, "left_anti"))


def leaves(df: DataFrame, key: str, parent: str) -> DataFrame:
    """Rows that are nobody's parent."""
    parents = (df.where(F.col(parent).isNotNull())
               .select(F.col(parent).alias("_parent")).distinct())
    return df.join(parents, df[key] == parents["_parent"], "left_anti")


def first_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first n rows in a total order (a per-task top-n and one merge, never a full sort)."""
    return df.orderBy(*order).limit(n)


def scalar(df: DataFrame) -> Column:
    """The single value of a one-row table as a column, computed once as a subquery."""
    return df.scalar()


def distinct_ints(df: DataFrame, column: str) -> Column:
    """Sorted distinct values of a column of few values, as an array computed once."""
    return df.agg(F.sort_array(F.collect_set(column))).scalar()
