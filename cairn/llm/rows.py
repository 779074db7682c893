"""Rows without those of a list of ids, without moving the rows that surely stay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.session import staged

#: Longs of 64 bits in the filter at most, 8 MB as a table of two longs; four bits for an id below that.
LONGS = 1 << 19


def _place(id_column: str, longs: int) -> tuple[Column, Column]:
    """The long and the bit in it that an id sets."""
    h = F.xxhash64(F.lit("listed"), id_column)
    return F.pmod(h, F.lit(longs)), F.expr(f"shiftleft(1L, cast(pmod(shiftright(xxhash64('listed', {id_column}), 32), 64) as int))")


def without(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """``rows`` whose ``column`` is not among ``ids``, a table of that one column; NULL stays.

    A Bloom filter of one probe, of ``LONGS`` longs at most, tells which rows can be among them; it is
    sent to every worker. Only these rows are shuffled and compared exactly, so long texts that stay
    stay where they are. Where the list is too long for the filter more rows are shuffled, none is lost.
    """
    listed = staged(ids.select(column).where(F.col(column).isNotNull()).distinct(), "listed")
    longs = 1024
    wanted = min(LONGS, listed.count() // 4)
    while longs < wanted:
        longs *= 2
    place, bit = _place(f"`{column}`", longs)
    filled = staged(listed.groupBy(place.alias("__long")).agg(F.bit_or(bit).alias("__bits")), "filter")
    marked = rows.withColumn("__long", place).join(F.broadcast(filled), "__long", "left").withColumn(
        "__may", F.coalesce(F.col("__bits").bitwiseAND(bit) != 0, F.lit(False))).select(*(f"`{c}`" for c in rows.columns), "__may")
    own = [F.col(f"`{c}`") for c in rows.columns]
    some = marked.where("__may").select(*own)
    other = listed.withColumnRenamed(column, "__listed")
    return marked.where("NOT __may").select(*own).union(some.join(other, some[column] == other["__listed"], "left_anti"))
