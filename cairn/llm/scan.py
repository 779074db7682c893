"""Running sums over ordered groups of any size.

A group is not one task's work: rows are laid out in ranges of the sorted table, each range sums its
own rows, and the few groups that reach over several ranges add what the ranges before them hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.session import staged

PART = "__part"
_ROW = "__row"


def lay_out(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The rows in ranges of ``key`` and ``order``, written, with the range's number.

    Rows equal in all of these may lie in different ranges, so a value that fills a third of the table
    is split too. Their order is that of their number, which a repeated task gives again.
    """
    numbered = df.withColumn(_ROW, F.monotonically_increasing_id())
    return staged(numbered.repartitionByRange(key, *order, _ROW).withColumn(PART, F.spark_partition_id()), "ranges")


def running_sums(laid: DataFrame, key: str, order: list[str], sums: dict[str, Column]) -> DataFrame:
    """Add to each row of ``lay_out``'s result the sums of its group up to and with this row.

    ``order`` is the one given there. The sums must hold for whole groups without overflow.
    """
    ends = laid.groupBy(PART).agg(F.min(key).alias("low"), F.max(key).alias("high"))
    # Only a range's first or last group can reach into another range.
    wide = (ends.select(PART, F.col("low").alias("__of")).union(ends.select(PART, "high")).distinct()
            .groupBy("__of").count().where("count > 1").select("__of"))
    held = laid.join(wide, laid[key] == wide["__of"]).groupBy("__of", F.col(PART).alias("__in")).agg(
        *(F.sum(x).alias(f"__sum_{name}") for name, x in sums.items()))
    before = Window.partitionBy("__of").orderBy("__in").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    offsets = held.select("__of", "__in", *(F.coalesce(F.sum(f"__sum_{name}").over(before), F.lit(0)).alias(f"__sum_{name}") for name in sums))
    local = Window.partitionBy(key, PART).orderBy(*order, _ROW).rowsBetween(Window.unboundedPreceding, 0)
    summed = laid.withColumns({name: F.sum(x).over(local) for name, x in sums.items()})
    whole = summed.join(offsets, (F.col(key) == F.col("__of")) & (F.col(PART) == F.col("__in")), "left")
    return whole.select(*laid.columns, *((F.col(name) + F.coalesce(F.col(f"__sum_{name}"), F.lit(0))).alias(name) for name in sums))
