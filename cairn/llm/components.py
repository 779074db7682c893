"""Connected components of a table of edges, as rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.session import staged


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node onto the node's smallest neighbour."""
    ways = _both_ways(edges)
    least = ways.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (ways.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours onto the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """The smallest node that each node of ``edges (u, v)`` can reach: ``(node, label)``.

    Alternates the two star steps until every component is one star around its smallest node, which
    takes a number of rounds that grows with the logarithm of the longest path. No node's neighbours
    are gathered: minima are combined before the shuffle. Every round is written to the shared
    folder. The smallest node of a component is listed with itself; an empty table gives an empty table.
    """
    now = staged(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not _stars(now):
        now = staged(_small_star(_large_star(now)), "edges")
    return (now.select(F.col("u").alias("node"), F.col("v").alias("label"))
            .union(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()))


def _stars(edges: DataFrame) -> bool:
    """Whether each node hangs on one other node at most, and on none that hangs itself."""
    hangs = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    holds = edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    roles = hangs.union(holds).groupBy("x").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return roles.where("up > 1 OR (up > 0 AND down > 0)").isEmpty()
