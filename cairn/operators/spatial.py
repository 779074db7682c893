"""Spatial joins and shape assembly on planar coordinates.

Boxes are indexed on a hierarchy of square grids. A box goes to the level whose cells measure
between a half and the whole of its longer side, so it covers at most nine cells whatever its
size; a point asks one cell at each level in use. Both joins are therefore equi-joins on cells,
and no shape is ever compared with all others.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn import fixed
from cairn.functions import cells, shapes
from cairn.operators.relational import distinct_ints
from cairn.session import spread, staged

_FINEST = -30

#: Rings with more sides are indexed side by side instead of being carried whole.
MANY_SIDES = 256
#: Sides of such rings that a task should take at once.
SIDES_PER_TASK = 1 << 20
#: Cells of rings that are carried whole are so many powers of two smaller than those of their boxes.
FINER_SMALL = 3


def _level(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    span = F.greatest(xmax - xmin, ymax - ymin)
    return F.when(span > 0, F.greatest(F.ceil(F.log2(span)).cast("int") - 1, F.lit(_FINEST))
                  ).otherwise(F.lit(_FINEST))


def _cell(value: Column, level: Column) -> Column:
    return F.floor(value / F.pow(F.lit(2.0), level)).cast("bigint")


def measures(shapes_df: DataFrame, ring: str = "ring") -> DataFrame:
    """Add bounds, area, centroid and sides of each ring: all within the row."""
    at = F.element_at(F.col(ring), 1)
    return (shapes_df.where(F.size(ring) > 2)
            .select("*", shapes.bounds(F.col(ring)).alias("_b"),
                    shapes.edges(F.col(ring)).alias("edges"))
            .select("*", "_b.*", shapes.moments(F.col("edges"), at["x"], at["y"]).alias("_m"))
            .select("*", "_m.*").drop("_b", "_m"))


def overall_bounds(measured: DataFrame) -> DataFrame:
    return measured.agg(F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"),
                        F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))


def point_box_pairs(points: DataFrame, boxes: DataFrame, x: str = "x", y: str = "y") -> DataFrame:
    """All pairs of a point and a box (``xmin, ymin, xmax, ymax``) that contains it, edges included.

    Columns of both sides are kept, so their names have to differ.
    """
    level = _level(F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax"))
    leveled = boxes.withColumn("_level", level)
    cells = (leveled
             .withColumn("_cx", F.explode(F.sequence(_cell(F.col("xmin"), F.col("_level")),
                                                     _cell(F.col("xmax"), F.col("_level")))))
             .withColumn("_cy", F.explode(F.sequence(_cell(F.col("ymin"), F.col("_level")),
                                                     _cell(F.col("ymax"), F.col("_level"))))))
    # Levels in use are exponents of two: a few dozen numbers at the very most.
    asked = (points.withColumn("_level", F.explode(distinct_ints(leveled, "_level")))
             .withColumn("_cx", _cell(F.col(x), F.col("_level")))
             .withColumn("_cy", _cell(F.col(y), F.col("_level"))))
    # Rows of few bytes may meet many, which their size does not show.
    return (spread(asked, "_level", "_cx", "_cy").join(cells, ["_level", "_cx", "_cy"])
            .where(F.col(x).between(F.col("xmin"), F.col("xmax"))
                   & F.col(y).between(F.col("ymin"), F.col("ymax")))
            .drop("_level", "_cx", "_cy"))


def containing_regions(points: DataFrame, regions: DataFrame, key: str, x: str = "x",
                       y: str = "y") -> DataFrame:
    """Every region a point lies strictly inside: ``key, region_id, ordinal``.

    A ring's box is cut into cells. One that no side reaches answers for its points; a border cell carries
    the ring's sides, unless there are more than ``MANY_SIDES``: then it tells on which side of the border
    a point lies, sides stay rows, and the few points on the border itself meet only those at their height.
    """
    # Written once: a ring may be long in the making, and all its points and sides read it.
    held = staged(regions.select("region_id", "ordinal", "ring")
                  .withColumn("_ring", F.monotonically_increasing_id()), "regions").where(F.size("ring") > 2)
    boxes = (held.select("*", shapes.bounds(F.col("ring")).alias("_b"), shapes.edges(F.col("ring")).alias("_edges"))
             .select("_ring", "region_id", "ordinal", "ring", "_b.*", "_edges"))
    asked = points.select(F.col(key), F.col(x).alias("_x"), F.col(y).alias("_y")).dropna()
    large = F.size("ring") > MANY_SIDES + 1
    small = boxes.where(~large).select("region_id", "ordinal", "xmin", "ymin", "xmax", "ymax", "_edges")
    sides = held.where(large).agg(F.sum(F.size("ring"))).first()[0]
    if not sides:
        return _in_small_rings(asked, small_ring_cells(small), key)
    rings = boxes.where(large)
    if sides > SIDES_PER_TASK:
        parts = int(rings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rings = rings.drop("_edges").repartition(max(-(-sides // SIDES_PER_TASK), parts)).withColumn("_edges", shapes.edges(F.col("ring")))
    found = _in_large_rings(asked, rings, key)
    if held.where(~large).isEmpty():
        return found
    return found.union(_in_small_rings(asked, small_ring_cells(small), key))


def small_ring_cells(boxes: DataFrame) -> DataFrame:
    """``region_id, ordinal, _level, _cx, _cy, _edges, _two``: the cells that a ring reaches.

    Cells measure a 16th to an eighth of the box. Where no side reaches a cell, with some room for
    rounding, all of it lies inside, and it carries no sides, or outside, and it is left out. Others
    carry the sides at their heights that do not lie to their left; ``_two`` tells that these are two
    at most.
    """
    level = F.greatest(_level(F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax")) - FINER_SMALL, F.lit(_FINEST))
    size = F.pow(F.lit(2.0), F.col("_level"))
    x, y = (F.col("_cx") + 0.5) * size, (F.col("_cy") + 0.5) * size
    high = size / 2 + (F.abs(y) + size) * 1e-9
    half = size / 2 + (F.abs(x) + F.abs(y) + size) * 1e-9

    # A side without its coordinates may be anywhere.
    def maybe(test: Column) -> Column:
        return F.coalesce(test, F.lit(True))

    def level_with(e: Column) -> Column:
        return maybe((F.least(e["y1"], e["y2"]) <= y + high) & (F.greatest(e["y1"], e["y2"]) >= y - high))

    def near(e: Column) -> Column:
        across, up = e["x2"] - e["x1"], e["y2"] - e["y1"]
        return maybe((F.least(e["x1"], e["x2"]) <= x + half) & (F.greatest(e["x1"], e["x2"]) >= x - half)
                     & (F.abs(across * (y - e["y1"]) - up * (x - e["x1"])) <= (F.abs(across) + F.abs(up)) * half))

    # A few rings make many cells, which their size does not show.
    rows = (spread(boxes).withColumn("_level", level)
            .withColumn("_cy", F.explode(F.sequence(_cell(F.col("ymin"), F.col("_level")), _cell(F.col("ymax"), F.col("_level")))))
            .withColumn("_edges", F.filter("_edges", level_with)))
    cells = (rows.withColumn("_cx", F.explode(F.sequence(_cell(F.col("xmin"), F.col("_level")), _cell(F.col("xmax"), F.col("_level")))))
             .withColumn("_border", F.exists("_edges", near))
             .where(F.when(F.col("_border"), True).otherwise(shapes.contains(F.col("_edges"), x, y))))
    right = F.filter("_edges", lambda e: maybe(F.greatest(e["x1"], e["x2"]) >= x - half))
    known = F.forall("_edges", lambda e: (e["x1"] + e["y1"] + e["x2"] + e["y2"]).isNotNull())
    return (cells.withColumn("_edges", F.when(F.col("_border"), right))
            .select("region_id", "ordinal", "_level", "_cx", "_cy", "_edges", ((F.size("_edges") <= 2) & known).alias("_two")))


def _in_small_rings(asked: DataFrame, cells: DataFrame, key: str) -> DataFrame:
    """``containing_regions`` for rings that are carried whole."""
    held = staged(cells, "cells")
    placed = (asked.withColumn("_level", F.explode(distinct_ints(held, "_level")))
              .withColumn("_cx", _cell(F.col("_x"), F.col("_level"))).withColumn("_cy", _cell(F.col("_y"), F.col("_level"))))
    at = ["_level", "_cx", "_cy"]
    test = (F.col("_edges"), F.col("_x"), F.col("_y"))
    inside = F.when(F.col("_edges").isNull(), True).when(F.col("_two"), shapes.between_two(*test)).otherwise(shapes.contains(*test))
    # A few bytes of points meet many regions, which their size does not show.
    return spread(placed, *at).join(held, at).where(inside).select(key, "region_id", "ordinal")


def ring_sides(rings: DataFrame) -> DataFrame:
    """``_ring, _tall, _strip, side``: the sides as rows, by height.

    A side goes to horizontal strips that are as high as the power of two next above its own height,
    so it lies in two of them at most, and a strip holds few sides for each time the ring passes it.
    """
    sides = rings.select("_ring", F.explode("_edges").alias("side"))
    low, high = F.least("side.y1", "side.y2"), F.greatest("side.y1", "side.y2")
    tall = F.when(high > low, F.greatest(F.ceil(F.log2(high - low)).cast("int"), F.lit(_FINEST))).otherwise(F.lit(_FINEST))
    named = sides.select("_ring", tall.alias("_tall"), low.alias("_low"), high.alias("_high"), "side")
    return named.select("_ring", "_tall", F.explode(F.sequence(
        _cell(F.col("_low"), F.col("_tall")), _cell(F.col("_high"), F.col("_tall")))).alias("_strip"), "_low", "_high", "side")


def side_pairs(pairs: DataFrame, sides: DataFrame) -> DataFrame:
    """Each of ``pairs (_ring, _y, ...)`` with the sides of its ring that reach the height ``_y``."""
    heights = sides.groupBy("_ring").agg(F.collect_set("_tall").alias("_heights"))  # exponents: a few dozen at most
    asked = (pairs.join(heights, "_ring").withColumn("_tall", F.explode("_heights")).drop("_heights")
             .withColumn("_strip", _cell(F.col("_y"), F.col("_tall"))))
    return asked.join(sides, ["_ring", "_tall", "_strip"]).where(F.col("_y").between(F.col("_low"), F.col("_high")))


def _inside(pairs: DataFrame, sides: DataFrame, columns: list[str]) -> DataFrame:
    """Of ``pairs (_pair, _ring, _x, _y, ...)`` those whose point lies strictly inside the ring."""
    one = F.array("side")  # the test of a ring, on one of its sides
    met = side_pairs(pairs, sides).select(
        "_pair", *columns, shapes.crossed(one, F.col("_x"), F.col("_y")).alias("_crossed"),
        shapes.touched(one, F.col("_x"), F.col("_y")).alias("_on"))
    return (met.groupBy("_pair", *columns).agg(F.sum("_crossed").alias("_n"), F.bool_or("_on").alias("_on"))
            .where("_n % 2 = 1 AND NOT _on").select(*columns))


def large_ring_cells(rings: DataFrame, sides: DataFrame | None = None) -> DataFrame:
    """``_ring, region_id, ordinal`` with ``cells.CELL``: the cells of rings with many sides; ``sides`` are not needed.

    A ring's box is cut into some dozen to two thousand cells whatever its sides. A cell that no side reaches lies
    wholly inside, and so does any point in it, or wholly outside, and is left out. Where the sides in a cell lie in a
    narrow band, one answer holds on either side of it. Other cells are cut on; in the smallest, and
    in the bands, points have to ask the sides.
    """
    kept = ["_ring", "region_id", "ordinal"]
    asked = rings.select(*kept, _level(F.col("xmin"), F.col("ymin"), F.col("xmax"), F.col("ymax")).alias("_level"),
                         "xmin", "ymin", "xmax", "ymax", F.col("ring")["x"].alias("x"), F.col("ring")["y"].alias("y"))
    schema = ", ".join(f"{c} {rings.schema[c].dataType.simpleString()}" for c in kept)
    return (asked.dropna(subset=["xmin", "ymin", "xmax", "ymax"])
            .mapInArrow(cells.cells_of_rings(kept, _FINEST), f"{schema}, {cells.CELL}"))


def _in_large_rings(asked: DataFrame, rings: DataFrame, key: str) -> DataFrame:
    """``containing_regions`` for rings of many sides: cells answer, but for a few points that ask the sides."""
    held = staged(large_ring_cells(rings), "cells")
    asked = staged(spread(asked), "points")
    placed = (asked.withColumn("_level", F.explode(distinct_ints(held, "_level")))
              .withColumn("_cx", _cell(F.col("_x"), F.col("_level"))).withColumn("_cy", _cell(F.col("_y"), F.col("_level"))))
    at = ["_level", "_cx", "_cy"]
    off = F.col("_a") * F.col("_x") + F.col("_b") * F.col("_y") - F.col("_c")
    above, below = off > F.col("_d"), off < -F.col("_d")
    # A few bytes of points meet many cells, which their size does not show.
    told = (spread(placed, *at).join(held, at).where((above & F.col("_pos")) | (below & F.col("_neg")))
            .select(key, "region_id", "ordinal"))
    left = staged(spread(placed.withColumn("_pair", F.monotonically_increasing_id()), *at)
                  .join(held.where("NOT _whole"), at).where(~above & ~below)
                  .select("_pair", "_ring", "_x", "_y", key, "region_id", "ordinal"), "pairs")
    if left.isEmpty():
        return told
    sides = staged(ring_sides(rings.join(left.select("_ring").distinct(), "_ring", "left_semi")), "sides")
    return told.union(_inside(left, sides, [key, "_ring", "region_id", "ordinal"]).drop("_ring"))


def _ranked(regions: DataFrame, *order: Column) -> DataFrame:
    """Add ``_rank``, a number that grows with the order; written, so that it stays."""
    return staged(regions.orderBy(*order).withColumn("_rank", F.monotonically_increasing_id()), "ranked")


def first_region(points: DataFrame, regions: DataFrame, key: str, x: str = "x", y: str = "y"
                 ) -> DataFrame:
    """``key, region_id`` of the first region, by ordinal, that contains each point."""
    # The least of numbers needs no sorting of all pairs.
    ranked = _ranked(regions.select("region_id", "ordinal", "ring"), F.asc("ordinal"), F.asc("region_id"))
    found = containing_regions(points, ranked.select(F.col("_rank").alias("region_id"), F.col("_rank").alias("ordinal"), "ring"),
                               key, x, y).groupBy(key).agg(F.min("region_id").alias("_rank"))
    return found.join(ranked.select("_rank", "region_id"), "_rank").drop("_rank")


def with_region(points: DataFrame, regions: DataFrame, key: str, x: str = "x", y: str = "y",
                override: str | None = None) -> DataFrame:
    """Points with their region: the override where there is one, else the first containing one.

    Points with an override or without coordinates never reach the spatial join.
    """
    asked = points if override is None else points.where(F.col(override).isNull())
    found = first_region(asked, regions, key, x, y)
    joined = points.join(found, key, "left")
    if override is None:
        return joined
    return joined.withColumn("region_id", F.coalesce(override, "region_id"))


def _check_overlap(overlap: float) -> None:
    if overlap < 0.875:
        raise ValueError("candidates are found through a point in the middle of the child's "
                         "area, which needs an overlap of at least 0.875")


def containments(regions: DataFrame, overlap: float = fixed.PARENT_OVERLAP) -> DataFrame:
    """Pairs of a region and a strictly larger one that covers more than ``overlap`` of it.

    One probe point per child finds every candidate parent: at least an eighth of the child's
    area lies on either side of it along both axes, so a box that holds more than seven eighths
    of the area holds the point. The overlap is then computed exactly.
    """
    _check_overlap(overlap)
    found = _nested(measures(regions).select("region_id", "ordinal", "ring", "area", "xmin", "ymin", "xmax", "ymax"), overlap)
    return found.select("child_id", "parent_id", "ordinal", "parent_area", "fraction")


def _is_box(ring: Column) -> Column:
    """Whether the ring is an upright rectangle that goes around once: four corners of its own bounds."""
    def corner(p: Column) -> Column:
        return (p["x"].isin(F.col("xmin"), F.col("xmax"))) & (p["y"].isin(F.col("ymin"), F.col("ymax")))

    return F.coalesce((F.size(ring) == 5) & (F.col("area") > 0) & F.forall(ring, corner), F.lit(False))


def _nested(sized: DataFrame, overlap: float) -> DataFrame:
    """The pairs of ``containments`` from measured shapes, with all columns of the parent but its ring."""
    # Children, parents and the grid's levels all read the measured shapes.
    sized = staged(spread(sized.withColumn("_box", _is_box(F.col("ring")))), "shapes")
    own = [c for c in sized.columns if c not in ("region_id", "ring", "area", "xmin", "ymin", "xmax", "ymax", "_box")]
    bounds = ("xmin", "ymin", "xmax", "ymax")
    child = sized.select(F.col("region_id").alias("child_id"), F.col("area").alias("child_area"), F.col("ring").alias("child_ring"),
                         "_box", *[F.col(c).alias("child_" + c) for c in bounds])
    middle = [((F.col("child_" + a) + F.col("child_" + b)) / 2).alias(c) for c, a, b in (("x", "xmin", "xmax"), ("y", "ymin", "ymax"))]
    boxes = child.where("_box").select("*", *middle).drop("_box")
    others = (child.where("NOT _box").select("*", shapes.median_point(F.col("child_ring")).alias("_p"))
              .select("*", "_p.x", "_p.y").drop("_p", "_box"))
    parents = sized.select(F.col("region_id").alias("parent_id"), *own, F.col("area").alias("parent_area"),
                           F.col("ring").alias("parent_ring"), *bounds, "_box")
    box_parents, other_parents = (parents.where(c).drop("_box") for c in ("_box", "NOT _box"))
    # Two boxes share at least what the shapes in them share, which settles most pairs at once.
    wide = F.least("xmax", "child_xmax") - F.greatest("xmin", "child_xmin")
    high = F.least("ymax", "child_ymax") - F.greatest("ymin", "child_ymin")
    boxes_allow = wide * high > overlap * F.col("child_area") * (1 - 1e-9)
    # Areas that differ by rounding only are equal, and equal areas nest in neither direction.
    larger = F.col("parent_area") > F.col("child_area") * (1 + 1e-9)

    def pairs(children: DataFrame, others: DataFrame, shared: Column) -> DataFrame:
        # Pairs are not moved again: they may be far more than the shapes.
        candidates = point_box_pairs(children, others).where((F.col("child_id") != F.col("parent_id")) & larger & boxes_allow)
        return (candidates.withColumn("fraction", shared / F.col("child_area"))
                # A share that equals the limit up to rounding does not exceed it.
                .where(F.col("fraction") > overlap + 1e-12)
                .select("child_id", "parent_id", *own, "parent_area", "fraction"))

    flat = boxes.drop("child_ring"), box_parents.drop("parent_ring")
    if sized.where("NOT _box").isEmpty():
        return pairs(*flat, wide * high)
    exact = shapes.shared_area(F.col("child_ring"), F.col("parent_ring"))
    if sized.where("_box").isEmpty():
        return pairs(others, other_parents, exact)
    return (pairs(*flat, wide * high).union(pairs(boxes, other_parents, exact))
            .union(pairs(others, box_parents.unionByName(other_parents), exact)))


def parents(regions: DataFrame, overlap: float = fixed.PARENT_OVERLAP, choose: str = "last"
            ) -> DataFrame:
    """``child_id, parent_id``: of several parents the last by ordinal, or the smallest one."""
    _check_overlap(overlap)
    measured = measures(regions).select("region_id", "ordinal", "ring", "area", "xmin", "ymin", "xmax", "ymax")
    # The largest of numbers needs no sorting of all pairs.
    ranked = _ranked(measured, *([F.asc("ordinal")] if choose == "last" else [F.desc("area")]), F.asc("region_id"))
    found = _nested(ranked.drop("ordinal"), overlap).groupBy("child_id").agg(F.max("_rank").alias("_rank"))
    return found.join(ranked.select("_rank", F.col("region_id").alias("parent_id")), "_rank").drop("_rank")


def assemble_lines(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Coordinates of each way, in the order its node list names them.

    ``ways`` is ``(way_id, nodes ARRAY)``, ``nodes`` is ``(node_id, x, y)``, both with unique
    ids. What is gathered per way is as long as the list it arrived with. ``missing`` counts
    node references without a node.
    """
    refs = ways.select("way_id", F.posexplode("nodes").alias("pos", "node_id"))
    found = refs.join(nodes, "node_id", "left")
    point = F.struct("pos", "x", "y")
    return (found.groupBy("way_id")
            .agg(F.array_sort(F.collect_list(F.when(F.col("x").isNotNull(), point))).alias("_p"),
                 F.count_if(F.col("x").isNull()).alias("missing"))
            .select("way_id", F.transform("_p", lambda p: F.struct(p["x"].alias("x"),
                                                                   p["y"].alias("y")))
                    .alias("line"), "missing"))


def outer_members(relations: DataFrame) -> DataFrame:
    """``relation_id, pos, way_id`` of the outer ways of each relation, in member order."""
    return (relations.select(F.col("id").alias("relation_id"),
                             F.posexplode("members").alias("pos", "m"))
            .where((F.col("m.type") == "way") & (F.col("m.role") == "outer"))
            .select("relation_id", "pos", F.col("m.ref").alias("way_id")))


def _walk(members: list) -> dict:
    """Order the ways of one relation into its ring: dead ends cut off, then followed around.

    Bounded regions of a plane graph number edges - vertices + components.
    """
    ways: dict = {}
    for m in sorted(members, key=lambda m: m["pos"]):
        ways.setdefault(m["way_id"], ((m["ax"], m["ay"]), (m["bx"], m["by"])))
    at: dict = {}
    for way, ends in ways.items():
        for end in ends:
            at.setdefault(end, []).append(way)
    component: dict = {}
    for start in at:
        if start in component:
            continue
        component[start] = start
        todo = [start]
        while todo:
            for way in at[todo.pop()]:
                for end in ways[way]:
                    if end not in component:
                        component[end] = start
                        todo.append(end)
    rings = len(ways) - len(at) + len(set(component.values()))
    if rings != 1:
        return {"rings": rings, "steps": []}

    loose = [end for end, touching in at.items() if len(touching) == 1]
    while loose:
        end = loose.pop()
        if len(at[end]) != 1:
            continue
        way = at[end][0]
        for other in ways.pop(way):
            at[other].remove(way)
            if len(at[other]) == 1:
                loose.append(other)
    way = next(iter(ways))
    here, steps = ways[way][0], []
    while way is not None:
        a, b = ways.pop(way)
        steps.append({"way_id": way, "backwards": here != a})
        here = b if here == a else a
        way = next((w for w in at[here] if w in ways), None)
    return {"rings": 1, "steps": steps}


def _walk_all(members: Column) -> Column:
    @F.pandas_udf("rings long, steps array<struct<way_id: long, backwards: boolean>>")
    def run(groups: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_walk(g) for g in groups], columns=["rings", "steps"])

    # Marked so that it is called once per relation, not once per field taken from it.
    return run.asNondeterministic()(members)


def assemble_rings(members: DataFrame, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rings of relations from their outer ways, in whatever direction the ways run.

    Returns ``(relation_id, ring)`` and the rejects ``(relation_id, rings)`` of relations that
    do not form exactly one. Only the ends of each way travel to the walk, one short entry per
    member of the relation's own list; the coordinates join again afterwards.
    """
    ends = lines.select(
        "way_id", F.element_at("line", 1)["x"].alias("ax"), F.element_at("line", 1)["y"].alias("ay"),
        F.element_at("line", -1)["x"].alias("bx"), F.element_at("line", -1)["y"].alias("by"))
    walked = (members.join(ends, "way_id").groupBy("relation_id")
              .agg(F.collect_list(F.struct("pos", "way_id", "ax", "ay", "bx", "by")).alias("m"))
              .select("relation_id", _walk_all(F.col("m")).alias("w"))
              .select("relation_id", "w.rings", "w.steps"))
    ordered = (walked.where(F.col("rings") == 1)
               .select("relation_id", F.posexplode("steps").alias("seq", "s"))
               .select("relation_id", "seq", "s.*"))
    # Every way but the first leaves out its first point, which the way before ended on.
    directed = F.when(F.col("backwards"), F.reverse("line")).otherwise(F.col("line"))
    piece = F.when(F.col("seq") == 0, directed).otherwise(
        F.slice(directed, F.lit(2), F.greatest(F.size("line") - 1, F.lit(0))))
    rings = (ordered.join(lines, "way_id")
             .groupBy("relation_id")
             .agg(F.array_sort(F.collect_list(F.struct("seq", piece.alias("piece")))).alias("_p"))
             .select("relation_id", F.flatten("_p.piece").alias("ring")))
    rejects = walked.where(F.col("rings") != 1).select("relation_id", "rings")
    return rings, rejects
