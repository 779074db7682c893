"""Spatial joins, shape measures and shape assembly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cairn.functions import shapes
from cairn.operators import spatial
from cairn.plans import gazetteer
from cairn.queries import query
from cairn.session import spread


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


# Suppliers as diamond-shaped regions: a point is inside where |x - cx| + |y - cy| < r.
DIAMONDS_SQL = """(SELECT s_suppkey AS region_id, s_suppkey AS ordinal, s_acctbal / 20 AS cx,
                          s_nationkey * 4.1::DOUBLE AS cy, 3 + s_nationkey * 0.7::DOUBLE AS r
                   FROM supplier)"""


def diamonds(t):
    cx, cy = F.col("s_acctbal") / 20, F.col("s_nationkey") * F.lit(4.1)
    r = 3 + F.col("s_nationkey") * F.lit(0.7)
    return t("supplier").select(
        F.col("s_suppkey").alias("region_id"), F.col("s_suppkey").alias("ordinal"),
        cx.alias("cx"), cy.alias("cy"), r.alias("r"),
        F.array(point(cx - r, cy), point(cx, cy - r), point(cx + r, cy), point(cx, cy + r),
                point(cx - r, cy)).alias("ring"))


# The shift keeps points off the diamonds' borders, where rounding would decide in either engine.
def _event_points(t):
    return t("events").select("event_id", F.col("value").alias("x"),
                              (F.get_json_object("props", "$.k").cast("double") + 0.0137).alias("y"))


@query("pip_join", f"""
    WITH p AS (SELECT event_id, value AS x,
                      CAST(json_extract_string(props, '$.k') AS DOUBLE) + 0.0137 AS y FROM events)
    SELECT event_id, (SELECT min_by(region_id, ordinal) FROM {DIAMONDS_SQL}
                      WHERE abs(x - cx) + abs(y - cy) < r) AS region_id FROM p""")
def pip_join(t):
    return spatial.with_region(_event_points(t), diamonds(t), "event_id").select(
        "event_id", "region_id")


def many_sided_diamonds(t, parts: int = 400):
    """The same diamonds with each side cut into parts, so that rings are too large to be carried."""
    ring = F.col("ring")
    def along(e: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda k: F.struct(
            (e["x1"] + (e["x2"] - e["x1"]) * k / parts).alias("x"), (e["y1"] + (e["y2"] - e["y1"]) * k / parts).alias("y")))

    fine = F.concat(F.flatten(F.transform(shapes.edges(ring), along)), F.slice(ring, 1, 1))
    # A few bytes of suppliers make many sides.
    return spread(diamonds(t)).select("region_id", "ordinal", fine.alias("ring"))


@query("pip_large_rings", f"""
    WITH p AS (SELECT event_id, value AS x,
                      CAST(json_extract_string(props, '$.k') AS DOUBLE) + 0.0137 AS y FROM events)
    SELECT event_id, region_id FROM p JOIN {DIAMONDS_SQL} ON abs(x - cx) + abs(y - cy) < r""")
def pip_large_rings(t):
    return spatial.containing_regions(_event_points(t), many_sided_diamonds(t), "event_id").select("event_id", "region_id")


@query("pip_counts", f"""
    WITH p AS (SELECT event_id, value AS x,
                      CAST(json_extract_string(props, '$.k') AS DOUBLE) + 0.0137 AS y FROM events)
    SELECT region_id, count(*) AS points FROM p JOIN {DIAMONDS_SQL}
    ON abs(x - cx) + abs(y - cy) < r GROUP BY 1""")
def pip_counts(t):
    found = spatial.containing_regions(_event_points(t), diamonds(t), "event_id")
    return found.groupBy("region_id").agg(F.count(F.lit(1)).alias("points"))


# Customers as right triangles with legs along the axes.
def _triangles(t):
    x, y = F.col("c_acctbal") / 50, F.col("c_nationkey") * 3.0
    w, h = 1 + F.col("c_nationkey") / 4, 2 + F.abs("c_acctbal") / 1000
    return t("customer").select("c_custkey", F.array(
        point(x, y), point(x + w, y), point(x, y + h), point(x, y)).alias("ring"))


_TRIANGLES = """(SELECT c_custkey, c_acctbal / 50 AS x, c_nationkey * 3.0::DOUBLE AS y,
                        1 + c_nationkey / 4 AS w, 2 + abs(c_acctbal) / 1000 AS h FROM customer)"""


@query("polygon_measures", f"""
    SELECT c_custkey, round(w * h / 2, 9) AS area, round(x + w / 3, 9) AS centroid_x,
           round(y + h / 3, 9) AS centroid_y, round(x, 9) AS xmin, round(y, 9) AS ymin,
           round(x + w, 9) AS xmax, round(y + h, 9) AS ymax FROM {_TRIANGLES}""")
def polygon_measures(t):
    return spatial.measures(_triangles(t)).select("c_custkey", *[
        F.round(c, 9).alias(c) for c in ("area", "centroid_x", "centroid_y", "xmin", "ymin",
                                         "xmax", "ymax")])


@query("overall_bbox", f"""
    SELECT round(min(x), 6) AS xmin, round(min(y), 6) AS ymin, round(max(x + w), 6) AS xmax,
           round(max(y + h), 6) AS ymax FROM {_TRIANGLES}""")
def overall_bbox(t):
    box = spatial.overall_bounds(spatial.measures(_triangles(t)))
    return box.select(*[F.round(c, 6).alias(c) for c in box.columns])


# Nations as large squares, suppliers as middling and customers as small rectangles within or
# across them.
def _rectangle(x: Column, y: Column, w: Column, h: Column) -> Column:
    return F.array(point(x, y), point(x + w, y), point(x + w, y + h), point(x, y + h), point(x, y))


def _boxes(t):
    nations = t("nation").select(
        F.concat(F.lit("N"), "n_nationkey").alias("region_id"),
        (F.col("n_nationkey") * 100.0).alias("x"), F.lit(0.0).alias("y"),
        F.lit(100.0).alias("w"), F.lit(100.0).alias("h"))
    suppliers = t("supplier").select(
        F.concat(F.lit("S"), "s_suppkey").alias("region_id"),
        (F.col("s_nationkey") * 100 + F.abs("s_acctbal") / 130).alias("x"),
        (F.abs("s_acctbal") / 200).alias("y"), F.lit(30.0).alias("w"), F.lit(40.0).alias("h"))
    customers = t("customer").select(
        F.concat(F.lit("C"), "c_custkey").alias("region_id"),
        (F.col("c_nationkey") * 100 + F.abs("c_acctbal") / 101).alias("x"),
        (F.abs("c_acctbal") / 110).alias("y"), F.lit(2.0).alias("w"),
        (1 + F.abs("c_acctbal") / 5000).alias("h"))
    boxes = nations.unionByName(suppliers).unionByName(customers)
    return boxes.select("region_id", F.col("region_id").alias("ordinal"), "x", "y", "w", "h",
                        _rectangle(*[F.col(c) for c in "xywh"]).alias("ring"))


_BOXES = """(SELECT 'N' || n_nationkey AS id, n_nationkey * 100.0::DOUBLE AS x, 0.0::DOUBLE AS y,
                    100.0::DOUBLE AS w, 100.0::DOUBLE AS h FROM nation
             UNION ALL SELECT 'S' || s_suppkey, s_nationkey * 100 + abs(s_acctbal) / 130,
                    abs(s_acctbal) / 200, 30, 40 FROM supplier
             UNION ALL SELECT 'C' || c_custkey, c_nationkey * 100 + abs(c_acctbal) / 101,
                    abs(c_acctbal) / 110, 2, 1 + abs(c_acctbal) / 5000 FROM customer)"""
_NESTED = f"""(SELECT c.id AS child_id, p.id AS parent_id, p.w * p.h AS parent_area,
        greatest(0, least(c.x + c.w, p.x + p.w) - greatest(c.x, p.x))
        * greatest(0, least(c.y + c.h, p.y + p.h) - greatest(c.y, p.y)) / (c.w * c.h) AS fraction
    FROM {_BOXES} c JOIN {_BOXES} p ON c.id <> p.id AND p.w * p.h > c.w * c.h * (1 + 1e-9)
     AND c.x < p.x + p.w AND p.x < c.x + c.w AND c.y < p.y + p.h AND p.y < c.y + c.h)"""


@query("polygon_containment", f"""
    SELECT child_id, parent_id, round(fraction, 6) AS fraction FROM {_NESTED}
    WHERE fraction > 0.99 + 1e-12""")
def polygon_containment(t):
    return spatial.containments(_boxes(t)).select("child_id", "parent_id",
                                                  F.round("fraction", 6).alias("fraction"))


# Right triangles of one shape, legs along the axes: what two of them share is such a triangle.
_SLOPE = 2.0
_CORNERS = """(SELECT 'N' || n_nationkey AS id, n_nationkey * 60.0::DOUBLE AS x, 0.0::DOUBLE AS y, 90.0::DOUBLE AS w FROM nation
    UNION ALL SELECT 'S' || s_suppkey, s_nationkey * 60 + abs(s_acctbal) / 400, abs(s_acctbal) / 300, 30 FROM supplier
    UNION ALL SELECT 'C' || c_custkey, c_nationkey * 60 + abs(c_acctbal) / 210, abs(c_acctbal) / 170, 3 + c_nationkey / 4 FROM customer)"""


def corner_triangles(t):
    parts = [("N", t("nation").select("n_nationkey", F.col("n_nationkey").alias("k"), F.lit(0.0).alias("b")), 90.0, (1.0, 1.0)),
             ("S", t("supplier").select("s_suppkey", F.col("s_nationkey").alias("k"), F.abs("s_acctbal").alias("b")), 30.0, (400.0, 300.0)),
             ("C", t("customer").select("c_custkey", F.col("c_nationkey").alias("k"), F.abs("c_acctbal").alias("b")), None, (210.0, 170.0))]
    frames = []
    for letter, rows, wide, (across, up) in parts:
        x, y = F.col("k") * 60 + F.col("b") / across, F.col("b") / up
        w = F.lit(wide) if wide else 3 + F.col("k") / 4
        frames.append(rows.select(F.concat(F.lit(letter), F.col(rows.columns[0]).cast("string")).alias("region_id"), F.array(
            point(x, y), point(x + w, y), point(x, y + _SLOPE * w), point(x, y)).alias("ring")))
    return frames[0].union(frames[1]).union(frames[2]).withColumn("ordinal", F.col("region_id"))


@query("triangle_containment", f"""
    WITH c AS (SELECT *, x + y / {_SLOPE} + w AS reach FROM {_CORNERS}),
    p AS (SELECT a.id AS child_id, b.id AS parent_id, a.w AS side,
                 greatest(0, least(a.reach, b.reach) - greatest(a.x, b.x) - greatest(a.y, b.y) / {_SLOPE}) AS leg
          FROM c a JOIN c b ON a.id <> b.id AND b.w > a.w * (1 + 1e-9))
    SELECT child_id, parent_id, round((leg / side) * (leg / side), 6) AS fraction FROM p
    WHERE (leg / side) * (leg / side) > 0.9""")
def triangle_containment(t):
    return spatial.containments(corner_triangles(t), 0.9).select("child_id", "parent_id", F.round("fraction", 6).alias("fraction"))


@query("polygon_parent", f"""
    SELECT child_id, max(parent_id) AS parent_id FROM {_NESTED} WHERE fraction > 0.99 + 1e-12 GROUP BY 1""")
def polygon_parent(t):
    return spatial.parents(_boxes(t))


# Embeddings as ways: each component names an event, whose value and k are its coordinates.
def _ways(t):
    ways = t("embeddings").select(
        F.col("vec_id").alias("way_id"),
        F.transform("embedding", lambda e: F.floor(F.abs(e) * 1000).cast("bigint")).alias("nodes"))
    nodes = t("events").select(F.col("event_id").alias("node_id"), F.col("value").alias("x"),
                               F.get_json_object("props", "$.k").cast("double").alias("y"))
    return ways, nodes


@query("way_assembly", """
    WITH refs AS (SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS pos,
                         CAST(floor(abs(unnest(embedding)) * 1000) AS BIGINT) AS node FROM embeddings),
    pts AS (SELECT vec_id, pos, value AS x, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS y
            FROM refs JOIN events ON node = event_id)
    SELECT vec_id AS way_id, count(*) AS points, min_by(x, pos) AS first_x, max_by(x, pos) AS last_x,
           round(sum(x * pos), 4) AS weighted_x, round(sum(y * pos), 4) AS weighted_y
    FROM pts GROUP BY 1""")
def way_assembly(t):
    lines = spatial.assemble_lines(*_ways(t))
    at = F.posexplode("line").alias("pos", "p")
    return (lines.select("way_id", "line", at).groupBy("way_id").agg(
        F.count(F.lit(1)).alias("points"), F.min_by("p.x", "pos").alias("first_x"),
        F.max_by("p.x", "pos").alias("last_x"),
        F.round(F.sum(F.col("p.x") * (F.col("pos") + 1)), 4).alias("weighted_x"),
        F.round(F.sum(F.col("p.y") * (F.col("pos") + 1)), 4).alias("weighted_y")))


@query("line_simplify")
def line_simplify(t):
    lines = spatial.assemble_lines(*_ways(t))
    kept = shapes.simplify(F.col("line"), 25.0)
    return lines.select("way_id", F.size("line").alias("points"), F.size(kept).alias("kept"))


@query("line_simplify_known", """
    SELECT c_custkey, 5 AS kept, [0, 10, 20, 30, 40] AS xs, CASE WHEN c_nationkey > 0 THEN 41 ELSE 5 END AS kept_fine
    FROM customer""")
def line_simplify_known(t):
    # A zigzag of five corners with points between them that leave its sides by a thousandth of the nation.
    high, off = 5 + F.abs("c_acctbal") / 500, F.col("c_nationkey") * 0.001
    def at(k: Column) -> Column:
        side, part = F.floor(k / 10), k % 10
        up = F.when(side % 2 == 0, part / 10).otherwise(1 - part / 10)
        way = F.when(part == 0, 0.0).when(k % 2 == 0, off).otherwise(-off)
        return F.struct(k.cast("double").alias("x"), (up * high + way).alias("y"))

    lines = spread(t("customer").select("c_custkey", "c_acctbal", "c_nationkey")).select("c_custkey", F.transform(F.sequence(F.lit(0), F.lit(40)), at).alias("line"))
    kept = lines.select("c_custkey", shapes.simplify(F.col("line"), 2.0).alias("coarse"),
                        shapes.simplify(F.col("line"), 1e-9).alias("fine"))
    return kept.select("c_custkey", F.size("coarse").alias("kept"),
                       F.transform(F.col("coarse.x"), lambda x: x.cast("int")).alias("xs"), F.size("fine").alias("kept_fine"))


# Customers as relations of three ways that run in mixed directions around a rectangle. Ways of
# BUILDING customers do not close, FURNITURE ones have a dead end to be cut off.
def _relation_elements(t):
    x, y = F.col("c_acctbal") / 40, F.col("c_nationkey") * 5.0
    w, h = 1 + F.col("c_nationkey") / 10, 2 + F.abs("c_acctbal") / 3000
    c = t("customer").select((F.col("c_custkey") * 10).alias("k"), "c_name", "c_mktsegment",
                             x.alias("x"), y.alias("y"), w.alias("w"), h.alias("h"))
    k = F.col("k")
    corners = [("x", "y", 0, 0), ("x", "y", 1, 0), ("x", "y", 1, 1), ("x", "y", 0, 1),
               ("x", "y", 2, 2)]
    node = F.explode(F.array(*[F.struct(
        (k + i).alias("id"), (F.col(px) + F.col("w") * dx).alias("lon"),
        (F.col(py) + F.col("h") * dy).alias("lat")) for i, (px, py, dx, dy) in enumerate(corners)]))
    nodes = c.select(node.alias("n")).select(F.lit("node").alias("type"), "n.*")
    broken, furnished = F.col("c_mktsegment") == "BUILDING", F.col("c_mktsegment") == "FURNITURE"
    way = F.explode(F.array(
        F.struct((k + 5).alias("id"), F.array(k, k + 1).alias("nodes")),
        F.struct((k + 6).alias("id"), F.array(k + 3, k + 2, k + 1).alias("nodes")),
        F.struct((k + 7).alias("id"), F.when(broken, F.array(k + 3, k + 4))
                 .otherwise(F.array(k + 3, k)).alias("nodes")),
        F.struct((k + 8).alias("id"), F.array(k + 2, k + 3, k + 4).alias("nodes"))))
    ways = c.select(way.alias("w")).select(F.lit("way").alias("type"), "w.*")

    def member(ref: Column, role: str) -> Column:
        return F.struct(F.lit("way").alias("type"), ref.alias("ref"), F.lit(role).alias("role"))

    members = F.array(member(k + 7, "outer"), member(k + 5, "outer"), member(k + 6, "outer"),
                      member(k + 8, "inner"))
    stub = F.array(member(k + 9, "outer"))
    relations = c.select(
        F.lit("relation").alias("type"), (k + 9).alias("id"),
        F.create_map(F.lit("name"), F.concat(F.translate("c_name", "0123456789#", "ABCDEFGHIJ"),
                                             F.lit(" Himal"))).alias("tags"),
        F.when(furnished, F.concat(members, stub)).otherwise(members).alias("members"))
    spur = c.where(furnished).select(F.lit("way").alias("type"), (k + 9).alias("id"),
                                     F.array(k + 2, k + 4).alias("nodes"))
    parts = [nodes, ways, spur, relations]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.withColumn("ordinal", F.lit(0).cast("bigint")).select(
        "ordinal", "type", "id", "lon", "lat", "tags", "nodes", "members")


RECTANGLES_SQL = """(SELECT c_custkey, 'CUSTOMER' || translate(substr(c_name, 10), '0123456789',
        'ABCDEFGHIJ') AS region_id, c_mktsegment, c_acctbal / 40 AS x, c_nationkey * 5.0::DOUBLE AS y,
        1 + c_nationkey / 10 AS w, 2 + abs(c_acctbal) / 3000 AS h FROM customer)"""


def _rings(t):
    elements = _relation_elements(t)
    ways = elements.where("type = 'way'").select(F.col("id").alias("way_id"), "nodes")
    nodes = elements.where("type = 'node'").select(
        F.col("id").alias("node_id"), F.col("lon").alias("x"), F.col("lat").alias("y"))
    members = spatial.outer_members(elements.where("type = 'relation'"))
    return spatial.assemble_rings(members, spatial.assemble_lines(ways, nodes).drop("missing"))


@query("ring_assembly", f"""
    SELECT c_custkey * 10 + 9 AS relation_id, 5 AS points, round(w * h, 6) AS area,
           round(x + w / 2, 6) AS centroid_x, round(y + h / 2, 6) AS centroid_y
    FROM {RECTANGLES_SQL} WHERE c_mktsegment <> 'BUILDING'""")
def ring_assembly(t):
    return spatial.measures(_rings(t)[0]).select(
        "relation_id", F.size("ring").alias("points"),
        *[F.round(c, 6).alias(c) for c in ("area", "centroid_x", "centroid_y")])


@query("ring_rejects", f"""
    SELECT c_custkey * 10 + 9 AS relation_id, CAST(0 AS BIGINT) AS rings FROM {RECTANGLES_SQL}
    WHERE c_mktsegment = 'BUILDING'""")
def ring_rejects(t):
    return _rings(t)[1]


@query("region_build", f"""
    WITH r AS (SELECT * FROM {RECTANGLES_SQL} WHERE c_mktsegment <> 'BUILDING'),
    nested AS (
        SELECT c.region_id AS child, max(p.region_id) AS parent FROM r c JOIN r p
        ON c.region_id <> p.region_id AND p.w * p.h > c.w * c.h * (1 + 1e-9)
        AND greatest(0, least(c.x + c.w, p.x + p.w) - greatest(c.x, p.x))
            * greatest(0, least(c.y + c.h, p.y + p.h) - greatest(c.y, p.y)) / (c.w * c.h) > 0.99 + 1e-12
        GROUP BY 1)
    SELECT region_id AS himal_id, round(x + w / 2, 6) AS longitude,
           round(y + h / 2, 6) AS latitude, parent AS parent_himal_id
    FROM r LEFT JOIN nested ON child = region_id""")
def region_build(t):
    regions, _ = gazetteer.region_shapes(_relation_elements(t), tolerance=0.005)
    # The last parent is the one with the largest id here.
    table = gazetteer.region_table(regions.withColumn("ordinal", F.col("region_id")))
    return gazetteer.region_rows(table).select(
        "himal_id", F.round("longitude", 6).alias("longitude"),
        F.round("latitude", 6).alias("latitude"), "parent_himal_id")
