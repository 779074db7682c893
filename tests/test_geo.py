"""Geometry against closed forms and plain loops."""

import json
import math
import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.functions import shapes
from cairn.operators import spatial
from cairn.plans import gazetteer
from cairn.sources import elements as el, geojson

RING = "ring ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>"
REGION = f"region_id STRING, ordinal INT, {RING}"


def square(x, y, w, h=None):
    h = w if h is None else h
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]


CONCAVE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0), (0.0, 0.0)]


def test_contains_is_interior_only(spark):
    inside = [(1.0, 1.0), (3.9, 3.0), (2.0, 0.5)]
    outside = [(2.0, 3.0), (5.0, 1.0), (-0.1, 0.0), (2.0, -0.001)]
    border = [(2.0, 0.0), (0.0, 2.0), (4.0, 4.0), (2.0, 1.0), (0.0, 0.0), (3.0, 2.5)]
    for ring in (CONCAVE, CONCAVE[::-1]):
        df = spark.createDataFrame([(x, y, ring) for x, y in inside + outside + border],
                                   f"x DOUBLE, y DOUBLE, {RING}")
        got = [r[0] for r in df.select(shapes.contains(
            shapes.edges(F.col("ring")), F.col("x"), F.col("y"))).collect()]
        assert got == [True] * 3 + [False] * (4 + 6)


def test_point_joins_equal_brute_force(spark):
    rng = random.Random(3)
    regions = []
    for i in range(60):
        cx, cy, size = rng.uniform(-20, 20), rng.uniform(-20, 20), 2 ** rng.uniform(-6, 5)
        angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(7))
        ring = [(cx + size * math.cos(a), cy + size * math.sin(a)) for a in angles]
        regions.append((f"R{i:02d}", 60 - i, ring + ring[:1]))
    points = [(i, rng.uniform(-30, 30), rng.uniform(-30, 30)) for i in range(400)]
    # A third of all points fall on one spot.
    points += [(400 + i, 1.25, 1.5) for i in range(200)] + [(999, None, 1.0)]

    def inside(x, y, ring):
        odd = False
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
        return odd

    expected = {}
    for i, x, y in points:
        hits = [(o, r) for r, o, ring in regions if x is not None and inside(x, y, ring)]
        expected[i] = min(hits)[1] if hits else None
    pdf = spark.createDataFrame(points, "id INT, x DOUBLE, y DOUBLE")
    rdf = spark.createDataFrame(regions, REGION)
    got = {r.id: r.region_id for r in spatial.with_region(pdf, rdf, "id").collect()}
    assert got == expected
    plan = spatial.with_region(pdf, rdf, "id")._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_override_beats_the_point(spark):
    points = spark.createDataFrame([(1, 1.0, 1.0, "HERE"), (2, 1.0, 1.0, None), (3, None, None, None)],
                                   "id INT, x DOUBLE, y DOUBLE, o STRING")
    regions = spark.createDataFrame([("A", 1, square(0.0, 0.0, 2.0))], REGION)
    got = {r.id: r.region_id for r in spatial.with_region(points, regions, "id", override="o").collect()}
    assert got == {1: "HERE", 2: "A", 3: None}


def test_measures(spark):
    df = spark.createDataFrame([("s", 1, square(10.0, -5.0, 4.0, 2.0)), ("c", 2, CONCAVE)], REGION)
    got = {r.region_id: r for r in spatial.measures(df).collect()}
    s = got["s"]
    assert (s.area, s.centroid_x, s.centroid_y, s.xmin, s.ymax) == (8.0, 12.0, -4.0, 10.0, -3.0)
    assert got["c"].area == pytest.approx(10.0) and got["c"].centroid_x == pytest.approx(2.0)
    box = spatial.overall_bounds(spatial.measures(df)).first()
    assert tuple(box) == (0.0, -5.0, 14.0, 4.0)


def test_overlap_area_is_exact():
    a = np.array(square(0.0, 0.0, 4.0))
    assert shapes.overlap_area(a, np.array(square(3.0, 3.0, 4.0))) == pytest.approx(1.0)
    assert shapes.overlap_area(a, np.array(square(4.0, 0.0, 4.0))) == 0.0
    assert shapes.overlap_area(a, a) == pytest.approx(16.0)
    diamond = np.array([(2.0, -2.0), (6.0, 2.0), (2.0, 6.0), (-2.0, 2.0), (2.0, -2.0)])
    assert shapes.overlap_area(a, diamond) == pytest.approx(16.0)
    small = np.array([(4.0, 1.0), (5.0, 2.0), (4.0, 3.0), (3.0, 2.0), (4.0, 1.0)])
    assert shapes.overlap_area(a, small) == pytest.approx(1.0)
    assert shapes.overlap_area(np.array(CONCAVE), np.array(square(0.0, 0.0, 4.0, 1.0))
                               ) == pytest.approx(4.0)
    # Against a fine lattice on shapes with no common structure.
    rng = np.random.default_rng(4)
    for _ in range(5):
        def star():
            t = np.sort(rng.uniform(0, 2 * np.pi, 9))
            r = rng.uniform(1, 3, 9)
            p = np.column_stack([r * np.cos(t), r * np.sin(t)]) + rng.uniform(-1, 1, 2)
            return np.vstack([p, p[:1]])
        p, q = star(), star()
        g = np.linspace(-5, 5, 801)
        share = 0.0
        for y in g + 1e-7:
            masks = []
            for ring in (p, q):
                u, v = ring[:-1], ring[1:]
                hit = (u[:, 1] < y) != (v[:, 1] < y)
                x = np.sort((u[:, 0] + (y - u[:, 1]) * (v - u)[:, 0] / np.where(hit, (v - u)[:, 1], 1))[hit])
                masks.append(np.searchsorted(x, g) % 2 == 1)
            share += (masks[0] & masks[1]).sum()
        assert shapes.overlap_area(p, q) == pytest.approx(share * (g[1] - g[0]) ** 2, rel=0.03, abs=0.05)


def circle(n, x, y, r):
    t = 2 * math.pi * np.arange(n) / n
    p = np.column_stack([x + r * np.cos(t), y + r * np.sin(t)])
    return np.vstack([p, p[:1]])


def lens(r, s, d):
    """The area that two circles of these radii and distance share."""
    a = math.acos((d * d + r * r - s * s) / (2 * d * r))
    b = math.acos((d * d + s * s - r * r) / (2 * d * s))
    return r * r * (a - math.sin(2 * a) / 2) + s * s * (b - math.sin(2 * b) / 2)


@pytest.mark.parametrize("portion", [1 << 19, 64])
def test_overlap_of_rings_with_very_many_sides(monkeypatch, portion):
    n = 20_000 if portion > 64 else 500
    monkeypatch.setattr(shapes, "PORTION", portion)
    one, two = circle(n, 0, 0, 5), circle(n, 3.1, 0.4, 4)
    tracemalloc.start()
    assert shapes.overlap_area(one, two) == pytest.approx(lens(5, 4, math.hypot(3.1, 0.4)), rel=1e-4)
    assert shapes.overlap_area(one, np.array(square(-1.0, -1.0, 2.0))) == pytest.approx(4.0)
    assert shapes.overlap_area(np.array(comb(400, 50)), circle(n, 400, 0, 30)) > 0
    assert shapes._middle(one, 0) == pytest.approx(0, abs=0.01) and shapes._middle(two, 1) == pytest.approx(0.4, abs=0.05)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400e6  # a table of all sides by all sides has 3.2 GB


def test_overlap_does_not_depend_on_portions(monkeypatch):
    rnd = random.Random(9)
    pairs = [(np.array(star(rnd, 60, 0, 0, 5, 0.9)), np.array(star(rnd, 45, 1, 1, 4, 0.7))) for _ in range(10)]
    pairs.append((np.array(comb(9, 6)), np.array([(y, x) for x, y in comb(7, 9)])))
    whole = [shapes.overlap_area(a, b) for a, b in pairs]
    monkeypatch.setattr(shapes, "PORTION", 1)
    assert [shapes.overlap_area(b, a) for a, b in pairs] == pytest.approx(whole)
    # Teeth of two combs at right angles: a tooth meets a tooth in one square, and the backs meet all.
    teeth = sum(min(x + 1, 9) - x for x in range(0, 14, 2) if x < 9)
    assert whole[-1] > teeth


def test_parents(spark):
    df = spark.createDataFrame([
        ("BIG", 1, square(0.0, 0.0, 100.0)), ("MID", 2, square(10.0, 10.0, 50.0)),
        ("TWIN", 3, square(10.0, 10.0, 50.0)), ("FULL", 4, square(20.0, 20.0, 5.0)),
        ("MOST", 5, square(59.85, 20.0, 10.0)), ("ALMOST", 6, square(99.05, 40.0, 1.0)),
        ("INSIDE99", 7, square(99.005, 60.0, 1.0)), ("APART", 8, square(500.0, 0.0, 1.0))], REGION)
    got = {r.child_id: r.parent_id for r in spatial.parents(df).collect()}
    # Equal areas nest in neither direction; 95 % is too little, 99.5 % enough.
    assert got == {"MID": "BIG", "TWIN": "BIG", "FULL": "TWIN", "MOST": "BIG", "INSIDE99": "BIG"}
    small = {r.child_id: r.parent_id for r in spatial.parents(df, choose="smallest").collect()}
    assert small["FULL"] in ("MID", "TWIN")
    with pytest.raises(ValueError):
        spatial.containments(df, 0.6)


def recursive_simplify(points, tolerance):
    if len(points) < 3:
        return points
    (x1, y1), (x2, y2) = points[0], points[-1]
    def away(p):
        dx, dy = x2 - x1, y2 - y1
        n = dx * dx + dy * dy
        t = 0 if n == 0 else min(max(((p[0] - x1) * dx + (p[1] - y1) * dy) / n, 0), 1)
        return math.hypot(p[0] - x1 - t * dx, p[1] - y1 - t * dy)
    far = max(range(1, len(points) - 1), key=lambda i: (away(points[i]), -i))
    if away(points[far]) <= tolerance:
        return [points[0], points[-1]]
    return recursive_simplify(points[:far + 1], tolerance)[:-1] + recursive_simplify(points[far:], tolerance)


def test_simplify_equals_the_recursive_definition(spark):
    rng = random.Random(8)
    lines = [[(float(i), rng.uniform(0, 3)) for i in range(n)] for n in (2, 3, 10, 80, 200)]
    lines.append([(0.0, 0.0), (1.0, 1.0), (0.0, 0.0)])
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)],
                               "id INT, line ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>")
    for tolerance in (0.0, 0.5, 1.2):
        got = {r.id: [tuple(p) for p in r.s] for r in df.select(
            "id", shapes.simplify(F.col("line"), tolerance).alias("s")).collect()}
        for i, line in enumerate(lines):
            assert got[i] == recursive_simplify(line, tolerance)


def elements():
    node = lambda i, x, y: {"type": "node", "id": i, "lon": x, "lat": y}
    way = lambda i, *n: {"type": "way", "id": i, "nodes": list(n)}

    def rel(i, name, ways, **tags):
        return {"type": "relation", "id": i, "tags": {"name": name, **tags}, "members":
                [{"type": "way", "ref": w, "role": "outer"} for w in ways]
                + [{"type": "node", "ref": 1, "role": "label"}]}

    return [
        node(1, 86.0, 27.0), node(2, 88.0, 27.0), node(3, 88.0, 29.0), node(4, 86.0, 29.0),
        node(5, 90.0, 30.0), node(6, 86.5, 27.5), node(7, 87.0, 27.5), node(8, 87.0, 28.0),
        node(9, 87.0, 26.999),
        # Three ways in mixed directions, the first with a point that simplification removes.
        way(10, 1, 9, 2), way(11, 4, 3, 2), way(12, 4, 1), way(13, 3, 5), way(14, 6, 7, 8, 6),
        way(15, 1, 404),
        rel(20, "Khumbu Himal", [12, 11, 10], alt_name="Everest Range"),
        rel(21, "Dead End Himal", [10, 11, 12, 13]), rel(22, "Open Himal", [10, 11]),
        rel(23, "Small Subsection", [14]), rel(24, "Two Rings Himal", [10, 11, 12, 14]),
        rel(25, "Lost Himal", [10, 99]), rel(26, "Lost Node Himal", [15]), rel(27, "Empty Himal", []),
        {"type": "relation", "id": 28, "members": [{"type": "way", "ref": 14, "role": "outer"}]},
    ]


def test_region_build_from_elements(spark, tmp_path):
    path = str(tmp_path / "himal.json")
    with open(path, "w") as f:
        json.dump({"elements": elements()}, f)
    read = el.read_elements(spark, path)
    assert read.count() == len(elements())
    regions, rejects = gazetteer.region_shapes(read)
    bad = {r.relation_id: r.reason for r in rejects.collect()}
    assert bad == {22: "forms 0 rings, not 1", 24: "forms 2 rings, not 1",
                   25: "an outer way is missing or incomplete",
                   26: "an outer way is missing or incomplete", 27: "has no outer way", 28: "has no name"}
    table = {r.region_id: r for r in gazetteer.region_table(regions).collect()}
    assert set(table) == {"KHUMBU", "DEADEND", "SMALL"}
    assert [tuple(p) for p in table["KHUMBU"].ring][0] == tuple(table["KHUMBU"].ring[-1])
    assert len(table["KHUMBU"].ring) == 5 and table["KHUMBU"].area == pytest.approx(4.0)
    assert table["SMALL"].parent == "DEADEND" or table["SMALL"].parent == "KHUMBU"
    assert table["SMALL"].area == pytest.approx(0.125)
    out = {r.himal_id: r for r in gazetteer.region_rows(gazetteer.region_table(regions)).collect()}
    assert out["KHUMBU"].alternate_names == "Everest Range"
    assert out["KHUMBU"].dms_longitude == "87° 00′ 00.00000″ E"
    assert out["DEADEND"].alternate_names == ""


def test_region_filter_and_geojson(spark, tmp_path):
    rows = [(1, {"region:type": "mountain_area", "name": "Khumbu HIMAL"}),
            (2, {"region:type": "mountain_area", "name": "Jugal and Langtang Himal"}),
            (3, {"region:type": "other", "name": "X Himal"}), (4, {"region:type": "mountain_area"})]
    df = spark.createDataFrame([("relation", i, t) for i, t in rows],
                               "type STRING, id LONG, tags MAP<STRING, STRING>")
    assert [r.id for r in gazetteer.region_elements(df).collect()] == [1]

    regions = spark.createDataFrame([("B", 1, square(0.0, 0.0, 9.0)), ("A", 2, square(1.0, 1.0, 2.0))],
                                    REGION).withColumn("name", F.col("region_id")).withColumn(
        "alternate_names", F.lit(None).cast("array<string>"))
    table = gazetteer.region_table(regions)
    path = geojson.write_collection(geojson.region_features(table), str(tmp_path / "g"),
                                    spatial.overall_bounds(table))
    lines = [json.loads(r.value) for r in spark.read.text(path + "/features").collect()]
    by_id = {f["id"]: f for f in lines}
    assert by_id["A"]["properties"] == {"name": "A", "centroid": [2.0, 2.0], "parent": "B"}
    assert by_id["B"]["bbox"] == [0.0, 0.0, 9.0, 9.0] and "parent" not in by_id["B"]["properties"]
    assert json.loads(spark.read.text(path + "/header").first()[0])["bbox"] == [0.0, 0.0, 9.0, 9.0]
    back = geojson.read_region_features(spark, path + "/features")
    assert {(r.region_id, r.parent, len(r.ring)) for r in back.collect()} == {("A", "B", 5), ("B", None, 5)}
    whole = str(tmp_path / "whole.geojson")
    with open(whole, "w") as f:
        json.dump({"type": "FeatureCollection", "features": lines}, f)
    assert geojson.read_region_features(spark, whole, collection=True).count() == 2


def test_peak_cleaning(spark, tmp_path):
    nodes = [
        {"type": "node", "id": 1, "lon": 86.925, "lat": 27.9881, "tags": {
            "alt_name": "Chomo lungma;सगरमाथा", "natural": "peak", "name": "everest ii (Sagarmatha)",
            "name:en": "Everest II, 8848"}},
        {"type": "node", "id": 2, "lon": 86.0, "lat": 28.0, "tags": {"natural": "peak", "name": "8848; ;é"}},
        {"type": "node", "id": 3, "lon": 90.0, "lat": 28.0, "tags": {"natural": "peak", "name": "East"}},
        {"type": "node", "id": 4, "lon": 86.0, "lat": 28.0, "tags": {"natural": "peak", "int_name": "No"}}]
    path = str(tmp_path / "peak.json")
    with open(path, "w") as f:
        json.dump({"elements": nodes}, f)
    got = gazetteer.named_points(gazetteer.peak_elements(el.read_elements(spark, path))).collect()
    assert [(r.peak_id, r.peak_name, r.alternate_names) for r in got] == [
        (1, "Chomo Lungma", "Everest II,Sagarmatha")]
    assert got[0].dms_longitude == "86° 55′ 30.00000″ E"


def test_short_rings_stay_in_the_table(spark):
    rows = [("B", 1, square(0.0, 0.0, 9.0)), ("C", 2, square(0.0, 0.0, 9.0)[:2]), ("D", 3, None)]
    regions = spark.createDataFrame(rows, REGION).withColumn("name", F.col("region_id"))
    got = {r.region_id: r.area for r in gazetteer.region_table(regions).collect()}
    assert got == {"B": pytest.approx(81.0), "C": None, "D": None}


# Large rings ------------------------------------------------------------------------------------

def star(rnd, n, cx, cy, r, wild):
    """A ring around a centre whose distance from it changes from vertex to vertex."""
    turns = sorted(rnd.uniform(0, 2 * math.pi) for _ in range(n))
    ring = [(cx + (d := r * rnd.uniform(1 - wild, 1)) * math.cos(t), cy + d * math.sin(t)) for t in turns]
    return ring + ring[:1]


def comb(n, high):
    """Teeth with sides along the axes, at whole numbers."""
    ring = [(0.0, 0.0)]
    for k in range(n):
        ring += [(2.0 * k, float(high)), (2.0 * k + 1, float(high)), (2.0 * k + 1, 1.0), (2.0 * k + 2, 1.0)]
    ring += [(2.0 * n, 0.0), (0.0, 0.0)]
    return ring


def inside_by_hand(ring, x, y):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False):
        side = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
        if side == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
            return False
        odd ^= (y1 <= y < y2 and side > 0) or (y2 <= y < y1 and side < 0)
    return odd


def ring_frame(spark, rings):
    rows = [(f"r{k}", k, [(float(x), float(y)) for x, y in ring]) for k, ring in enumerate(rings)]
    return spark.createDataFrame(rows, "region_id string, ordinal int, ring array<struct<x: double, y: double>>")


def test_large_rings_equal_the_test_of_all_sides(spark, monkeypatch):
    monkeypatch.setattr(spatial, "MANY_SIDES", 8)
    rnd = random.Random(11)
    rings = [star(rnd, n, rnd.uniform(-9, 9), rnd.uniform(-9, 9), rnd.choice([0.01, 3, 8]), wild)
             for n, wild in ((5, 0.5), (40, 0.0), (40, 0.9), (300, 0.3), (900, 0.95), (900, 0.01))]
    rings += [comb(6, 7), [(x + 0.5, y) for x, y in comb(3, 4)], [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)] * 1 + [],
              [(x / 4, 0.0) for x in range(16)] + [(4.0, y / 4) for y in range(16)] + [(4 - x / 4, 4.0) for x in range(16)]
              + [(0.0, 4 - y / 4) for y in range(17)]]
    points = [(rnd.uniform(-14, 14), rnd.uniform(-14, 14)) for _ in range(300)]
    points += [(float(x), float(y)) for x in range(-1, 8) for y in range(-1, 8)] + [rnd.choice(rnd.choice(rings)) for _ in range(60)]
    points += [(x + 0.25, y + 0.5) for x in range(13) for y in range(8)] + points[:3]
    frame = spark.createDataFrame([(k % 500, float(x), float(y)) for k, (x, y) in enumerate(points)] + [(999, None, 1.0)],
                                  "id int, x double, y double")
    got = sorted(map(tuple, spatial.containing_regions(frame, ring_frame(spark, rings), "id").collect()))
    want = sorted((k % 500, f"r{j}", j) for k, (x, y) in enumerate(points) for j, ring in enumerate(rings) if inside_by_hand(ring, x, y))
    assert len(want) > 400 and got == want


def test_a_point_meets_few_sides_of_a_large_ring(spark):
    n = 20_000
    circle = [(10 * math.cos(2 * math.pi * k / n), 10 * math.sin(2 * math.pi * k / n)) for k in range(n)]
    circle.append(circle[0])
    rnd = random.Random(5)
    points = [(k, rnd.uniform(-11, 11), rnd.uniform(-11, 11)) for k in range(2000)]
    points += [(2000 + k, x * 0.99999, y * 0.99999) for k, (x, y) in enumerate(circle[::400])]
    frame = spark.createDataFrame(points, "id int, x double, y double")
    found = {r.id for r in spatial.containing_regions(frame, ring_frame(spark, [circle]), "id").collect()}
    # The ring is a circle but for a hair.
    assert all((math.hypot(x, y) < 10 * math.cos(math.pi / n)) == (k in found) for k, x, y in points)

    rings = spatial.measures(ring_frame(spark, [circle])).withColumnRenamed("edges", "_edges").withColumn("_ring", F.lit(0))
    sides = spatial.ring_sides(rings)
    assert sides.count() <= 2 * n
    cells = spatial.large_ring_cells(rings, sides)
    assert cells.count() < 48 * 48 and cells.where("_whole").count() > 200
    pairs = frame.selectExpr("id AS _pair", "0 AS _ring", "x AS _x", "y AS _y")
    met = [r["count"] for r in spatial.side_pairs(pairs, sides).groupBy("_pair").count().collect()]
    assert max(met) <= 16


def test_cells_tell_the_sides_of_a_border(spark):
    rnd = random.Random(8)
    rings = []
    for x, y, r in [(3.0, -2.0, 6.0), (0.3, 0.1, 0.05), (-4.0, 5.0, 2.5)]:
        corners = [(x - r, y), (x, y - r), (x + r, y), (x, y + r), (x - r, y)]
        rings.append([(a + (c - a) * k / 100, b + (d - b) * k / 100)
                      for (a, b), (c, d) in zip(corners, corners[1:], strict=False) for k in range(100)] + corners[:1])
    rings.append([(x, None if k == 7 else y) for k, (x, y) in enumerate(rings[0])])
    regions = spark.createDataFrame([(f"r{k}", k, ring) for k, ring in enumerate(rings)],
                                    "region_id string, ordinal int, ring array<struct<x: double, y: double>>")
    points = [(k, rnd.uniform(-7, 10), rnd.uniform(-9, 9)) for k in range(700)]
    points += [(700 + k, *(c + rnd.choice([0, 1e-7, -1e-7, 1e-3]) for c in p)) for k, p in enumerate(rings[0] + rings[1])]
    frame = spark.createDataFrame(points, "id int, x double, y double")
    found = spatial.containing_regions(frame, regions, "id")
    want = frame.crossJoin(regions).where(shapes.contains(shapes.edges(F.col("ring")), F.col("x"), F.col("y")))
    expected = sorted((r.id, r.region_id) for r in want.collect())
    assert len(expected) > 300 and sorted((r.id, r.region_id) for r in found.collect()) == expected

    measured = spatial.measures(regions.where("ordinal < 3")).withColumnRenamed("edges", "_edges").withColumn("_ring", F.col("ordinal"))
    cells = spatial.large_ring_cells(measured).toPandas()
    known = cells[cells["_d"] < float("inf")]
    size = 2.0 ** cells["_level"]
    # What has to ask the sides is a small part of the plane that the cells cover.
    asks = (size * size * (2 * cells["_d"] / size).clip(0, 1)).groupby(cells["_ring"]).sum() / (size * size).groupby(cells["_ring"]).sum()
    assert asks.max() < 0.01 and set(known["_ring"]) == {0, 1, 2} and len(cells) < 3 * 400


def test_small_rings_answer_by_whole_cells(spark):
    rng = random.Random(3)
    rings = {str(k): (diamond if k % 2 else CONCAVE) for k, diamond in enumerate(
        [[(x - r, y), (x, y - r), (x + r, y), (x, y + r), (x - r, y)]
         for x, y, r in [(rng.uniform(-3, 6), rng.uniform(-3, 6), rng.uniform(0.5, 5)) for _ in range(20)]])}
    regions = spark.createDataFrame([(k, 0, v) for k, v in rings.items()], REGION)
    points = [(i, rng.uniform(-5, 8), rng.uniform(-5, 8)) for i in range(1500)] + [(1500 + i, float(i % 5), float(i // 5)) for i in range(25)]
    frame = spark.createDataFrame(points, "id LONG, x DOUBLE, y DOUBLE")
    pairs = frame.crossJoin(regions).where(shapes.contains(shapes.edges(F.col("ring")), F.col("x"), F.col("y")))
    expected = sorted((r.id, r.region_id) for r in pairs.collect())
    found = spatial.containing_regions(frame, regions, "id")
    assert sorted((r.id, r.region_id) for r in found.collect()) == expected
    boxes = regions.select("region_id", "ordinal", shapes.bounds(F.col("ring")).alias("b"), shapes.edges(F.col("ring")).alias("_edges"))
    cells = spatial.small_ring_cells(boxes.select("region_id", "ordinal", "b.*", "_edges"))
    assert cells.where("_edges IS NULL").count() > 0.3 * cells.count()


def test_first_region_and_parents_sort_no_pairs(spark):
    regions = spark.createDataFrame([("b", 2, square(0.0, 0.0, 4.0)), ("a", 2, square(0.0, 0.0, 9.0)), ("c", None, square(1.0, 1.0, 20.0)),
                                     ("d", 1, square(1.5, 1.5, 1.0))], REGION)
    points = spark.createDataFrame([(1, 2.0, 2.0), (2, 0.5, 0.5), (3, 50.0, 1.0), (4, 3.0, 3.0)], "id INT, x DOUBLE, y DOUBLE")
    first = spatial.first_region(points, regions, "id")
    assert {r.id: r.region_id for r in first.collect()} == {1: "c", 2: "a", 4: "c"}
    held = spatial.parents(regions)
    assert {r.child_id: r.parent_id for r in held.collect()} == {"b": "a", "d": "b"}
    for plan in (first, held):
        text = plan._jdf.queryExecution().toString()
        assert "SortAggregate" not in text and "ArrowEvalPython" not in text


def test_clipped_areas_are_the_strips(spark):
    rng = np.random.default_rng(5)

    def hull(n):
        at = np.sort(rng.uniform(0, 2 * math.pi, n))
        ring = np.column_stack([np.cos(at), np.sin(at)]) * rng.uniform(0.5, 3) + rng.uniform(-1, 1, 2)
        ring = ring if rng.random() < 0.5 else ring[::-1]
        return [tuple(map(float, p)) for p in (*ring, ring[0])]

    rings = [hull(int(rng.integers(3, 20))) for _ in range(300)] + [square(0.0, 0.0, 4.0), CONCAVE, square(4.0, 0.0, 4.0), square(0.0, 0.0, 4.0)]
    pairs = [(k, rings[k], rings[(7 * k + 3) % len(rings)]) for k in range(len(rings))] + [(900 + k, r, r) for k, r in enumerate(rings[-4:])]
    frame = spark.createDataFrame(pairs, "id INT, a ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>, b ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>")
    got = {r.id: r.area for r in frame.select("id", shapes.shared_area(F.col("a"), F.col("b")).alias("area")).collect()}
    for k, a, b in pairs:
        assert got[k] == pytest.approx(shapes.overlap_area(np.array(a), np.array(b)), abs=1e-9)
    one, two = (np.array([square(0.0, 0.0, 2.0)[:-1], [(0.0, 0.0), (2.0, 0.0), (0.0, 2.0), (0.0, 2.0)]]), np.array([square(1.0, 1.0, 4.0)[:-1]] * 2))
    assert shapes.clipped_areas(one, two, np.array([4, 4]), np.ones(2)) == pytest.approx([1.0, 0.0])


def test_lines_are_simplified_together():
    rng = np.random.default_rng(2)
    lines = [np.round(rng.uniform(0, 20, (n, 2)), 3) for n in (0, 1, 2, 3, 40, 0, 17)]
    ends = np.concatenate([[0], np.cumsum([len(x) for x in lines])])
    keep = shapes._simplify_all(np.concatenate(lines), ends, 3.0)
    for line, a, b in zip(lines, ends[:-1], ends[1:]):
        assert [tuple(p) for p in line[keep[a:b]]] == (recursive_simplify([tuple(p) for p in line], 3.0) if len(line) > 1 else [tuple(p) for p in line])
