"""Large JSON documents read in byte ranges and written in parts, against the standard library."""

import json
import random

import pytest
from pyspark.sql import functions as F

from cairn.sources import documents, elements, geojson


@pytest.fixture
def small_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "3k", "spark.sql.files.openCostInBytes": "0",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def value(rnd, depth=0):
    kind = rnd.randint(0, 7 if depth < 3 else 4)
    if kind < 3:
        return "".join(rnd.choice(['"', "\\", "{", "}", "[", "]", ",", ":", "é", "\n", "a", " "]) for _ in range(rnd.choice([0, 3, 9, 40])))
    if kind < 5:
        return rnd.choice([1, -2.5, None, True])
    if kind < 7:
        return {f"k{j}": value(rnd, depth + 1) for j in range(rnd.randint(0, 3))}
    return [value(rnd, depth + 1) for _ in range(rnd.randint(0, 3))]


def document(rnd, n, **other):
    items = [{"id": k, "v": value(rnd), "w": {"x": value(rnd)}} for k in range(n)]
    return {**other, "elements": items, "after": {"b": {"c": [1, 2]}}}, items


@pytest.mark.parametrize("indent", [None, 2])
def test_elements_equal_the_standard_library(spark, tmp_path, small_ranges, indent):
    rnd = random.Random(indent or 0)
    want, folder = [], tmp_path / "d"
    folder.mkdir()
    for k, n in enumerate((300, 0, 1, 120)):
        whole, items = document(rnd, n, version=0.6, osm3s={"base": {"at": 'x}{"', "deep": {"er": {}}}}, bbox=[1, [2], 3])
        (folder / f"{k}.json").write_text(json.dumps(whole, indent=indent, ensure_ascii=bool(k % 2)))
        want += [(k, i, x) for i, x in enumerate(items)]
    rows = documents.read_array(spark, str(folder)).collect()
    assert sorted(json.dumps(json.loads(r["value"])) for r in rows) == sorted(json.dumps(x) for _, _, x in want)
    for k in (0, 3):
        one = documents.read_array(spark, str(folder / f"{k}.json"))
        assert k or one.rdd.getNumPartitions() > 8
        ordered = [json.loads(r["value"]) for r in one.orderBy("ordinal").collect()]
        assert ordered == [x for f, _, x in want if f == k]
        assert one.select("ordinal").distinct().count() == len(ordered)


def test_an_element_longer_than_many_ranges(spark, tmp_path, small_ranges):
    long = {"id": 1, "text": '}, {"x": [' * 3000, "parts": [{"k": j} for j in range(2000)]}
    (tmp_path / "x.json").write_text(json.dumps({"elements": [{"id": 0}, long, {"id": 2}]}))
    rows = documents.read_array(spark, str(tmp_path / "x.json")).orderBy("ordinal").collect()
    assert [json.loads(r["value"]) for r in rows] == [{"id": 0}, long, {"id": 2}]


def test_a_document_in_parts_is_one_document(spark, tmp_path, small_ranges):
    rnd = random.Random(4)
    items = {f"f{k:05d}": {"id": f"f{k:05d}", "v": value(rnd)} for k in range(900)}
    frame = spark.createDataFrame([(k, json.dumps(x)) for k, x in items.items()], "id string, json string").repartition(7)
    path = str(tmp_path / "parts")
    facts = spark.createDataFrame([(1.5, "a{b")], "low double, name string")
    files = documents.write_document(frame, path, {"bbox": F.array("low", "low"), "name": F.col("name")}, facts=facts)
    assert len(files) > 3
    whole = json.loads("".join(open(f.removeprefix("file:"), encoding="utf-8").read() for f in files))
    assert whole == {"bbox": [1.5, 1.5], "name": "a{b", "features": [items[k] for k in sorted(items)]}
    back = documents.read_parts(spark, path)
    assert back.rdd.getNumPartitions() > 8
    assert sorted((json.loads(r["value"]) for r in back.collect()), key=lambda x: x["id"]) == whole["features"]
    (tmp_path / "whole.json").write_text(json.dumps(whole))
    again = documents.read_array(spark, str(tmp_path / "whole.json")).orderBy("ordinal").collect()
    assert [json.loads(r["value"]) for r in again] == whole["features"]
    one = documents.write_document(frame, str(tmp_path / "one"), one_file=True)
    assert len(one) == 1 and json.loads(open(one[0].removeprefix("file:"), encoding="utf-8").read())["features"] == whole["features"]
    empty = documents.write_document(frame.where("false"), str(tmp_path / "none"))
    assert json.loads("".join(open(f.removeprefix("file:")).read() for f in empty)) == {"features": []}
    assert documents.read_parts(spark, str(tmp_path / "none")).collect() == []


def test_element_documents_read_alike(spark, tmp_path, small_ranges):
    rnd = random.Random(7)
    items = [{"type": "node", "id": k % 90, "lon": rnd.random(), "lat": 1.0, "tags": {"name": 'a "}" b'}} for k in range(200)]
    (tmp_path / "e.json").write_text(json.dumps({"version": 0.6, "elements": items}))
    one = elements.read_elements(spark, str(tmp_path / "e.json")).orderBy("ordinal").drop("ordinal").collect()
    many = elements.read_element_ranges(spark, str(tmp_path / "e.json")).orderBy("ordinal").drop("ordinal").collect()
    assert one == many and len(many) == 200


def test_feature_collections_read_alike(spark, tmp_path):
    rows = [(f"r{k}", json.dumps({"id": f"r{k}", "type": "Feature", "properties": {"name": f"n{k}"}, "geometry": {
        "type": "Polygon", "coordinates": [[[0, 0], [1, k], [2, 2], [0, 0]]]}})) for k in range(30)]
    features = spark.createDataFrame(rows, "id string, json string")
    box = spark.createDataFrame([(0.0, 0.0, 2.0, 29.0)], "xmin double, ymin double, xmax double, ymax double")
    files = geojson.write_feature_collection(features, str(tmp_path / "c"), box)
    whole = tmp_path / "whole.json"
    whole.write_text("".join(open(f.removeprefix("file:")).read() for f in files))
    assert json.loads(whole.read_text())["bbox"] == [0, 0, 2, 29]
    one = geojson.read_region_features(spark, str(whole), collection=True)
    parts = geojson.read_region_features(spark, str(tmp_path / "c"), parts=True)
    assert [r.region_id for r in parts.orderBy("ordinal").collect()] == sorted(r[0] for r in rows)
    assert one.drop("ordinal").exceptAll(parts.drop("ordinal")).isEmpty() and one.count() == parts.count() == 30


@pytest.mark.parametrize("piece, inside, end", [
    ('{"a":1', False, (False, 0)), ('"x', False, (True, 0)), ('x"', True, (False, -1)), ('x\\"', True, (True, 0)),
    ('"{[" , [', False, (False, 0)), ("]", False, (False, -2)), ("", True, (True, 0)), ('a" : {"b": "c', True, (True, 1))])
def test_piece_end(piece, inside, end):
    assert documents.piece_end(piece, inside) == end
