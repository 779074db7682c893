"""GeoJSON features in and out, one feature per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.sources.documents import read_array, read_parts, write_document

FEATURE = ("id STRING, type STRING, bbox ARRAY<DOUBLE>, "
           "properties STRUCT<name: STRING, alternate_names: ARRAY<STRING>, "
           "centroid: ARRAY<DOUBLE>, parent: STRING, height: INT, himal: STRING>, "
           "geometry STRUCT<type: STRING, coordinates: {coordinates}>")


def region_features(regions: DataFrame) -> DataFrame:
    """Region rows to ``(id, json)`` polygon features; absent properties are left out.

    Wants ``region_id, name, alternate_names ARRAY, xmin, ymin, xmax, ymax, centroid_x,
    centroid_y, parent, ring``.
    """
    ring = F.transform("ring", lambda p: F.array(p["x"], p["y"]))
    feature = F.struct(
        F.col("region_id").alias("id"),
        F.lit("Feature").alias("type"),
        F.array("xmin", "ymin", "xmax", "ymax").alias("bbox"),
        F.struct(
            F.col("name"), F.col("alternate_names"),
            F.array(F.bround("centroid_x", 7), F.bround("centroid_y", 7)).alias("centroid"),
            F.col("parent"),
        ).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
        .alias("geometry"),
    )
    return regions.select(F.col("region_id").alias("id"), F.to_json(feature).alias("json"))


def point_features(points: DataFrame) -> DataFrame:
    """Golden rows to ``(id, json)`` point features; rows without coordinates are left out.

    ``himal`` is written even where it is null; ``alternate_names`` is not.
    """
    names = F.when(F.col("alt_names").isNotNull(), F.split("alt_names", ","))

    def feature(with_names: bool):
        properties = [F.col("peak_name").alias("name")]
        if with_names:
            properties.append(names.alias("alternate_names"))
        properties += [F.col("height").cast("int").alias("height"), F.col("himal")]
        return F.to_json(F.struct(
            F.col("peak_id").alias("id"), F.lit("Feature").alias("type"),
            F.struct(*properties).alias("properties"),
            F.struct(F.lit("Point").alias("type"),
                     F.array("longitude", "latitude").alias("coordinates")).alias("geometry"),
        ), {"ignoreNullFields": "false"})

    return (points.dropna(subset=["longitude", "latitude"])
            .select(F.col("peak_id").alias("id"),
                    F.when(F.col("alt_names").isNull(), feature(False))
                    .otherwise(feature(True)).alias("json")))


def write_features(features: DataFrame, path: str, mode: str = "error") -> str:
    """Write features sorted by id, one per line; the folder as a whole is in order."""
    features.orderBy("id").select(F.col("json").alias("value")).write.mode(mode).text(path)
    return path


def write_collection(features: DataFrame, path: str, bbox: DataFrame | None = None,
                     mode: str = "error") -> str:
    """Write the features and, beside them, the collection's own header with its bbox.

    The features stay one per line, so no single task ever holds the collection.
    """
    write_features(features, path + "/features", mode)
    if bbox is not None:
        header = F.to_json(F.struct(
            F.lit("FeatureCollection").alias("type"),
            F.array("xmin", "ymin", "xmax", "ymax").alias("bbox")))
        bbox.select(header.alias("value")).write.mode(mode).text(path + "/header")
    return path


def write_feature_collection(features: DataFrame, path: str, bbox: DataFrame | None = None, mode: str = "error") -> list[str]:
    """Write one FeatureCollection document in parts, features in the order of their ids, which must differ.

    Returns the parts' paths; joined in this order they are the document. No task holds all of it.
    """
    header = {"type": F.lit("FeatureCollection")}
    if bbox is not None:
        header["bbox"] = F.array("xmin", "ymin", "xmax", "ymax")
    return write_document(features, path, header, facts=bbox, mode=mode)


def read_region_features(spark: SparkSession, path: str, collection: bool = False, parts: bool = False) -> DataFrame:
    """Polygon features to ``(region_id, name, parent, ordinal, ring)``; only the outer ring.

    ``collection=True`` reads FeatureCollection documents instead of one feature per line, and
    ``parts=True`` one such document in parts, as ``write_feature_collection`` leaves it.
    ``ordinal`` rises in the collection's order; features on lines rank by id, the order in which
    they are written.
    """
    schema = FEATURE.format(coordinates="ARRAY<ARRAY<ARRAY<DOUBLE>>>")
    if parts:
        rows = (read_parts(spark, path).select(F.from_json("value", schema).alias("f"))
                .select(F.col("f.id").alias("ordinal"), "f.*"))
    elif collection:
        rows = (read_array(spark, path).select("ordinal", F.from_json("value", schema).alias("f"))
                .select(F.format_string("%018d", "ordinal").alias("ordinal"), "f.*"))
    else:
        rows = spark.read.schema(schema).json(path).withColumn("ordinal", F.col("id"))
    ring = F.transform(F.try_element_at("geometry.coordinates", F.lit(1)),
                       lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    return rows.select(F.col("id").alias("region_id"), F.col("properties.name").alias("name"),
                       F.col("properties.parent").alias("parent"), "ordinal",
                       ring.alias("ring"))


def read_point_features(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(FEATURE.format(coordinates="ARRAY<DOUBLE>")).json(path)
    return rows.select(
        F.col("id").alias("peak_id"), F.col("properties.name").alias("peak_name"),
        F.array_join("properties.alternate_names", ",").alias("alt_names"),
        F.col("properties.height").alias("height"), F.col("properties.himal").alias("himal"),
        F.col("geometry.coordinates")[0].alias("longitude"),
        F.col("geometry.coordinates")[1].alias("latitude"))
