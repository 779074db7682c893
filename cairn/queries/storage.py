"""Files out and back in: delimited text, typed tables, elements and GeoJSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.operators import spatial
from cairn.plans import gazetteer
from cairn.queries import query
from cairn.queries.geo import (_BOXES, _boxes, _relation_elements, RECTANGLES_SQL)
from cairn.session import scratch_folder
from cairn.sources import delimited, documents, elements, geojson, tables


@query("dsv_roundtrip", """
    SELECT doc_id::VARCHAR AS doc_id, text, lang, source, n_chars::VARCHAR AS n_chars
    FROM documents""")
def dsv_roundtrip(t):
    docs = t("documents")
    path, _ = delimited.write_delimited(docs, scratch_folder(docs.sparkSession, "documents"))
    return delimited.read_delimited(docs.sparkSession, path)


@query("dsv_ranges", """
    SELECT doc_id::VARCHAR AS doc_id, text, n_chars::VARCHAR AS n_chars FROM documents""")
def dsv_ranges(t):
    # Files with line breaks in their fields, one for each task that writes, cut in byte ranges.
    docs = t("documents")
    path, _ = delimited.write_delimited(docs, scratch_folder(docs.sparkSession, "range-files"))
    return delimited.read_ranges(docs.sparkSession, path, columns=["doc_id", "text", "n_chars"])


@query("dsv_lone_column", """
    SELECT nullif(CASE WHEN p_type = 'SMALL' THEN '' WHEN p_type <> 'PROMO' THEN p_name END, '') AS name FROM part""")
def dsv_lone_column(t):
    lone = t("part").select(F.when(F.col("p_type") == "SMALL", "").when(
        F.col("p_type") != "PROMO", F.col("p_name")).alias("name"))
    path, _ = delimited.write_delimited(lone, scratch_folder(lone.sparkSession, "lone"))
    return delimited.read_delimited(lone.sparkSession, path)


@query("dsv_columns_by_name", "SELECT s_name, s_suppkey::VARCHAR AS s_suppkey FROM supplier")
def dsv_columns_by_name(t):
    path, _ = delimited.write_delimited(t("supplier"), scratch_folder(t("supplier").sparkSession, "supplier"))
    return delimited.read_delimited(t("supplier").sparkSession, path, columns=["s_name", "s_suppkey"])


@query("catalogue_rejects", """
    SELECT p_partkey::VARCHAR AS p_partkey, 'p_retailprice=n/a' AS bad FROM part WHERE p_type = 'PROMO'""")
def catalogue_rejects(t):
    raw = _untyped(t)
    spark = raw.sparkSession
    path, _ = delimited.write_delimited(raw, scratch_folder(spark, "part-text"))
    tables.load_catalogue(spark, {"part_list": path}, scratch_folder(spark, "catalogue"),
                          {"part_list": tables.layout(_PART)})
    return spark.table("rejects_part_list").select("p_partkey", F.array_join("bad_fields", ";").alias("bad"))


@query("dsv_rows_written", """
    SELECT count(*) AS written FROM pages""")
def dsv_rows_written(t):
    pages = t("pages")
    path, n = delimited.write_delimited(pages, scratch_folder(pages.sparkSession, "pages"))
    back = delimited.read_delimited(pages.sparkSession, path)
    return back.agg(F.count(F.lit(1)).alias("written")).where(F.col("written") == n)


# Text in another column order and case, with empty fields and values of the wrong type.
def _untyped(t):
    return t("part").select(
        F.col("p_size").cast("string").alias("P_SIZE"),
        F.when(F.col("p_type") == "PROMO", "n/a").otherwise(F.col("p_retailprice").cast("string"))
        .alias("P_RetailPrice"),
        F.when(F.col("p_type") == "SMALL", "").otherwise(F.col("p_name")).alias("P_NAME"),
        F.col("p_partkey").cast("string").alias("P_PARTKEY"))


_PART = "p_partkey BIGINT, p_name STRING, p_size INT, p_retailprice DOUBLE, p_note STRING"


@query("typed_load", """
    SELECT p_partkey, nullif(CASE WHEN p_type = 'SMALL' THEN '' ELSE p_name END, '') AS p_name,
           p_size, CASE WHEN p_type <> 'PROMO' THEN p_retailprice END AS p_retailprice,
           CAST(NULL AS VARCHAR) AS p_note FROM part""")
def typed_load(t):
    raw = _untyped(t)
    spark = raw.sparkSession
    text_path, _ = delimited.write_delimited(raw, scratch_folder(spark, "part-text"))
    out, _, _ = tables.load_table(spark, text_path, tables.layout(_PART),
                                  scratch_folder(spark, "part"))
    return spark.read.parquet(out)


@query("typed_load_rejects", """
    SELECT p_partkey::VARCHAR AS p_partkey, 'p_retailprice=n/a' AS bad FROM part
    WHERE p_type = 'PROMO'""")
def typed_load_rejects(t):
    raw = _untyped(t)
    path, _ = delimited.write_delimited(raw, scratch_folder(raw.sparkSession, "part-text"))
    _, rejects = delimited.type_columns(
        delimited.read_delimited(raw.sparkSession, path), tables.layout(_PART))
    return rejects.select("p_partkey", F.array_join("bad_fields", ";").alias("bad"))


@query("catalogue_load", """
    SELECT 'customer' AS name, count(*) AS rows FROM customer
    UNION ALL SELECT 'nation', count(*) FROM nation
    UNION ALL SELECT 'supplier', count(*) FROM supplier""")
def catalogue_load(t):
    names = ["customer", "nation", "supplier"]
    frames = {n: t(n) for n in names}
    spark = frames["nation"].sparkSession
    texts = {n: delimited.write_delimited(df, scratch_folder(spark, n))[0]
             for n, df in frames.items()}
    out = scratch_folder(spark, "catalogue")
    schemas = {n: df.schema for n, df in frames.items()}
    tables.create_empty(spark, out, schemas)
    tables.load_catalogue(spark, texts, out, schemas, multiline=False)
    counts = [spark.table(n).agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("rows"))
              for n in names]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("flags_export", """
    SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INT) AS finished,
           CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_totalprice > 100000 AS INT) END AS dear
    FROM orders""")
def flags_export(t):
    return delimited.flags_as_int(t("orders").select(
        F.col("o_orderkey").alias("O_ORDERKEY"), (F.col("o_orderstatus") == "F").alias("Finished"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice") > 100000)
        .alias("DEAR")))


@query("materialise_once", "SELECT s_suppkey, s_name FROM supplier")
def materialise_once(t):
    first = t("supplier").select("s_suppkey", "s_name")
    path = scratch_folder(first.sparkSession, "supplier")
    tables.materialise(first, path)
    return tables.materialise(first.withColumn("s_name", F.lit("written again")), path)


@query("elements_read", """
    WITH c AS (SELECT c_custkey * 10 AS k, c_name, c_mktsegment, c_acctbal / 40 AS x,
                      c_nationkey * 5.0::DOUBLE AS y, 1 + c_nationkey / 10 AS w,
                      2 + abs(c_acctbal) / 3000 AS h FROM customer)
    SELECT 'node' AS type, k + i AS id, round(x + w * dx, 6) AS lon, round(y + h * dy, 6) AS lat,
           NULL::VARCHAR AS name, NULL::INT AS nodes
    FROM c, (VALUES (0, 0, 0), (1, 1, 0), (2, 1, 1), (3, 0, 1), (4, 2, 2)) v(i, dx, dy)
    UNION ALL SELECT 'way', k + i, NULL, NULL, NULL, n
    FROM c, (VALUES (5, 2), (6, 3), (7, 2), (8, 3)) v(i, n)
    UNION ALL SELECT 'way', k + 9, NULL, NULL, NULL, 2 FROM c WHERE c_mktsegment = 'FURNITURE'
    UNION ALL SELECT 'relation', k + 9, NULL, NULL,
        translate(c_name, '0123456789#', 'ABCDEFGHIJ') || ' Himal', NULL FROM c""")
def elements_read(t):
    # Lines without a position of their own.
    rows = _relation_elements(t).drop("ordinal")
    spark = rows.sparkSession
    path = scratch_folder(spark, "elements")
    rows.write.json(path)
    back = elements.read_element_lines(spark, path)
    return back.select("type", "id", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"),
                       elements.tag("name").alias("name"),
                       F.when(F.col("nodes").isNotNull(), F.size("nodes")).alias("nodes"))


@query("elements_document_read", """
    SELECT c_custkey AS doc, count(*) AS n FROM customer, range(2) GROUP BY 1""")
def elements_document_read(t):
    # One document of two elements per customer.
    docs = t("customer").select(F.to_json(F.struct(F.array(
        F.struct(F.lit("node").alias("type"), F.col("c_custkey").alias("id"),
                 F.col("c_acctbal").alias("lon"), F.lit(1.5).alias("lat")),
        F.struct(F.lit("node").alias("type"), F.col("c_custkey").alias("id"),
                 F.lit(2.5).alias("lon"), F.lit(1.5).alias("lat"))).alias("elements")))
        .alias("value"))
    spark = docs.sparkSession
    path = scratch_folder(spark, "documents-json")
    docs.write.text(path)
    back = elements.explode_documents(
        spark.read.schema(elements.DOCUMENT).json(path))
    return back.groupBy(F.col("id").alias("doc")).agg(F.count(F.lit(1)).alias("n"))


@query("geojson_points", """
    SELECT c_custkey::VARCHAR AS peak_id, c_name AS peak_name, CAST(c_nationkey AS INT) AS height,
           CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS himal,
           CASE WHEN c_nationkey > 12 THEN c_mktsegment || ',' || c_name END AS alt_names,
           c_acctbal AS longitude, 1.5::DOUBLE AS latitude
    FROM customer WHERE c_acctbal >= 0""")
def geojson_points(t):
    points = t("customer").select(
        F.col("c_custkey").cast("string").alias("peak_id"), F.col("c_name").alias("peak_name"),
        F.when(F.col("c_nationkey") > 12, F.concat_ws(",", "c_mktsegment", "c_name"))
        .alias("alt_names"), F.col("c_nationkey").alias("height"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("himal"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("longitude"),
        F.lit(1.5).alias("latitude"))
    spark = points.sparkSession
    path = geojson.write_features(geojson.point_features(points), scratch_folder(spark, "points"))
    return geojson.read_point_features(spark, path)


@query("geojson_regions", f"""
    SELECT region_id, 5 AS points, region_id AS name, round(w * h, 6) AS area FROM
        (SELECT id AS region_id, w, h FROM {_BOXES})""")
def geojson_regions(t):
    table = spatial.measures(_boxes(t)).select(
        "region_id", F.col("region_id").alias("name"), F.lit(None).cast("array<string>")
        .alias("alternate_names"), "xmin", "ymin", "xmax", "ymax", "centroid_x", "centroid_y",
        F.lit(None).cast("string").alias("parent"), "ring")
    spark = table.sparkSession
    path = geojson.write_collection(geojson.region_features(table), scratch_folder(spark, "regions"),
                                    spatial.overall_bounds(table))
    back = geojson.read_region_features(spark, path + "/features")
    return spatial.measures(back).select("region_id", F.size("ring").alias("points"), "name",
                                         F.round("area", 6).alias("area"))


@query("geojson_document", f"""
    SELECT id AS region_id, id AS name, round(w * h, 6) AS area FROM {_BOXES}""")
def geojson_document(t):
    # One collection, written in parts and read back as the one document that they are.
    measured = spatial.measures(_boxes(t))
    table = measured.select(
        "region_id", F.col("region_id").alias("name"), F.lit(None).cast("array<string>")
        .alias("alternate_names"), "xmin", "ymin", "xmax", "ymax", "centroid_x", "centroid_y",
        F.lit(None).cast("string").alias("parent"), "ring")
    spark = table.sparkSession
    path = scratch_folder(spark, "collection")
    geojson.write_feature_collection(geojson.region_features(table), path, spatial.overall_bounds(table))
    back = spatial.measures(geojson.read_region_features(spark, path, parts=True))
    return back.select("region_id", "name", F.round("area", 6).alias("area"))


@query("elements_ranges", """
    SELECT c_custkey AS id, c_acctbal AS lon, count(*) AS n FROM customer, range(2) GROUP BY 1, 2""")
def elements_ranges(t):
    # One document of two elements per customer.
    pairs = t("customer").select(F.explode(F.array(*(F.struct(
        F.concat("c_custkey", F.lit(f".{k}")).alias("id"), F.to_json(F.struct(
            F.lit("node").alias("type"), F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("lon"), F.lit(1.5).alias("lat"),
            F.create_map(F.lit("name"), F.concat(F.lit('}{" '), "c_name")).alias("tags"))).alias("json")) for k in (1, 2)))).alias("e"))
    spark = pairs.sparkSession
    path = scratch_folder(spark, "elements-json")
    documents.write_document(pairs.select("e.*"), path, {"version": F.lit(0.6)}, array="elements", one_file=True)
    back = elements.read_element_ranges(spark, path)
    return back.groupBy("id", "lon").agg(F.count(F.lit(1)).alias("n"))


@query("region_table_text", f"""
    WITH r AS (SELECT *, upper(region_id) || ' Himal' AS himal_name FROM {RECTANGLES_SQL}
               WHERE c_mktsegment <> 'BUILDING')
    SELECT region_id AS himal_id, regexp_replace(himal_name, '^CUSTOMER', 'Customer') AS himal_name,
           NULL::VARCHAR AS alternate_names, round_even(x + w / 2, 7) AS longitude,
           round_even(y + h / 2, 7) AS latitude FROM r""")
def region_table_text(t):
    regions, _ = gazetteer.region_shapes(_relation_elements(t), tolerance=None)
    rows = gazetteer.region_rows(gazetteer.region_table(regions))
    spark = rows.sparkSession
    path, _ = delimited.write_delimited(rows, scratch_folder(spark, "regions-text"))
    back = delimited.read_delimited(spark, path)
    return back.select("himal_id", "himal_name", "alternate_names",
                       *(F.col(c).cast("double").alias(c) for c in ("longitude", "latitude")))
