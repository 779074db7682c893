"""Peaks and regions from map elements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn import fixed
from cairn.functions import shapes, text
from cairn.functions.values import dms, half_even
from cairn.operators import quality, spatial
from cairn.session import staged
from cairn.sources import elements as el


def accepted_names(tags: Column, keys: list[str] = fixed.NAME_TAGS) -> Column:
    """Distinct clean names of the accepted tags, in the order the tags have.

    Names with other than ASCII characters, digits alone and blanks are left out.
    """
    values = F.transform(
        F.filter(F.map_entries(tags), lambda e: e["key"].isin(keys)), lambda e: e["value"])
    parts = F.transform(F.flatten(F.transform(values, lambda v: text.split_any(v))),
                        lambda p: text.strip(p))
    usable = F.filter(parts, lambda p: (p != "") & text.is_ascii(p) & ~text.is_digits(p))
    return F.array_distinct(F.transform(usable, lambda p: text.title_case(p)))


def named_points(nodes: DataFrame) -> DataFrame:
    """Elements with a usable name as peaks: the first name is the main one."""
    return (nodes.select("id", "lon", "lat", accepted_names(F.col("tags")).alias("_names"))
            .where(F.size("_names") > 0)
            .select(F.col("id").alias("peak_id"), F.col("_names")[0].alias("peak_name"),
                    F.array_join(F.array_sort(F.slice("_names", F.lit(2),
                                                      F.greatest(F.size("_names") - 1, F.lit(0)))),
                                 ",").alias("alternate_names"),
                    F.col("lon").alias("longitude"), F.col("lat").alias("latitude"),
                    dms(F.col("lon"), True).alias("dms_longitude"),
                    dms(F.col("lat"), False).alias("dms_latitude")))


def peak_elements(elements: DataFrame, window: dict = fixed.MAP_WINDOW) -> DataFrame:
    """Named peaks within the map window."""
    return el.of_type(elements, "node").where(
        el.tag_is(*fixed.PEAK_TAG) & el.has_tag("name") & el.in_window(**window))


def region_elements(elements: DataFrame) -> DataFrame:
    """Relations that describe a mountain area by tag and name."""
    return el.of_type(elements, "relation").where(
        el.tag_is(*fixed.REGION_TAG) & el.tag_matches("name", fixed.REGION_NAME_MATCHES)
        & ~el.tag_matches("name", fixed.REGION_NAME_EXCLUDES))


def region_shapes(elements: DataFrame, tolerance: float | None = fixed.SIMPLIFY_TOLERANCE
                  ) -> tuple[DataFrame, DataFrame]:
    """Regions ``region_id, name, alternate_names, ordinal, ring`` from elements, and rejects.

    Of several regions with one id the last wins. Rejects list relations that do not form
    exactly one ring, have no outer way or no name, or whose ways or nodes are missing.
    """
    def unique(kind: str) -> DataFrame:
        return quality.last_wins(
            el.of_type(elements, kind).select("ordinal", "id", "lon", "lat", "tags", "nodes",
                                              "members"), ["id"], "ordinal")

    nodes = unique("node").select(F.col("id").alias("node_id"), F.col("lon").alias("x"),
                                  F.col("lat").alias("y"))
    ways = unique("way").select(F.col("id").alias("way_id"), "nodes")
    relations = el.of_type(elements, "relation")

    lines = spatial.assemble_lines(ways, nodes)
    complete = lines.where((F.col("missing") == 0) & (F.size("line") > 1)).drop("missing")
    if tolerance is not None:
        complete = complete.withColumn("line", shapes.simplify(F.col("line"), tolerance))
    # The check for broken relations, the walk and the rings all read the lines.
    complete = staged(complete, "lines")
    members = spatial.outer_members(relations)
    broken = (members.join(complete, "way_id", "left_anti").select("relation_id").distinct()
              .withColumn("reason", F.lit("an outer way is missing or incomplete")))
    rings, uneven = spatial.assemble_rings(
        members.join(broken, "relation_id", "left_anti"), complete)
    named = relations.select(
        F.col("id").alias("relation_id"), "ordinal", el.tag("name").alias("name"),
        F.when(el.has_tag("alt_name"), F.array(el.tag("alt_name"))).alias("alternate_names"))
    lone = (named.select("relation_id").distinct().join(members, "relation_id", "left_anti")
            .withColumn("reason", F.lit("has no outer way")))
    nameless = (named.where("name IS NULL").select("relation_id").distinct()
                .join(rings.select("relation_id"), "relation_id", "left_semi")
                .withColumn("reason", F.lit("has no name")))
    rejects = broken.unionByName(uneven.select(
        "relation_id", F.format_string("forms %d rings, not 1", "rings").alias("reason")))
    rejects = rejects.unionByName(lone).unionByName(nameless)
    regions = (named.where("name IS NOT NULL").join(rings, "relation_id")
               .withColumn("region_id", text.slug(F.col("name"))).drop("relation_id"))
    return quality.last_wins(regions, ["region_id"], "ordinal"), rejects


def region_table(regions: DataFrame, overlap: float = fixed.PARENT_OVERLAP) -> DataFrame:
    """Regions with measures and their parent region; a ring too short to measure has neither."""
    regions = staged(regions, "regions")
    parents = spatial.parents(regions, overlap).select(
        F.col("child_id").alias("region_id"), F.col("parent_id").alias("parent"))
    measured = spatial.measures(regions).drop("edges").unionByName(
        regions.where(F.coalesce(F.size("ring") <= 2, F.lit(True))), allowMissingColumns=True)
    return measured.join(parents, "region_id", "left")


def region_rows(table: DataFrame) -> DataFrame:
    """Regions flattened for delimited text: names comma-packed, centroids also as DMS text."""
    lon, lat = (half_even(F.col(c), 7) for c in ("centroid_x", "centroid_y"))
    return table.select(
        F.col("region_id").alias("himal_id"), F.col("name").alias("himal_name"),
        F.coalesce(F.array_join("alternate_names", ","), F.lit("")).alias("alternate_names"),
        lon.alias("longitude"), lat.alias("latitude"), dms(lon, True).alias("dms_longitude"),
        dms(lat, False).alias("dms_latitude"), F.col("parent").alias("parent_himal_id"))
