"""Map elements: nodes, ways and relations in one nested JSON document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.sources.documents import read_array

ELEMENT = ("type STRING, id BIGINT, lon DOUBLE, lat DOUBLE, tags MAP<STRING, STRING>, "
           "nodes ARRAY<BIGINT>, members ARRAY<STRUCT<type: STRING, ref: BIGINT, role: STRING>>")


DOCUMENT = f"elements ARRAY<STRUCT<{ELEMENT}>>"


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    """Read documents of the form ``{"elements": [...]}``, one row per element."""
    return explode_documents(
        spark.read.schema(DOCUMENT).option("multiLine", True).json(path))


def read_element_ranges(spark: SparkSession, path: str) -> DataFrame:
    """``read_elements`` for documents too large for one task: each is read in byte ranges.

    ``ordinal`` rises in a document's order but has gaps.
    """
    found = read_array(spark, path)
    return found.select("ordinal", F.from_json("value", ELEMENT).alias("e")).select("ordinal", "e.*")


def explode_documents(documents: DataFrame) -> DataFrame:
    """``ordinal`` is the position within the document, which decides between repeated ids."""
    return (documents.select(F.posexplode("elements").alias("ordinal", "e"))
            .select("ordinal", "e.*"))


def read_element_lines(spark: SparkSession, path: str) -> DataFrame:
    """Read one element per line: the splittable form for large extracts.

    Lines may carry their position as ``ordinal``. One without gets its place in the file: the
    block it was read from, then its number within the task.
    """
    block = F.shiftright("_metadata.file_block_start", 20)
    place = F.shiftleft(block, 33) + F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return (spark.read.schema(ELEMENT + ", ordinal BIGINT").json(path)
            .select(F.coalesce("ordinal", place).alias("ordinal"), "type", "id", "lon", "lat", "tags",
                    "nodes", "members"))


def of_type(elements: DataFrame, kind: str) -> DataFrame:
    return elements.where(F.col("type") == kind)


def tag(name: str, tags: str = "tags") -> Column:
    return F.try_element_at(F.col(tags), F.lit(name))


def has_tag(name: str, tags: str = "tags") -> Column:
    return tag(name, tags).isNotNull()


def tag_is(name: str, value: str, tags: str = "tags") -> Column:
    return tag(name, tags) == value


def tag_matches(name: str, pattern: str, tags: str = "tags") -> Column:
    """Case-insensitive match anywhere in the tag's value."""
    return tag(name, tags).rlike("(?i)" + pattern)


def in_window(south: float, west: float, north: float, east: float,
              lon: str = "lon", lat: str = "lat") -> Column:
    return F.col(lat).between(south, north) & F.col(lon).between(west, east)
