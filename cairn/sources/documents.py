"""One large JSON document of the form ``{..., "features": [{...}, ...]}``, written and read by many tasks.

A document is read in byte ranges, in pieces that end with a closing brace. Whether a range begins inside
a text and how deep it begins depend on all that stands before it: each range maps a start outside and
one inside a text to its end and its change of depth, and these maps compose over one small row for each
range. With its start known a range is cut into elements, the objects of an array right below the
document; the pieces of an element that reaches over ranges meet by a shuffle of just these pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

_RANGE = "file string, start bigint"
_MAPS = (f"{_RANGE}, bytes bigint, outside_ends boolean, outside_deeper bigint, inside_ends boolean, inside_deeper bigint")
_PIECES = f"{_RANGE}, kind string, place bigint, value string"
OPENS, RUNS, CLOSES, WHOLE = "opens", "runs", "closes", "whole"

#: Depth of the array's elements: the document is 1, its array 2.
ELEMENT = 3
_TEXT = re.compile(r'"(?:[^"\\]++|\\.)*+"', re.DOTALL)
_REST = re.compile(r'(?:[^"\\]++|\\.)*+"', re.DOTALL)
_NESTING = re.compile(r"[{}\[\]]")


def _bare(piece: str, inside: bool) -> tuple[str, bool]:
    """The piece with blanks in place of its texts, and whether its end lies inside one."""
    head = ""
    if inside:
        end = _REST.match(piece)
        if end is None:
            return " " * len(piece), True
        head, piece = " " * end.end(), piece[end.end():]
    if '"' in piece:
        piece = _TEXT.sub(lambda m: " " * len(m[0]), piece)
        at = piece.find('"')
        if at >= 0:
            return head + piece[:at] + " " * (len(piece) - at), True
    return head + piece, False


def _deeper(bare: str) -> int:
    return bare.count("{") + bare.count("[") - bare.count("]")


def piece_end(piece: str, inside: bool) -> tuple[bool, int]:
    """Of a piece and the closing brace behind it: whether it ends inside a text, and the change of depth."""
    bare, ends = _bare(piece, inside)
    return ends, _deeper(bare) - (not ends)


def element_start(bare: str, depth: int) -> int | None:
    """Where an element begins in a piece that begins at a depth; its brace stands behind ``[`` or a comma."""
    for found in _NESTING.finditer(bare):
        if found[0] in "{[":
            if found[0] == "{" and depth == ELEMENT - 1 and bare[:found.start()].rstrip()[-1:] in ("", "[", ","):
                return found.start()
            depth += 1
        else:
            depth -= 1
    return None


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """``(file, start, value)``: the text before each closing brace, with the byte range that it begins in."""
    return spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], str]]:
    for batch in batches:
        for file, start, value in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            yield (file, start), value


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _map_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ends: dict[tuple[str, int], list] = {}
    for place, piece in _rows(batches):
        size, outside, out_deep, inside, in_deep = ends.get(place, (0, False, 0, True, 0))
        same = outside == inside
        outside, change = piece_end(piece, outside)
        inside, other = (outside, change) if same else piece_end(piece, inside)
        ends[place] = [size + len(piece.encode()) + 1, outside, out_deep + change, inside, in_deep + other]
    yield _batch([(*place, *found) for place, found in ends.items()],
                 [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64()],
                 ["file", "start", "bytes", "outside_ends", "outside_deeper", "inside_ends", "inside_deeper"])


def range_starts(pieces: DataFrame) -> DataFrame:
    """``(file, start, base, inside, depth)``: how each byte range begins, and the bytes before it.

    One row for each range.
    """
    maps = pieces.mapInArrow(_map_ranges, _MAPS)
    order = Window.partitionBy("file").orderBy("start")  # a row for each range of a document
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    alike, swaps = F.col("outside_ends") == F.col("inside_ends"), F.col("outside_ends") & ~F.col("inside_ends")
    counted = maps.withColumn("swaps", F.sum(swaps.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    settled = F.when(alike, F.struct(F.col("outside_ends").alias("state"), "swaps"))
    known = counted.select("*", F.last(settled, ignorenulls=True).over(before).alias("last"), F.last("swaps").over(before).alias("so_far"))
    odd = (F.coalesce("so_far", F.lit(0)) - F.coalesce("last.swaps", F.lit(0))) % 2 == 1
    begun = known.withColumn("inside", F.coalesce(F.col("last.state"), F.lit(False)) != odd)
    change = F.when(F.col("inside"), F.col("inside_deeper")).otherwise(F.col("outside_deeper"))
    zero = F.lit(0).cast("bigint")
    return begun.select("file", "start", F.coalesce(F.sum("bytes").over(before), zero).alias("base"), "inside",
                        F.coalesce(F.sum(change).over(before), zero).alias("depth"))


def _cut(starts: dict[tuple[str, int], Row], whole: bool):
    """The elements that lie in one range, or the pieces of those that reach over ranges."""
    kinds, names = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()], ["file", "start", "kind", "place", "value"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, inside, depth, base, number = None, False, 0, 0, 0
        held: list[str] | None = None  # of the element that is open
        head, out = False, []

        def end_of_range() -> None:
            if held is not None and not whole:
                out.append((*place, RUNS if head else OPENS, base + number, "".join(held)))

        for now, piece in _rows(batches):
            if now != place:
                if place is not None:
                    end_of_range()
                begin = starts[now]
                place, inside, depth, base, number = now, begin["inside"], begin["depth"], begin["base"], 0
                head = depth >= ELEMENT
                held = [] if head else None
            bare, ends = _bare(piece, inside)
            if held is None:
                at = element_start(bare, depth)
                if at is not None:
                    held, piece = [], piece[at:]
            depth += _deeper(bare) - (not ends)
            inside = ends
            if held is not None:
                held.append(piece + "}")
                if not inside and depth < ELEMENT:
                    if head != whole:
                        out.append((*place, CLOSES if head else WHOLE, base + number, "".join(held)))
                    held, head, number = None, False, number + 1
            if len(out) >= 1000:
                yield _batch(out, kinds, names)
                out = []
        if place is not None:
            end_of_range()
        yield _batch(out, kinds, names)
    return run


def read_array(spark: SparkSession, path: str) -> DataFrame:
    """``(ordinal, value)``: the elements of the documents at a path as JSON text, ordered within a document.

    An element is an object of an array right below the document, which has one such array; other keys
    may hold anything else. ``ordinal`` rises in the document's order but has gaps. The driver holds a
    row for each byte range, one for ``spark.sql.files.maxPartitionBytes`` of input.
    """
    pieces = _pieces(spark, path)
    starts = {(r["file"], r["start"]): r for r in range_starts(pieces).collect()}
    inner = pieces.mapInArrow(_cut(starts, True), _PIECES).select(F.col("place").alias("ordinal"), "value")
    if not any(r["depth"] >= ELEMENT for r in starts.values()):
        return inner
    cut = pieces.mapInArrow(_cut(starts, False), _PIECES)
    order = Window.partitionBy("file").orderBy("start", F.col("kind") == OPENS)  # two rows for each range at most
    numbered = cut.withColumn("element", F.sum((F.col("kind") == OPENS).cast("int")).over(order))
    joined = numbered.groupBy("file", "element").agg(
        F.sort_array(F.collect_list(F.struct("start", "place", "value"))).alias("all")).where("element > 0")
    return inner.union(joined.select(F.col("all")[0]["place"], F.array_join("all.value", "")))


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    """``value``: the elements of the one document that ``write_document`` left in parts, as JSON text.

    Each stands on a line of its own there, between the line that opens the document and the one that ends it.
    """
    line = F.col("value")
    held = spark.read.text(path).where(line.endswith("}") & ~line.startswith("]"))
    return held.select(F.when(line.startswith(","), F.expr("substring(value, 2)")).otherwise(line).alias("value"))


def write_document(features: DataFrame, path: str, header: dict[str, Column] | None = None, array: str = "features",
                   facts: DataFrame | None = None, mode: str = "error", one_file: bool = False) -> list[str]:
    """Write ``features (id, json)`` as one document in parts; joined in the order of their names they are it.

    The elements stand in the order of their ids, which must differ, and each on a line of its own. ``header`` are the document's other
    keys, columns of the one row ``facts``. Returns the parts' paths in order; ``one_file`` has one task
    write all of it.
    """
    spark = features.sparkSession
    least = features.agg(F.min("id").alias("id")).first()["id"]
    comma = F.when(F.col("id") == F.lit(least), F.col("json")).otherwise(F.concat(F.lit(","), F.col("json")))
    one = spark.range(1) if facts is None else facts
    opening = "{}" if not header else F.to_json(F.struct(*(c.alias(k) for k, c in header.items())))
    opening = F.lit(opening) if isinstance(opening, str) else opening
    key = F.lit(f'"{array}":[')
    begin = F.when(opening == "{}", F.concat(F.lit("{"), key)).otherwise(
        F.concat(F.substring(opening, F.lit(1), F.length(opening) - 1), F.lit(","), key))
    id_type = features.schema["id"].dataType
    nothing = F.lit(None).cast(id_type).alias("id")
    rows = (one.select(F.lit(0).alias("part"), nothing, begin.alias("value"))
            .union(features.select(F.lit(1), "id", comma)).union(spark.range(1).select(F.lit(2), nothing, F.lit("]}"))))
    ordered = rows.orderBy("part", "id").select("value")
    (ordered.coalesce(1) if one_file else ordered).write.mode(mode).text(path)
    files = spark.read.text(path).select(F.col("_metadata.file_path").alias("f")).distinct()
    return sorted(r["f"] for r in files.collect())
