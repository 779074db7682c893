"""Records of delimited text cut by many tasks, whatever line breaks their quoted fields hold.

Where a byte range of a file begins, inside quotes or not, depends on all that stands before it. A
range maps the state at its start to the state at its end, and such maps compose, so the state at every
start is a prefix scan over one small row per range. First each range is read once for both possible
starts; then it is read again and cut, with its start known. The pieces of a record that reaches over
ranges meet by a shuffle of just these pieces.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_RANGE = "file bigint, start bigint"
_MAPS = f"{_RANGE}, from_outside boolean, from_inside boolean"
_PIECES = f"{_RANGE}, kind string, value string"

#: Pieces of a record that is longer than its range: its begin (or a header's), a range without end, its end.
OPENS, TITLE, RUNS, CLOSES = "opens", "title", "runs", "closes"


def scanner(separator: str, quote: str) -> Callable[[str, bool], bool]:
    """A function of a line and the state at its start that gives the state at its end: inside quotes?

    A quote opens at a field's start only and closes when it is not doubled; others are plain text.
    """
    q, s = re.escape(quote), re.escape(separator)
    opening = re.compile(f"(?:^|{s}){q}")
    closing = re.compile(f"(?:[^{q}]++|{q}{q})*+{q}")

    def state(line: str, inside: bool) -> bool:
        at = 0
        if inside:
            end = closing.match(line)
            if end is None:
                return True
            at = end.end()
        while (begin := opening.search(line, at)) is not None:
            end = closing.match(line, begin.end())
            if end is None:
                return True
            at = end.end()
        return False

    return state


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, start, value)``: physical lines in order, with the byte range that each begins in."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _same_range(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.Array]]:
    """The batch's lines, a piece for each range they come from."""
    file, start = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
    cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(start) != 0)) + 1
    edges = [0, *cuts.tolist(), batch.num_rows]
    for low, high in zip(edges, edges[1:], strict=False):
        if high > low:
            yield (int(file[low]), int(start[low])), batch.column(2).slice(low, high - low)


def _map_ranges(separator: str, quote: str):
    """What each range makes of a start outside and of one inside quotes; both tracks soon agree."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        after = scanner(separator, quote)
        ends: dict[tuple[int, int], tuple[bool, bool]] = {}
        for batch in batches:
            for place, lines in _same_range(batch):
                outside, inside = ends.get(place, (False, True))
                quoted = pc.filter(lines, pc.greater(pc.count_substring(lines, quote), 0))
                for line in quoted.to_pylist():
                    same = outside == inside
                    outside = after(line, outside)
                    inside = outside if same else after(line, inside)
                ends[place] = outside, inside
        rows = [(*place, *states) for place, states in ends.items()]
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                         names=["file", "start", "from_outside", "from_inside"])
    return run


def range_states(lines: DataFrame, separator: str, quote: str) -> DataFrame:
    """``(file, start, inside, open)``: whether each range begins and ends inside quotes. One row for each range.

    A range that ends alike from both starts settles the state. What follows it either keeps the state or
    swaps it, so the composition of all maps before a range is the last settled state and a parity.
    """
    maps = lines.mapInArrow(_map_ranges(separator, quote), _MAPS)
    alike, swaps = F.col("from_outside") == F.col("from_inside"), F.col("from_outside") & ~F.col("from_inside")
    order = Window.partitionBy("file").orderBy("start")  # a row for each range of a file
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    counted = maps.withColumn("swaps", F.sum(swaps.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    settled = F.when(alike, F.struct("start", F.col("from_outside").alias("state"), "swaps"))
    known = counted.select("*", F.last(settled, ignorenulls=True).over(before).alias("last"),
                           F.last("swaps").over(before).alias("so_far"))
    odd = (F.coalesce("so_far", F.lit(0)) - F.coalesce("last.swaps", F.lit(0))) % 2 == 1
    inside = F.coalesce("last.state", F.lit(False)) != odd
    return known.select("file", "start", inside.alias("inside"), F.when(inside, F.col("from_inside")).otherwise(
        F.col("from_outside")).alias("open"))


def _cut(separator: str, quote: str, inside_starts: set[tuple[int, int]], pieces: bool):
    """Whole records of each range, or the pieces of those that reach over ranges."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        after = scanner(separator, quote)
        place, inside, head, heading, held = None, False, False, False, []

        def rows(kind: str | None, values: pa.Array) -> pa.RecordBatch:
            n = len(values)
            return pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(x, pa.int64()), n) for x in place] + [pa.repeat(pa.scalar(kind, pa.string()), n), values],
                names=["file", "start", "kind", "value"])

        def text(lines: list[str]) -> pa.Array:
            return pa.array(["\n".join(lines)], pa.string())

        def end_of_range() -> Iterator[pa.RecordBatch]:
            if pieces and inside:
                yield rows(RUNS if head else TITLE if heading else OPENS, text(held))

        for batch in batches:
            for now, lines in _same_range(batch):
                if now != place:
                    if place is not None:
                        yield from end_of_range()
                    place, inside, held = now, now in inside_starts, []
                    head, heading = inside, now[1] == 0
                while heading and not inside and len(lines):
                    first = lines[0].as_py()
                    if first not in ("", "\r"):
                        heading = after(first, False)
                        if heading:
                            break  # it goes on in the next line
                    lines = lines.slice(1)
                quoted = np.flatnonzero(pc.greater(pc.count_substring(lines, quote), 0).to_numpy(zero_copy_only=False))
                at, plain, stitched = 0, [], []  # lines before ``at`` are done
                for k in quoted.tolist():
                    line = lines[k].as_py()
                    was, inside = inside, after(line, inside)
                    if not was and not inside:
                        continue  # a record of its own
                    if not was:
                        plain.append(lines.slice(at, k - at))
                        held = [line]
                    else:
                        held += lines.slice(at, k + 1 - at).to_pylist()
                        if not inside:
                            if head and pieces:
                                yield rows(CLOSES, text(held))
                            elif not head and not heading:
                                stitched.append("\n".join(held))
                            held, head, heading = [], False, False
                    at = k + 1
                if inside:
                    held += lines.slice(at).to_pylist()
                else:
                    plain.append(lines.slice(at))
                if not pieces:
                    yield rows(None, pa.concat_arrays([*plain, pa.array(stitched, pa.string())]))
        if place is not None:
            yield from end_of_range()
    return run


def read_records(spark: SparkSession, path: str, separator: str, quote: str) -> DataFrame:
    """``value``: the records of the files at a path as text, without each file's first one, the header.

    Blank lines are no records. The driver holds the ranges that begin inside quotes: one entry for each
    ``spark.sql.files.maxPartitionBytes`` of input at most. Quotes that never close make the rest of
    the file one record; a record has to fit into one row.
    """
    lines = _lines(spark, path)
    states = range_states(lines, separator, quote).where("inside OR open").select("file", "start", "inside").collect()
    starts = {(r["file"], r["start"]) for r in states if r["inside"]}
    records = lines.mapInArrow(_cut(separator, quote, starts, False), _PIECES).select("value")
    if states:
        parts = lines.mapInArrow(_cut(separator, quote, starts, True), _PIECES)
        begins = F.col("kind").isin(OPENS, TITLE)
        order = Window.partitionBy("file").orderBy("start", begins)  # two rows for each range of a file at most
        numbered = parts.withColumn("record", F.sum(begins.cast("int")).over(order))
        joined = numbered.groupBy("file", "record").agg(
            F.sort_array(F.collect_list(F.struct("start", "value"))).alias("parts"),
            F.bool_or(F.col("kind") == TITLE).alias("title")).where("NOT title")
        records = records.union(joined.select(F.array_join("parts.value", "\n")))
    ended = F.col("value").endswith("\r")
    return records.select(F.when(ended, F.expr("substring(value, 1, length(value) - 1)")).otherwise(
        F.col("value")).alias("value")).where("value <> ''")
