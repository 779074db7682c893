"""Planar geometry on arrays of points.

A ring is ``ARRAY<STRUCT<x, y>>`` with the first point repeated at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def edges(ring: Column) -> Column:
    """Array of ``(x1, y1, x2, y2)``, one per side of the ring."""
    n = F.size(ring)
    return F.zip_with(
        F.slice(ring, 1, F.greatest(n - 1, F.lit(0))), F.slice(ring, 2, F.greatest(n - 1, F.lit(0))),
        lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"),
                              b["x"].alias("x2"), b["y"].alias("y2")))


def bounds(ring: Column) -> Column:
    """Struct ``xmin, ymin, xmax, ymax``."""
    xs, ys = ring["x"], ring["y"]
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"),
                    F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def moments(ring_edges: Column, x0: Column, y0: Column) -> Column:
    """Struct ``area, centroid_x, centroid_y`` by the shoelace sums.

    The sums are taken relative to ``(x0, y0)``, a point of the ring, to keep their digits.
    """
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my"))

    def step(s: Column, e: Column) -> Column:
        ax, ay, bx, by = e["x1"] - x0, e["y1"] - y0, e["x2"] - x0, e["y2"] - y0
        cross = ax * by - bx * ay
        return F.struct((s["a"] + cross).alias("a"), (s["mx"] + (ax + bx) * cross).alias("mx"),
                        (s["my"] + (ay + by) * cross).alias("my"))

    return F.aggregate(ring_edges, zero, step, lambda s: F.struct(
        (F.abs(s["a"]) / 2).alias("area"),
        (x0 + F.try_divide(s["mx"], s["a"] * 3)).alias("centroid_x"),
        (y0 + F.try_divide(s["my"], s["a"] * 3)).alias("centroid_y")))


def _side(e: Column, x: Column, y: Column) -> Column:
    return (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])


def _crosses(e: Column, x: Column, y: Column) -> Column:
    """Whether the side lies to the right of the point, at its height."""
    up = (e["y1"] <= y) & (e["y2"] > y) & (_side(e, x, y) > 0)
    down = (e["y2"] <= y) & (e["y1"] > y) & (_side(e, x, y) < 0)
    return up | down


def _touches(e: Column, x: Column, y: Column) -> Column:
    return ((_side(e, x, y) == 0) & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
            & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])))


def crossed(ring_edges: Column, x: Column, y: Column) -> Column:
    """How many sides lie to the right of the point, at its height."""
    return F.size(F.filter(ring_edges, lambda e: _crosses(e, x, y)))


def touched(ring_edges: Column, x: Column, y: Column) -> Column:
    """Whether the point lies on a side."""
    return F.exists(ring_edges, lambda e: _touches(e, x, y))


def between_two(ring_edges: Column, x: Column, y: Column) -> Column:
    """``contains`` where two sides at most can tell, as plain arithmetic; no coordinate is NULL."""
    one, two = (F.get(ring_edges, F.lit(k)) for k in (0, 1))
    odd, on = ([F.coalesce(test(e, x, y), F.lit(False)) for e in (one, two)] for test in (_crosses, _touches))
    return (odd[0] != odd[1]) & ~on[0] & ~on[1]


def contains(ring_edges: Column, x: Column, y: Column) -> Column:
    """The point lies strictly inside: an odd number of sides to its right and on none of them."""
    return (crossed(ring_edges, x, y) % 2 == 1) & ~touched(ring_edges, x, y)


# ---- Array helpers run inside tasks, one shape or pair at a time ----------------------------
# Their Arrow functions are marked nondeterministic only so that Spark, which may copy an
# expression into a filter and a projection, calls each of them once per row.

def _points(xs, ys) -> np.ndarray:
    return np.column_stack([np.asarray(xs, dtype=np.float64), np.asarray(ys, dtype=np.float64)])


#: Sides or pairs of spans that are worked on at once; memory follows this, not a ring's sides.
PORTION = 1 << 19


def _strips(ring: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The ring's non-level sides, the first strip each one crosses, and how many.

    ``levels`` hold all of the ring's heights between the first and the last one, so that no side begins
    or ends within a strip.
    """
    a, b = ring[:-1], ring[1:]
    up = a[:, 1] != b[:, 1]
    a, b = a[up], b[up]
    low, high = np.minimum(a[:, 1], b[:, 1]), np.maximum(a[:, 1], b[:, 1])
    first = np.searchsorted(levels, np.clip(low, levels[0], levels[-1]))
    last = np.searchsorted(levels, np.clip(high, levels[0], levels[-1]))
    return a, b, first, last - first


def _portions(counts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of strips whose counts sum up to about ``PORTION``; each has one strip at least."""
    total, start = np.cumsum(counts), 0
    while start < len(counts):
        before = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + PORTION, "right")))
        yield start, min(stop, len(counts))
        start = min(stop, len(counts))


def _per_strip(first: np.ndarray, count: np.ndarray, strips: int) -> np.ndarray:
    edge = np.zeros(strips + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + count, -1)
    return np.cumsum(edge[:-1])


def _spans(sides: tuple, levels: np.ndarray, start: int, stop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of strips ``start`` to ``stop``: strip, and where the inside begins and ends at its bottom and top.

    Within a strip sides cross it whole and do not meet, so sorted by their middles every second one
    opens the inside. Rows are in the order of the strips.
    """
    a, b, first, count = sides
    begin, end = np.maximum(first, start), np.minimum(first + count, stop)
    held = np.flatnonzero(end > begin)
    n = (end - begin)[held]
    side = np.repeat(held, n)
    strip = np.repeat(begin[held], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    p, q = a[side], b[side]
    slope = (q[:, 0] - p[:, 0]) / (q[:, 1] - p[:, 1])
    x = p[:, :1] + (np.stack([levels[strip], levels[strip + 1]], axis=1) - p[:, 1:]) * slope[:, None]
    order = np.lexsort((x.sum(axis=1), strip))
    return strip[order][0::2], x[order][0::2], x[order][1::2]


def _shared_width(opens: np.ndarray, closes: np.ndarray, other_opens: np.ndarray, other_closes: np.ndarray) -> np.ndarray:
    """The mean width that pairs of spans share over a strip; their ends are linear, given at bottom and top.

    The width is linear between the heights where an end of one span meets an end of the other.
    """
    cuts = [np.zeros(len(opens)), np.ones(len(opens))]
    for f in (opens, closes):
        for g in (other_opens, other_closes):
            d = f - g
            with np.errstate(divide="ignore", invalid="ignore"):
                t = d[:, 0] / (d[:, 0] - d[:, 1])
            cuts.append(np.where(np.isfinite(t), np.clip(t, 0, 1), 0.0))
    t = np.sort(np.stack(cuts, axis=1), axis=1)
    middle = (t[:, 1:] + t[:, :-1]) / 2

    def at(f: np.ndarray) -> np.ndarray:
        return f[:, :1] + (f[:, 1:] - f[:, :1]) * middle

    width = np.minimum(at(closes), at(other_closes)) - np.maximum(at(opens), at(other_opens))
    return (np.clip(width, 0, None) * np.diff(t, axis=1)).sum(axis=1)


def overlap_area(a: np.ndarray, b: np.ndarray) -> float:
    """Exact area two simple rings share.

    The plane is cut into horizontal strips at every vertex. Within a strip the inside of a ring is a
    few spans whose ends are straight, and the shared area of two spans is known. Strips are taken in
    portions, so memory does not grow with the product of the rings' sides.
    """
    low, high = max(a[:, 1].min(), b[:, 1].min()), min(a[:, 1].max(), b[:, 1].max())
    if not low < high:
        return 0.0
    levels = np.unique(np.concatenate([a[:, 1], b[:, 1]]))
    levels = levels[(levels >= low) & (levels <= high)]
    left, right = _strips(a, levels), _strips(b, levels)
    counts = [_per_strip(first, count, len(levels) - 1) for _, _, first, count in (left, right)]
    total = 0.0
    for start, stop in _portions(counts[0] * counts[1] // 4 + counts[0] + counts[1]):
        strip, opens, closes = _spans(left, levels, start, stop)
        other, other_opens, other_closes = _spans(right, levels, start, stop)
        # Each span of the one ring with all spans of the other in the same strip.
        begin, end = np.searchsorted(other, strip), np.searchsorted(other, strip, "right")
        n = end - begin
        one = np.repeat(np.arange(len(strip)), n)
        two = np.repeat(begin, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        height = levels[strip[one] + 1] - levels[strip[one]]
        total += float(height @ _shared_width(opens[one], closes[one], other_opens[two], other_closes[two]))
    return total


#: Convex rings of so few sides are clipped many pairs at a time.
FEW_SIDES = 16


def _corners(xs: pa.Array, ys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Corners of many rings as one array, the last one repeated where a ring has fewer, and their numbers."""
    count = np.diff(xs.offsets.to_numpy()) - 1
    at = xs.offsets.to_numpy()[:-1, None] + np.minimum(np.arange(count.max(initial=1)), count[:, None] - 1)
    return np.stack([xs.values.to_numpy(zero_copy_only=False)[at], ys.values.to_numpy(zero_copy_only=False)[at]], axis=2), count


def _next(count: np.ndarray, width: int) -> np.ndarray:
    """The place of the corner after each one; a repeated corner is followed by itself."""
    k = np.arange(width)
    return np.where(k < count[:, None] - 1, k + 1, np.where(k == count[:, None] - 1, 0, k))


def _turned(rings: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sign of each ring's area, and whether the ring is convex, without repeated corners and spikes."""
    after = np.take_along_axis(rings, _next(count, rings.shape[1])[:, :, None], axis=1)
    side = after - rings
    # The side that begins where this one ends.
    then = np.take_along_axis(side, _next(count, rings.shape[1])[:, :, None], axis=1)
    cross = side[..., 0] * then[..., 1] - side[..., 1] * then[..., 0]
    ahead = (side * then).sum(axis=2)
    own = np.arange(rings.shape[1]) < count[:, None]
    sign = np.where((cross * own).sum(axis=1) < 0, -1.0, 1.0)
    turn = cross * sign[:, None]
    convex = (((turn > 0) | ((turn == 0) & (ahead > 0))) | ~own).all(axis=1)
    return sign, convex & (count >= 3)


def clipped_areas(a: np.ndarray, b: np.ndarray, count: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """Areas that convex rings ``a`` share with convex rings ``b``, whose corners and signs are given.

    The first ring of each pair is cut off at the line through each side of the second one.
    """
    origin = a[:, :1]
    a, b = a - origin, b - origin
    ends = np.take_along_axis(b, _next(count, b.shape[1])[:, :, None], axis=1)
    for k in range(b.shape[1]):
        p, d = b[:, k:k + 1], (ends[:, k:k + 1] - b[:, k:k + 1]) * sign[:, None, None]
        away = d[..., 0] * (a[..., 1] - p[..., 1]) - d[..., 1] * (a[..., 0] - p[..., 0])
        inside, far = away >= 0, np.roll(away, -1, axis=1)
        crosses = inside != (far >= 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            t = np.where(crosses, away / (away - far), 0.0)
        met = a + t[..., None] * (np.roll(a, -1, axis=1) - a)
        both = np.stack([a, met], axis=2).reshape(len(a), -1, 2)
        kept = np.stack([inside, crosses], axis=2).reshape(len(a), -1)
        n = kept.sum(axis=1)
        order = np.argsort(~kept, axis=1, kind="stable")
        place = np.minimum(np.arange(n.max(initial=1) or 1), np.maximum(n - 1, 0)[:, None])
        a = np.take_along_axis(both, np.take_along_axis(order, place, axis=1)[:, :, None], axis=1)
    x, y = (a - a[:, :1]).transpose(2, 0, 1)
    return np.abs((x * np.roll(y, -1, axis=1) - y * np.roll(x, -1, axis=1)).sum(axis=1)) / 2


def _shared_areas(ax: pa.Array, ay: pa.Array, bx: pa.Array, by: pa.Array) -> np.ndarray:
    """The shared area of each pair: convex rings of few sides together, others one by one."""
    sizes = [np.diff(c.offsets.to_numpy()) for c in (ax, bx)]
    few = (np.maximum(*sizes) <= FEW_SIDES + 1) & (np.minimum(*sizes) > 3)
    for c in (ax, ay, bx, by):
        # A ring that lacks a value is left to the general way.
        if c.values.null_count:
            few &= ~np.asarray([any(v is None for v in row) for row in c.to_pylist()], bool)
    out, at = np.empty(len(ax)), np.flatnonzero(few)
    if len(at):
        some = pa.array(at)
        (a, n_a), (b, n_b) = _corners(ax.take(some), ay.take(some)), _corners(bx.take(some), by.take(some))
        (_, one), (sign, two) = _turned(a, n_a), _turned(b, n_b)
        both = one & two
        if both.any():
            out[at[both]] = clipped_areas(a[both], b[both], n_b[both], sign[both])
        few[at[~both]] = False
    for k in np.flatnonzero(~few):
        out[k] = overlap_area(_points(ax[k].as_py(), ay[k].as_py()), _points(bx[k].as_py(), by[k].as_py()))
    return out


def shared_area(left: Column, right: Column) -> Column:
    """Exact area that two simple rings share."""
    @F.arrow_udf("double")
    def run(ax: pa.Array, ay: pa.Array, bx: pa.Array, by: pa.Array) -> pa.Array:
        there = pc.and_(ax.is_valid(), bx.is_valid())
        at = np.flatnonzero(there.to_numpy(zero_copy_only=False))
        some = pa.array(at)
        out = np.full(len(ax), np.nan)
        out[at] = _shared_areas(*(c.take(some) for c in (ax, ay, bx, by)))
        return pa.array(out, mask=~there.to_numpy(zero_copy_only=False))

    return run.asNondeterministic()(left["x"], left["y"], right["x"], right["y"])


def _middle(ring: np.ndarray, axis: int) -> float:
    """The middle of the strip between neighbouring vertices that holds the median of the area."""
    pts = ring if axis == 1 else ring[:, ::-1]
    levels = np.unique(pts[:, 1])
    if len(levels) < 2:
        return float(levels[0])
    sides = _strips(pts, levels)
    width = np.zeros(len(levels) - 1)
    for start, stop in _portions(_per_strip(sides[2], sides[3], len(width))):
        strip, opens, closes = _spans(sides, levels, start, stop)
        np.add.at(width, strip, (closes - opens).mean(axis=1))
    area = np.cumsum(np.diff(levels) * width)
    at = min(int(np.searchsorted(area, area[-1] / 2)), len(width) - 1)
    return float((levels[at] + levels[at + 1]) / 2)


def median_point(ring: Column) -> Column:
    """A point ``(x, y)`` with at least an eighth of the ring's area on either side, on both axes.

    It is the middle of the strip that holds the median. A strip's width is linear, so its
    middle splits the strip's own area no worse than one to three.
    """
    @F.pandas_udf("x double, y double")
    def run(xs: pd.Series, ys: pd.Series) -> pd.DataFrame:
        rows = [(_middle(p, 0), _middle(p, 1)) if len(p) > 1 else (None, None)
                for p in (_points(x, y) for x, y in zip(xs, ys))]
        return pd.DataFrame(rows, columns=["x", "y"], dtype="float64")

    return run.asNondeterministic()(ring["x"], ring["y"])


def _simplify_all(points: np.ndarray, ends: np.ndarray, tolerance: float) -> np.ndarray:
    """Which points Douglas-Peucker keeps, of many lines behind one another; ``ends`` bounds the lines.

    The open stretches of all lines are looked at together, round by round.
    """
    keep = np.zeros(len(points), bool)
    first, last = ends[:-1], ends[1:] - 1
    some = last >= first
    first, last = first[some], last[some]
    keep[first] = keep[last] = True
    while True:
        wide = last - first > 1
        first, last = first[wide], last[wide]
        if not len(first):
            return keep
        n = last - first - 1
        begin = np.cumsum(n) - n
        own = np.repeat(np.arange(len(n)), n)
        inner = first[own] + 1 + np.arange(len(own)) - begin[own]
        base, d = points[first], points[last] - points[first]
        length = (d * d).sum(axis=1)
        along = ((points[inner] - base[own]) * d[own]).sum(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            t = np.where(length[own] > 0, np.clip(along / length[own], 0, 1), 0.0)
        away = np.hypot(*(points[inner] - (base[own] + t[:, None] * d[own])).T)
        most = np.maximum.reduceat(away, begin)
        # The first point as far away as the farthest one.
        far = np.minimum.reduceat(np.where((away == most[own]) | np.isnan(away), inner, len(points)), begin)
        split = most > tolerance
        far = far[split]
        keep[far] = True
        first, last = np.concatenate([first[split], far]), np.concatenate([far, last[split]])


def simplify(line: Column, tolerance: float) -> Column:
    """Douglas-Peucker simplification of a line; ends stay."""
    @F.pandas_udf("array<int>")
    def kept(xs: pd.Series, ys: pd.Series) -> pd.Series:
        out = np.full(len(xs), None, dtype=object)
        sizes = np.array([0 if x is None else len(x) for x in xs], np.int64)
        held = np.flatnonzero([x is not None for x in xs])
        for start, stop in _portions(sizes[held]):
            some = held[start:stop]
            ends = np.concatenate([[0], np.cumsum(sizes[some])])
            points = _points(*(np.concatenate([c.iloc[k] for k in some]) for c in (xs, ys)))
            keep = _simplify_all(points, ends, tolerance)
            for k, a, b in zip(some, ends[:-1], ends[1:]):
                out[k] = np.flatnonzero(keep[a:b]).astype(np.int32)
        return pd.Series(out, dtype=object)

    # Only positions come back; the points themselves stay where they are.
    return F.transform(kept.asNondeterministic()(line["x"], line["y"]), lambda i: F.get(line, i))
