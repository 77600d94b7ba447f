"""Outline simplification (Douglas-Peucker) that keeps topology, one shape per row.

Vertices within the tolerance go first. Then the segments of all rings of the shape are dealt to the cells of a grid, and those
that meet in a cell are tested against each other; a segment that crosses or touches another one gets back the farthest of the
vertices it replaced, until nothing meets that did not meet before. Many shapes go through every step together.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold import defaults as D


# Tasks get the functions below by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STEP_VERTICES = 200_000  # vertices of the shapes that go through the steps together, or those of one shape


def _farthest(points: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per span the greatest distance of its inner vertices from the segment between its ends, and the first vertex that has it."""
    count = last - first - 1
    cuts = np.cumsum(count) - count
    span = np.repeat(np.arange(len(first)), count)
    at = np.arange(len(span)) + (first + 1 - cuts)[span]
    a, along = points[first], points[last] - points[first]
    length2 = (along * along).sum(axis=1)
    t = ((points[at] - a[span]) * along[span]).sum(axis=1) / np.where(length2 == 0, 1.0, length2)[span]
    t = np.clip(np.where((length2 == 0)[span], 0.0, t), 0.0, 1.0)
    far = np.hypot(*(points[at] - (a[span] + t[:, None] * along[span])).T)
    most = np.maximum.reduceat(far, cuts)
    hit = np.flatnonzero((far == most[span]) | np.isnan(far))[::-1]
    which = np.zeros(len(first), np.int64)
    which[span[hit]] = at[hit]  # the first one is written last
    return most, which


def _within(points: np.ndarray, starts: np.ndarray, ends: np.ndarray, tolerance: float) -> np.ndarray:
    """Whether each vertex of the rings stays. Ends stay; a ring keeps at least a triangle."""
    keep, size = np.zeros(len(points), dtype=bool), ends - starts
    some = size > 0
    keep[starts[some]] = keep[ends[some] - 1] = True
    first, last = starts[size > 3], ends[size > 3] - 1
    while len(first):
        most, middle = _farthest(points, first, last)
        split = most > tolerance
        middle = middle[split]
        keep[middle] = True
        first, last = np.concatenate([first[split], middle]), np.concatenate([middle, last[split]])
        inner = last - first > 1
        first, last = first[inner], last[inner]
    before = np.append(0, np.cumsum(keep))
    return keep | np.repeat(before[ends] - before[starts] < 4, size)


def kept_vertices(ring: np.ndarray, tolerance: float) -> np.ndarray:
    """Indexes of the ring vertices that stay within the tolerance alone."""
    return np.flatnonzero(_within(ring, np.array([0]), np.array([len(ring)]), tolerance))


def _segments(rings: list[np.ndarray], kept: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates (x1, y1, x2, y2) and (ring, first vertex, last vertex) of all segments."""
    spans = [np.column_stack([np.full(len(k) - 1, r), k[:-1], k[1:]]) for r, k in enumerate(kept) if len(k) > 1]
    lines = [np.column_stack([rings[r][k[:-1]], rings[r][k[1:]]]) for r, k in enumerate(kept) if len(k) > 1]
    return np.concatenate(lines or [np.zeros((0, 4))]), np.concatenate(spans or [np.zeros((0, 3), int)]).astype(int)


def _near_pairs(lines: np.ndarray, shape: np.ndarray):
    """Pairs of segments of a shape whose boxes share a cell of its grid, which has about as many cells as the shape has segments.

    Segments are sorted by shape. A shape with coordinates that are no finite numbers is one cell.
    """
    n = len(lines)
    low, high = np.minimum(lines[:, :2], lines[:, 2:]), np.maximum(lines[:, :2], lines[:, 2:])
    cuts = np.flatnonzero(np.append(True, shape[1:] != shape[:-1]))
    per = np.diff(np.append(cuts, n))
    own = np.repeat(np.arange(len(cuts)), per)
    origin = np.minimum.reduceat(low, cuts)
    side = (np.maximum.reduceat(high, cuts) - origin) / np.sqrt(per)[:, None]
    side[~(side > 0)] = 1.0
    a, b = ((v - origin[own]) // side[own] for v in (low, high))
    a, b = (np.where(np.isfinite(v), v, 0.0).astype(np.int64) for v in (a, b))
    width = np.maximum.reduceat(b, cuts) + 1
    cells = width.prod(axis=1)
    base = np.cumsum(cells) - cells
    size = b - a + 1
    count = size.prod(axis=1)
    who = np.repeat(np.arange(n), count)
    at = np.arange(len(who)) - np.repeat(np.cumsum(count) - count, count)
    cell = base[own[who]] + (a[who, 0] + at // size[who, 1]) * width[own[who], 1] + a[who, 1] + at % size[who, 1]
    order = np.argsort(cell, kind="stable")
    cell, who = cell[order], who[order]
    same = np.arange(len(cell))
    for step in range(1, len(cell)):  # partners that many places further in the same cell
        same = same[same + step < len(cell)]
        same = same[cell[same + step] == cell[same]]
        if not len(same):
            return
        yield who[same], who[same + step]


def _side(p: np.ndarray, q: np.ndarray, r: np.ndarray) -> np.ndarray:
    return np.sign((q[:, 0] - p[:, 0]) * (r[:, 1] - p[:, 1]) - (q[:, 1] - p[:, 1]) * (r[:, 0] - p[:, 0]))


def _inside(p: np.ndarray, q: np.ndarray, r: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Whether r lies on the segment p-q, but not at an end."""
    among = (np.minimum(p, q) <= r).all(axis=1) & (r <= np.maximum(p, q)).all(axis=1)
    return (side == 0) & among & (r != p).any(axis=1) & (r != q).any(axis=1)


def _meeting(lines: np.ndarray, shape: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of segments of a shape that cross, or of which one touches the other elsewhere than at its ends."""
    out = [(np.zeros(0, int), np.zeros(0, int))]
    for i, j in _near_pairs(lines, np.zeros(len(lines), int) if shape is None else shape):
        p, q, r, s = lines[i, :2], lines[i, 2:], lines[j, :2], lines[j, 2:]
        one, two, three, four = _side(p, q, r), _side(p, q, s), _side(r, s, p), _side(r, s, q)
        hit = (one * two < 0) & (three * four < 0)
        hit |= _inside(p, q, r, one) | _inside(p, q, s, two) | _inside(r, s, p, three) | _inside(r, s, q, four)
        out.append((i[hit], j[hit]))
    return tuple(np.concatenate(c) for c in zip(*out))


def kept_of_shapes(points: np.ndarray, sizes: np.ndarray, shapes: np.ndarray, tolerance: float) -> np.ndarray:
    """Whether each vertex stays, so that no segments of a shape meet that did not meet before.

    ``sizes`` are the vertices of each ring and ``shapes`` the ascending numbers of their shapes.
    """
    ends, keep = np.cumsum(sizes), np.zeros(len(points), dtype=bool)
    ring, open_ = np.repeat(np.arange(len(sizes)), sizes), np.unique(shapes)
    with np.errstate(invalid="ignore", over="ignore"):
        keep |= _within(points, ends - sizes, ends, tolerance)
        while True:
            at = np.flatnonzero(keep & np.isin(shapes, open_)[ring])
            first, last = at[:-1], at[1:]
            one = ring[first] == ring[last]
            first, last = first[one], last[one]
            shape, shorter = shapes[ring[first]], last - first > 1
            use = np.isin(shape, shape[shorter])  # others lost no vertex
            first, last, shape, shorter = first[use], last[use], shape[use], shorter[use]
            if not len(first):
                return keep
            bad = np.unique(np.concatenate(_meeting(np.column_stack([points[first], points[last]]), shape)))
            back = bad[shorter[bad]]
            if not len(back):
                return keep
            keep[_farthest(points, first[back], last[back])[1]] = True
            open_ = np.unique(shape[back])


def kept_of_shape(rings: list[np.ndarray], tolerance: float) -> list[np.ndarray]:
    """Indexes of the vertices that stay, ring by ring, of one shape."""
    sizes = np.array([len(r) for r in rings], np.int64)
    points = np.concatenate([np.zeros((0, 2)), *rings])
    keep = kept_of_shapes(points, sizes, np.zeros(len(rings), np.int64), tolerance)
    return [np.flatnonzero(k) for k in np.split(keep, np.cumsum(sizes)[:-1])] if len(rings) else []


def _lengths(lists: pa.Array) -> np.ndarray:
    return pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.append(0, np.cumsum(sizes)), pa.int32())


def _kept_lists(xs: pa.Array, ys: pa.Array, tolerance: float) -> pa.Array:
    """Per shape and ring the indexes of the vertices that stay, from lists of lists of coordinates."""
    rings, sizes = _lengths(xs), _lengths(xs.flatten())
    points = np.column_stack([c.flatten().flatten().to_numpy(zero_copy_only=False).astype(float) for c in (xs, ys)])
    shapes, keep = np.repeat(np.arange(len(rings)), rings), np.zeros(len(points), dtype=bool)
    ring_at, at = np.append(0, np.cumsum(rings)), np.append(0, np.cumsum(sizes))
    begin = 0
    while begin < len(rings):
        room = at[ring_at[begin]] + STEP_VERTICES
        end = max(begin + 1, int(np.searchsorted(at[ring_at], room, side="right")) - 1)
        own, part = slice(ring_at[begin], ring_at[end]), slice(at[ring_at[begin]], at[ring_at[end]])
        keep[part] = kept_of_shapes(points[part], sizes[own], shapes[own], tolerance)
        begin = end
    before = np.append(0, np.cumsum(keep))
    inside = np.flatnonzero(keep) - np.repeat(at[:-1], before[at[1:]] - before[at[:-1]])
    lists = pa.ListArray.from_arrays(_offsets(before[at[1:]] - before[at[:-1]]), pa.array(inside, pa.int32()))
    return pa.ListArray.from_arrays(_offsets(rings), lists, mask=xs.is_null())


def simplify_boundaries(
    boundaries: DataFrame, tolerance: float = D.SIMPLIFY_TOLERANCE, rings_col: str = "rings"
) -> DataFrame:
    """The same rows with fewer vertices per ring, within ``tolerance`` degrees, and without new crossings.

    Every row gives one row, whatever its other columns; null and empty shapes and rings stay as they are. Only the
    coordinates travel to Python, from as many tasks as there are cores, however few files hold the shapes.
    """

    @F.arrow_udf("array<array<int>>")
    def kept(xs: pa.Array, ys: pa.Array) -> pa.Array:
        return _kept_lists(xs, ys, tolerance)

    def coordinates(name: str):
        return F.transform(rings_col, lambda ring: F.transform(ring, lambda p: p[name]))

    shorter = F.zip_with(
        rings_col, "_keep", lambda ring, keep: F.when(ring.isNotNull(), F.transform(keep, lambda i: F.get(ring, i)))
    )
    spark = boundaries.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spread = boundaries.repartition(tasks)
    return spread.withColumn("_keep", kept(coordinates("x"), coordinates("y"))).withColumn(rings_col, shorter).drop("_keep")
