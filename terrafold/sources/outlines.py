"""Outlines of countries from the ways that their relations list, in dumps with member geometry.

The ways of an outline come in any order and direction, and several make up one ring. The first relation of each code
counts, as it does for names. All ways of one relation meet in one task: together they are as large as the row that
the outline becomes.
"""

from __future__ import annotations

import sys
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrafold.functions.geometry import rings_wkt

# Tasks get the functions below by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_RINGS = "array<array<struct<x: double, y: double>>>"


def member_ways(dumps: DataFrame, order_cols: list[str]) -> DataFrame:
    """(iso_code, ref, inner, lons, lats) of the ways of every code's first relation that lists any with geometry.

    A way that a relation lists twice counts once; points without both coordinates are left out, and so are ways of fewer
    than two points. Any role but ``inner`` is an outer one.
    """
    elements = dumps.select(*order_cols, F.posexplode("elements").alias("_pos", "_e")).where(F.col("_e.type") == "relation")
    point = lambda p: p["lat"].isNotNull() & p["lon"].isNotNull()
    listed = elements.select(
        F.col("_e.tags").getItem("ISO3166-1").alias("iso_code"), F.struct(*order_cols, "_pos").alias("_place"), "_e.members",
    ).where("iso_code is not null and iso_code <> ''")
    ways = listed.select("iso_code", "_place", F.explode("members").alias("_m")).where("_m.type = 'way'").select(
        "iso_code", "_place", F.col("_m.ref").alias("ref"), F.coalesce(F.col("_m.role") == "inner", F.lit(False)).alias("inner"),
        F.filter("_m.geometry", point).alias("_points"),
    ).where(F.size("_points") >= 2)
    first = ways.groupBy("iso_code").agg(F.min("_place").alias("_place"))
    return (
        ways.join(first, ["iso_code", "_place"])
        .groupBy("iso_code", "ref").agg(F.min("inner").alias("inner"), F.min("_points").alias("_points"))
        .select("iso_code", "ref", "inner", F.transform("_points", lambda p: p["lon"]).alias("lons"),
                F.transform("_points", lambda p: p["lat"]).alias("lats"))
    )


def stitched(ways: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
    """Closed rings of ways that share end points, and the number of ways that close none.

    A ring starts with the first unused way and goes on with the first unused one that ends where it has got to. Where
    several rings touch in a point any way to part them encloses the same places.
    """
    ends: dict[tuple, list[int]] = defaultdict(list)
    for k, way in enumerate(ways):
        ends[tuple(way[0])].append(k)
        ends[tuple(way[-1])].append(k)
    used, rings, open_ = [False] * len(ways), [], 0
    for k, way in enumerate(ways):
        if used[k]:
            continue
        used[k], parts, start, at = True, [way], tuple(way[0]), tuple(way[-1])
        while at != start:
            following = next((j for j in ends[at] if not used[j]), None)
            if following is None:
                break
            used[following] = True
            more = ways[following] if tuple(ways[following][0]) == at else ways[following][::-1]
            parts.append(more[1:])
            at = tuple(more[-1])
        ring = np.concatenate(parts)
        if at == start and len(ring) >= 4:
            rings.append(ring)
        else:
            open_ += len(parts)
    return rings, open_


def turned(ring: np.ndarray, inner: bool) -> np.ndarray:
    """The ring from its least point on, counter-clockwise, or clockwise for a hole."""
    body = ring[:-1]
    x, y = body.T
    area = np.dot(x, np.roll(y, -1)) - np.dot(y, np.roll(x, -1))
    if (area < 0) != inner and area:
        body = body[::-1]
    body = np.roll(body, -int(np.lexsort((body[:, 1], body[:, 0]))[0]), axis=0)
    return np.concatenate([body, body[:1]])


def _outline(table: pa.Table) -> pa.Table:
    table = table.sort_by("ref")
    ways = [np.column_stack([x, y]) for x, y in zip(table.column("lons").to_pylist(), table.column("lats").to_pylist())]
    inner = table.column("inner").to_pylist()
    rings, left = [], 0
    for hole in (False, True):
        found, open_ = stitched([w for w, i in zip(ways, inner) if i == hole])
        left += open_
        rings += sorted((turned(r, hole) for r in found), key=lambda r: (*r[0], len(r), r.tobytes()))
    held = [[{"x": x, "y": y} for x, y in r.tolist()] for r in rings]
    kind = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
    return pa.table({"iso_code": table.column("iso_code").slice(0, 1), "rings": pa.array([held], kind), "open_ways": pa.array([left], pa.int64())})


def assembled_rings(dumps: DataFrame, order_cols: list[str]) -> DataFrame:
    """(iso_code, rings, open_ways): outer rings first, then holes; ways that close no ring are only counted.

    Codes whose relations list no ways with geometry give no row.
    """
    return member_ways(dumps, order_cols).groupBy("iso_code").applyInArrow(
        _outline, f"iso_code string, rings {_RINGS}, open_ways long"
    )


def member_outlines(dumps: DataFrame, order_cols: list[str]) -> DataFrame:
    """(iso_code, wkt) of every code with at least one ring, as ``country_boundaries`` takes them."""
    return assembled_rings(dumps, order_cols).where(F.size("rings") > 0).select("iso_code", rings_wkt(F.col("rings")).alias("wkt"))
