"""Geometry as plain columns: WKT text, ring arrays, bounding boxes, containment, projection.

A ring is ``array<struct<x double, y double>>``; a shape is an array of rings. Holes and several
outer rings need no special case because containment counts crossings over all rings (even-odd).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6378137.0


def _as_column(column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def json_quote(column) -> Column:
    """Text as a JSON string literal."""
    encoded = F.to_json(F.array(_as_column(column)))
    return F.substring(encoded, F.lit(2), F.length(encoded) - 2)


def json_unquote(column) -> Column:
    """Content of a JSON string literal."""
    return F.get_json_object(_as_column(column), "$")


def wkt_rings(wkt) -> Column:
    """Rings of a POLYGON or MULTIPOLYGON text."""
    ring_texts = F.regexp_extract_all(_as_column(wkt), F.lit(r"\(([^()]+)\)"), F.lit(1))

    def point(text):
        parts = F.split(F.trim(text), r"\s+")
        return F.struct(
            F.get(parts, F.lit(0)).try_cast("double").alias("x"),
            F.get(parts, F.lit(1)).try_cast("double").alias("y"),
        )

    return F.transform(ring_texts, lambda ring: F.transform(F.split(ring, ","), point))


def _plain_number(value: Column) -> Column:
    return F.regexp_replace(value.cast("string"), r"\.0$", "")


def rings_wkt(rings) -> Column:
    """POLYGON text of a shape (first ring outer, the others holes)."""

    def ring_text(ring):
        points = F.transform(
            ring, lambda p: F.concat(_plain_number(p["x"]), F.lit(" "), _plain_number(p["y"]))
        )
        return F.concat(F.lit("("), F.array_join(points, ", "), F.lit(")"))

    return F.concat(
        F.lit("POLYGON ("), F.array_join(F.transform(_as_column(rings), ring_text), ", "), F.lit(")")
    )


def box_rings(min_lon, min_lat, max_lon, max_lat) -> Column:
    """Five-vertex ring around a box."""
    west, south, east, north = map(_as_column, (min_lon, min_lat, max_lon, max_lat))

    def corner(x, y):
        return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))

    ring = F.array(
        corner(west, south), corner(east, south), corner(east, north), corner(west, north),
        corner(west, south),
    )
    return F.array(ring)


def bounding_box(rings) -> Column:
    """Struct (min_lon, min_lat, max_lon, max_lat) of a shape."""
    points = F.flatten(_as_column(rings))
    xs = F.transform(points, lambda p: p["x"])
    ys = F.transform(points, lambda p: p["y"])
    return F.struct(
        F.array_min(xs).alias("min_lon"),
        F.array_min(ys).alias("min_lat"),
        F.array_max(xs).alias("max_lon"),
        F.array_max(ys).alias("max_lat"),
    )


def shape_edges(rings) -> Column:
    """All ring segments of a shape as ``array<struct<x1,y1,x2,y2>>``."""

    def segments(ring):
        starts = F.slice(ring, F.lit(1), F.greatest(F.size(ring) - 1, F.lit(0)))
        ends = F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0)))
        return F.zip_with(
            starts,
            ends,
            lambda a, b: F.struct(
                a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
            ),
        )

    return F.flatten(F.transform(_as_column(rings), segments))


def odd_crossings(edges: Column, x: Column, y: Column) -> Column:
    """Does a ray from (x, y) towards +x cross an odd number of edges?"""

    def crosses(e):
        at = e["x1"] + (e["x2"] - e["x1"]) * F.try_divide(y - e["y1"], e["y2"] - e["y1"])
        return ((e["y1"] > y) != (e["y2"] > y)) & (x < at)

    return F.size(F.filter(edges, crosses)) % 2 == 1


def on_any_edge(edges: Column, x: Column, y: Column) -> Column:
    def touches(e):
        cross = (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])
        return (
            (cross == 0)
            & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
            & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
        )

    return F.exists(edges, touches)


def strictly_inside(edges, x, y) -> Column:
    """Point within a shape; points on the outline are not."""
    edges, x, y = map(_as_column, (edges, x, y))
    return odd_crossings(edges, x, y) & ~on_any_edge(edges, x, y)


def to_web_mercator(longitude, latitude) -> Column:
    """Degrees to spherical web-mercator metres."""
    lon, lat = _as_column(longitude), _as_column(latitude)
    return F.struct(
        (F.radians(lon) * EARTH_RADIUS_M).alias("x"),
        (F.ln(F.tan(F.radians(lat) / 2 + F.pi() / 4)) * EARTH_RADIUS_M).alias("y"),
    )


def from_web_mercator(x, y) -> Column:
    """Spherical web-mercator metres to degrees."""
    x, y = _as_column(x), _as_column(y)
    return F.struct(
        F.degrees(x / EARTH_RADIUS_M).alias("longitude"),
        F.degrees(2 * F.atan(F.exp(y / EARTH_RADIUS_M)) - F.pi() / 2).alias("latitude"),
    )
