"""Projections of the WGS 84 ellipsoid as column expressions: transverse Mercator zones and azimuthal equal area.

Transverse Mercator uses Krüger's series to the fourth power of the third flattening, good to well under a millimetre
within a few tens of degrees of the central meridian. All functions take degrees or metres and give structs; nulls give null fields.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrafold.functions.geometry import _as_column

# Fixed values of the ellipsoid: semi-major axis in metres, flattening.
AXIS = 6378137.0
FLATTENING = 1 / 298.257223563

_N = FLATTENING / (2 - FLATTENING)
_RECTIFYING = AXIS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_E2 = FLATTENING * (2 - FLATTENING)
_E = math.sqrt(_E2)

# Coefficients of Krüger's series for powers of n: to the plane, from the plane, from conformal to geodetic latitude.
_TO_PLANE = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
_FROM_PLANE = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)
_TO_GEODETIC = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
    56 * _N**3 / 15 - 136 * _N**4 / 35,
    4279 * _N**4 / 630,
)


@dataclass(frozen=True)
class EqualArea:
    """Centre in degrees and false origin in metres; the defaults are those of the European grid."""

    latitude: float = 52.0
    longitude: float = 10.0
    east: float = 4321000.0
    north: float = 3210000.0


def zone_meridian(longitude) -> Column:
    """Central meridian of the six-degree zone of a longitude."""
    return F.floor((_as_column(longitude) + 180) / 6) * 6 - 177


def to_transverse_mercator(
    longitude, latitude, meridian, scale: float = 0.9996, east: float = 500000.0, north: float = 0.0
) -> Column:
    """Degrees to metres (x, y) around a central meridian, which may be a column."""
    lon, sine = F.radians(_as_column(longitude) - _as_column(meridian)), F.sin(F.radians(_as_column(latitude)))
    root = 2 * math.sqrt(_N) / (1 + _N)
    t = F.sinh(F.atanh(sine) - root * F.atanh(root * sine))
    up, out = F.atan2(t, F.cos(lon)), F.atanh(F.sin(lon) / F.sqrt(1 + t * t))
    x, y = out, up
    for j, a in enumerate(_TO_PLANE, 1):
        x = x + a * F.cos(2 * j * up) * F.sinh(2 * j * out)
        y = y + a * F.sin(2 * j * up) * F.cosh(2 * j * out)
    size = scale * _RECTIFYING
    return F.struct((east + size * x).alias("x"), (north + size * y).alias("y"))


def from_transverse_mercator(
    x, y, meridian, scale: float = 0.9996, east: float = 500000.0, north: float = 0.0
) -> Column:
    """Metres around a central meridian to degrees (longitude, latitude)."""
    size = scale * _RECTIFYING
    up, out = (_as_column(y) - north) / size, (_as_column(x) - east) / size
    v, u = up, out
    for j, b in enumerate(_FROM_PLANE, 1):
        v = v - b * F.sin(2 * j * up) * F.cosh(2 * j * out)
        u = u - b * F.cos(2 * j * up) * F.sinh(2 * j * out)
    conformal = F.asin(F.sin(v) / F.cosh(u))
    latitude = conformal
    for j, d in enumerate(_TO_GEODETIC, 1):
        latitude = latitude + d * F.sin(2 * j * conformal)
    return F.struct(
        (_as_column(meridian) + F.degrees(F.atan2(F.sinh(u), F.cos(v)))).alias("longitude"),
        F.degrees(latitude).alias("latitude"),
    )


def _area(s):
    """Area function of the ellipsoid for the sine of a latitude, a number or a column."""
    log = math.log if isinstance(s, float) else F.ln
    return (1 - _E2) * (s / (1 - _E2 * s * s) - log((1 - _E * s) / (1 + _E * s)) / (2 * _E))


_POLE = _area(1.0)
_RADIUS = AXIS * math.sqrt(_POLE / 2)


def _centre(grid: EqualArea) -> tuple[float, float, float]:
    """Sine and cosine of the authalic latitude of the centre, and the stretch there."""
    s = math.sin(math.radians(grid.latitude))
    sine = _area(s) / _POLE
    cosine = math.sqrt(1 - sine * sine)
    return sine, cosine, AXIS * math.cos(math.radians(grid.latitude)) / math.sqrt(1 - _E2 * s * s) / (_RADIUS * cosine)


def to_equal_area(longitude, latitude, grid: EqualArea = EqualArea()) -> Column:
    """Degrees to metres (x, y) of an oblique azimuthal equal-area grid."""
    sine0, cosine0, stretch = _centre(grid)
    lon = F.radians(_as_column(longitude) - grid.longitude)
    sine = F.least(F.greatest(_area(F.sin(F.radians(_as_column(latitude)))) / _POLE, F.lit(-1.0)), F.lit(1.0))
    cosine = F.sqrt(1 - sine * sine)
    b = _RADIUS * F.sqrt(2 / (1 + sine0 * sine + cosine0 * cosine * F.cos(lon)))
    return F.struct(
        (grid.east + b * stretch * cosine * F.sin(lon)).alias("x"),
        (grid.north + b / stretch * (cosine0 * sine - sine0 * cosine * F.cos(lon))).alias("y"),
    )


def from_equal_area(x, y, grid: EqualArea = EqualArea()) -> Column:
    """Metres of an azimuthal equal-area grid to degrees; the series for the latitude is closed by a Newton step."""
    sine0, cosine0, stretch = _centre(grid)
    right, up = (_as_column(x) - grid.east) / stretch, (_as_column(y) - grid.north) * stretch
    far = F.sqrt(right * right + up * up)
    c = 2 * F.asin(far / (2 * _RADIUS))
    part = F.when(far == 0, 0.0).otherwise(F.try_divide(up * F.sin(c), far))
    sine = F.cos(c) * sine0 + part * cosine0
    beta = F.asin(sine)
    latitude = (
        beta + (_E2 / 3 + 31 * _E2**2 / 180 + 517 * _E2**3 / 5040) * F.sin(2 * beta)
        + (23 * _E2**2 / 360 + 251 * _E2**3 / 3780) * F.sin(4 * beta) + 761 * _E2**3 / 45360 * F.sin(6 * beta)
    )
    s = F.sin(latitude)
    slope = 2 * (1 - _E2) * F.cos(latitude) / F.pow(1 - _E2 * s * s, F.lit(2.0))
    closer = latitude + F.when(F.abs(slope) > 1e-6, F.try_divide(sine * _POLE - _area(s), slope)).otherwise(0.0)
    lon = F.atan2(right * F.sin(c), far * cosine0 * F.cos(c) - up * sine0 * F.sin(c))
    return F.struct((grid.longitude + F.degrees(lon)).alias("longitude"), F.degrees(closer).alias("latitude"))
