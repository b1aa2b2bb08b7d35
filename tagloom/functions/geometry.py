"""Geometry that has a closed form, as built-in expressions: projection, quantisation, lengths, areas, boxes.

Lines and rings are pairs of arrays of doubles, xs and ys. Everything else is in `kernel`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Half the width of the web-mercator square, the sphere's radius, and the steps of stored coordinates.
POLE = 20037508.342789244
RADIUS = 6378137.0
QUANTUM = 11930464.7083
SRIDS = (3857, 4326)


def project_x(lon: Column) -> Column:
    return lon * POLE / 180.0


def project_y(lat: Column) -> Column:
    return F.log(F.tan((lat + 90.0) * math.pi / 360.0)) / math.pi * POLE


def unproject_x(x: Column) -> Column:
    return x * 180.0 / POLE


def unproject_y(y: Column) -> Column:
    return (F.atan(F.exp(y / POLE * math.pi)) * 2.0 - math.pi / 2) * 180.0 / math.pi


def quantize(degrees: Column) -> Column:
    """A coordinate as it comes back from the compact store: truncated to steps of 2^-32 of the full circle."""
    return F.floor((degrees + 180.0) * QUANTUM) / F.lit(QUANTUM) - 180.0


def place(lon: Column, lat: Column, srid: int) -> tuple[Column, Column]:
    return (lon, lat) if srid == 4326 else (project_x(lon), project_y(lat))


def point_list(xs: Column, ys: Column) -> Column:
    return F.zip_with(xs, ys, lambda x, y: F.struct(x.alias("x"), y.alias("y")))


def without_repeats(points: Column) -> Column:
    """Drop points that lie within 1e-9 of the point before them in the list as it was."""

    def keep(p: Column, i: Column) -> Column:
        b = F.get(points, i - 1)
        return (i == 0) | (F.abs(p["x"] - b["x"]) >= 1e-9) | (F.abs(p["y"] - b["y"]) >= 1e-9)

    return F.filter(points, keep)


def _sum_pairs(points: Column, of) -> Column:
    """Sum over consecutive points; the list is read once."""
    start = F.struct(F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"), F.lit(0.0).alias("s"))
    step = lambda a, p: F.struct(p["x"].alias("x"), p["y"].alias("y"), (a["s"] + F.coalesce(of(a, p), F.lit(0.0))).alias("s"))
    return F.aggregate(points, start, step, lambda a: a["s"])


def length(points: Column) -> Column:
    return _sum_pairs(points, lambda a, b: F.sqrt((b["x"] - a["x"]) * (b["x"] - a["x"]) + (b["y"] - a["y"]) * (b["y"] - a["y"])))


def ring_area(points: Column) -> Column:
    """Area of a simple closed ring, relative to its first point for precision."""
    o = F.get(points, F.lit(0))
    return F.abs(_sum_pairs(points, lambda a, b: (a["x"] - o["x"]) * (b["y"] - o["y"]) - (b["x"] - o["x"]) * (a["y"] - o["y"]))) / 2.0


def bounds(points: Column) -> Column:
    x, y = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.array_min(x).alias("minx"), F.array_min(y).alias("miny"), F.array_max(x).alias("maxx"), F.array_max(y).alias("maxy"))


def web_mercator_scale(miny: Column, maxy: Column) -> Column:
    """Square of the cosine of the latitude half-way between two mercator ordinates."""
    c = F.cos(F.atan(F.exp((miny + (maxy - miny) / 2) / POLE * math.pi)) * 2.0 - math.pi / 2)
    return c * c


def ewkb_hex(wkb: Column, srid: int) -> Column:
    """Little-endian WKB to upper-case hex with the reference system spliced in; empty for null."""
    h = F.hex(wkb)
    mark = srid.to_bytes(4, "little").hex().upper()
    return F.when(wkb.isNull(), F.lit("")).otherwise(F.concat(F.substring(h, 1, 8), F.lit("20"), F.lit(mark), h.substr(F.lit(11), F.length(h))))
