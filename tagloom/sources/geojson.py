"""GeoJSON polygons: features with properties as text."""

from __future__ import annotations

import json
import struct
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Ring = list[tuple[float, float]]


@dataclass(frozen=True)
class Feature:
    """One polygon: an outer ring and holes, in degrees."""

    rings: tuple[tuple[tuple[float, float], ...], ...]
    properties: dict[str, str]


def as_text(v) -> str:
    """A property value as text: whole numbers without a fraction, large or small ones with an exponent."""
    if v is None:
        return "<nil>"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int | float):
        f = float(v)
        if f == 0:
            return "0"
        digits = repr(f)
        power = int(f"{abs(f):e}".split("e")[1])
        if power < -4 or power >= 21:
            mantissa, exponent = f"{f:.17g}".split("e") if "e" in f"{f:.17g}" else (digits, "0")
            short = repr(f)
            if "e" in short:
                mantissa, exponent = short.split("e")
            return f"{mantissa.removesuffix('.0')}e{int(exponent):+03d}"
        if "e" in digits:
            digits = f"{f:.0f}"
        return digits.removesuffix(".0")
    return str(v)


def _ring(points) -> tuple[tuple[float, float], ...]:
    if not isinstance(points, list) or not points:
        raise ValueError("a GeoJSON ring has no points")
    out = []
    for p in points:
        if not isinstance(p, list) or len(p) not in (2, 3):
            raise ValueError("a GeoJSON position needs two or three numbers")
        out.append((float(p[0]), float(p[1])))
    return tuple(out)


def _polygons(geometry: dict) -> list[tuple]:
    kind, at = geometry.get("type"), geometry.get("coordinates")
    if kind == "Polygon":
        return [tuple(_ring(r) for r in at)]
    if kind == "MultiPolygon":
        return [tuple(_ring(r) for r in p) for p in at]
    raise ValueError(f"GeoJSON of type {kind} is no polygon")


def parse(text: str) -> list[Feature]:
    """Polygon, MultiPolygon (one feature for each polygon), Feature or FeatureCollection."""
    top = json.loads(text)
    kind = top.get("type")
    if kind == "FeatureCollection":
        return [f for x in top.get("features") or () for f in parse(json.dumps(x))]
    if kind == "Feature":
        props = {k: as_text(v) for k, v in (top.get("properties") or {}).items()}
        return [Feature(p, props) for p in _polygons(top["geometry"])]
    return [Feature(p, {}) for p in _polygons(top)]


def polygon_wkb(rings, move=lambda x, y: (x, y)) -> bytes:
    """Little-endian WKB of a polygon, each point moved by `move`."""
    out = struct.pack("<BII", 1, 3, len(rings))
    for r in rings:
        out += struct.pack("<I", len(r)) + b"".join(struct.pack("<dd", *move(x, y)) for x, y in r)
    return out


def multipolygon_wkb(features: list[Feature], move=lambda x, y: (x, y)) -> bytes:
    return struct.pack("<BII", 1, 6, len(features)) + b"".join(polygon_wkb(f.rings, move) for f in features)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file through Spark's readers, so that any store will do."""
    return spark.read.text(path, wholetext=True).first()[0]


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """(feature_idx, wkb, properties) of a GeoJSON file."""
    features = parse(read_text(spark, path))
    rows = [(i, bytearray(polygon_wkb(f.rings)), f.properties) for i, f in enumerate(features)]
    return spark.createDataFrame(rows, "feature_idx int, wkb binary, properties map<string,string>")
