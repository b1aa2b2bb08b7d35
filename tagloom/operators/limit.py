"""Limit polygons: a buffered test of places while reading, and clipping of geometries while building rows."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import kernel
from ..sources.geojson import Feature, parse, polygon_wkb, read_text

#: Least width of a grid cell by reference system, and the tolerances of the buffered outline.
LEAST_CELL = {3857: 50000.0, 4326: 0.5}
OUTLINE, UNION_OUTLINE = 0.01, 0.05


def mover(srid: int):
    """Degrees to the reference system, on the driver."""
    import math

    from ..functions.geometry import POLE

    if srid == 4326:
        return lambda x, y: (x, y)
    return lambda x, y: (x * POLE / 180, math.log(math.tan((90 + y) * math.pi / 360)) / math.pi * POLE)


@dataclass(frozen=True)
class Limit:
    """A limit area; its outline is a literal of the plan, so it is of the size of one GeoJSON file."""

    name: str
    wkb: bytes
    srid: int
    buffered: bytes | None
    bbox: tuple[float, float, float, float] | None

    @staticmethod
    def load(spark: SparkSession, path: str, srid: int, buffer: float = 0.0) -> Limit:
        return Limit.of(spark, parse(read_text(spark, path)), srid, buffer)

    @staticmethod
    def of(spark: SparkSession, features: list[Feature], srid: int, buffer: float = 0.0) -> Limit:
        kernel.register(spark)
        plain = [bytearray(polygon_wkb(f.rings)) for f in features]
        row = spark.createDataFrame([(plain, [bytearray(polygon_wkb(f.rings, mover(srid))) for f in features])], "a array<binary>, b array<binary>")
        union = bytes(row.select(F.call_function("geo_union", "b")).first()[0])
        buffered = bbox = None
        if buffer:
            grown = row.select(F.explode("a").alias("g")).select(kernel.call("ST_Buffer", kernel.call("ST_SimplifyPreserveTopology", "g", F.lit(OUTLINE)), F.lit(buffer)).alias("g"))
            out = grown.agg(F.collect_list("g").alias("g")).select(kernel.call("ST_SimplifyPreserveTopology", kernel.call("geo_union", "g"), F.lit(UNION_OUTLINE)).alias("g"))
            buffered, bbox = out.select("g", kernel.call("geo_bounds", "g")).first()
            buffered, bbox = bytes(buffered), tuple(bbox)
        return Limit(hashlib.md5(union).hexdigest(), union, srid, buffered, bbox)

    def near(self, nodes: DataFrame) -> DataFrame:
        """Nodes in the buffered area: the box first, which Parquet can prune by, then the outline."""
        if self.buffered is None:
            return nodes
        x0, y0, x1, y1 = self.bbox
        hits = kernel.call("geo_hits", kernel.point(F.col("lon"), F.col("lat")), F.lit(self.name + "-near"), F.array(F.lit(bytearray(self.buffered))))
        return nodes.where(F.col("lon").between(x0, x1) & F.col("lat").between(y0, y1)).where(F.size(hits) > 0)

    def parts(self, geometry: Column) -> Column:
        """The parts of a geometry inside the area, of the geometry's own kind: none, the whole, or several."""
        return kernel.call("geo_clip", geometry, F.lit(self.name), F.lit(bytearray(self.wkb)), F.lit(LEAST_CELL[self.srid]))


