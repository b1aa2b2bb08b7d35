"""Rows of the mapping's tables from elements."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns, kernel
from ..functions.geometry import place
from ..plans import compiler
from ..plans.mapping import ColumnDef, Mapping, TableDef
from ..sources.geojson import parse, polygon_wkb, read_text
from . import resolve
from .limit import Limit, mover

#: Offset of relation ids in the single id space; widest gap that closes a ring, by reference system.
RELATION_OFFSET = -(10**17)
RING_GAP = {3857: 0.1, 4326: 1e-6}
#: Stores a step under a name and reads it back.
Hold = Callable[[str, DataFrame], DataFrame]
EMPTY_POLYGON = bytes([1, 3, 0, 0, 0, 0, 0, 0, 0])


def way_id(mapping: Mapping, id_: Column) -> Column:
    return -id_ if mapping.single_id_space else id_


def relation_id(mapping: Mapping, id_: Column) -> Column:
    return F.lit(RELATION_OFFSET) - id_ if mapping.single_id_space else -id_


@dataclass
class Elements:
    """Tables of elements. coords has every node's place; nodes only those with tags, as far as they are kept."""

    nodes: DataFrame
    ways: DataFrame
    relations: DataFrame
    coords: DataFrame | None = None

    def __post_init__(self):
        if self.coords is None:
            self.coords = self.nodes.select("id", "lon", "lat")

    def map(self, f) -> Elements:
        return Elements(f(self.nodes), f(self.ways), f(self.relations), f(self.coords))


def prepare(elements: Elements, mapping: Mapping, limit: Limit | None = None, quantized: bool = True) -> Elements:
    """What reading keeps: filtered tags, places in storage precision, elements near the limit.

    Every place is kept; nodes and relations only with tags left; ways always, as relations need them.
    """
    from ..functions.geometry import quantize

    at = [F.col("id"), *[(quantize(F.col(c)) if quantized else F.col(c)).alias(c) for c in ("lon", "lat")]]
    nodes = elements.nodes if limit is None else limit.near(elements.nodes)
    coords = elements.coords.select(*at) if limit is None else limit.near(elements.coords).select(*at)
    tags = lambda kind: compiler.tag_filter(mapping, kind).alias("tags")
    kept_nodes = nodes.select(*at, tags("node")).where(F.size("tags") > 0)
    ways = elements.ways.select("id", "refs", tags("way"))
    relations = elements.relations.select("id", "members", tags("relation")).where(F.size("tags") > 0)
    if limit is not None and limit.buffered is not None:
        ways = resolve.keep_by_first_ref(ways, coords)
        relations = resolve.keep_by_first_member(relations, coords, ways)
    return Elements(kept_nodes, ways, relations, coords)


@dataclass
class TableBuilder:
    """Builds rows for one mapping. Matches are made before any join, so only matched elements are resolved."""

    spark: SparkSession
    mapping: Mapping
    srid: int = 3857
    limit: Limit | None = None
    origin: bool = False  # add _kind and _eid, the element that a row comes from
    _features: dict = field(default_factory=dict)

    def __post_init__(self):
        kernel.register(self.spark)

    # --- shared parts ---

    def features(self, path: str) -> tuple[str, Column, list[dict[str, str]]]:
        """A GeoJSON file for the geojson column types, always in web mercator."""
        if path not in self._features:
            found = parse(read_text(self.spark, path))
            wkbs = [polygon_wkb(f.rings, mover(3857)) for f in found]
            name = hashlib.md5(b"".join(wkbs)).hexdigest()
            self._features[path] = (name, F.array(*[F.lit(bytearray(w)) for w in wkbs]), [f.properties for f in found])
        return self._features[path]

    def matched(self, df: DataFrame, kind: str, closed: Column, relation: bool, admit: Column | None = None) -> DataFrame:
        """Add one row for each destination: dest (its number), key and value of the match."""
        dests = compiler.destinations(self.mapping, kind, F.col("tags"), closed, relation)
        if not dests:
            return df.where("false").withColumns({"dest": F.lit(0), "key": F.lit(""), "value": F.lit("")})
        hits = F.array_compact(F.array(*[F.when(d.match.isNotNull(), F.struct(F.lit(i).alias("dest"), d.match["key"].alias("key"), d.match["value"].alias("value"))) for i, d in enumerate(dests)]))
        df = df.where(F.size("tags") > 0)
        if admit is not None:
            df = df.where(admit)
        return df.withColumn("_m", F.explode(hits)).select(*df.columns, "_m.*")

    def numbers(self, kind: str) -> dict[str, list[int]]:
        """Destination numbers of each table."""
        out: dict[str, list[int]] = {}
        for i, d in enumerate(compiler.destinations(self.mapping, kind, F.col("tags"), F.lit(False), False)):
            out.setdefault(d.table.name, []).append(i)
        return out

    def clipped(self, df: DataFrame, whole: bool = False) -> DataFrame:
        """Rows whose geometry is in the limit: one for each part, or the whole geometry once."""
        if self.limit is None:
            return df
        if whole:
            return df.where(F.size(self.limit.parts(F.col("geometry"))) > 0)
        return df.withColumn("geometry", F.explode(self.limit.parts(F.col("geometry"))))

    def source(self, kind: str, id_: str) -> list[Column]:
        return [F.lit(kind).alias("_kind"), F.col(id_).alias("_eid")] if self.origin else []

    def project(self, df: DataFrame, table: TableDef, id_: Column, element: str) -> DataFrame:
        row = columns.Row(F.col("tags"), F.col("key"), F.col("value"), id_, F.col("geometry"), features=self.features)
        return df.select(*[columns.build(c, row) for c in table.columns], *self.source(element, "id"))

    def split(self, df: DataFrame, kind: str, id_: Column, element: str) -> dict[str, DataFrame]:
        return {name: self.project(df.where(F.col("dest").isin(*n)), self.mapping.tables[name], id_, element) for name, n in self.numbers(kind).items()}

    def _lines(self, points: str) -> tuple[Column, Column]:
        """Projected xs and ys of an array of (lon, lat)."""
        return (
            F.transform(points, lambda p: place(p["x"], p["y"], self.srid)[0]),
            F.transform(points, lambda p: place(p["x"], p["y"], self.srid)[1]),
        )

    # --- pipelines ---

    def node_rows(self, e: Elements) -> dict[str, DataFrame]:
        d = self.matched(e.nodes, "point", F.lit(False), False)
        d = d.withColumn("geometry", kernel.point(*place(F.col("lon"), F.col("lat"), self.srid)))
        return self.split(self.clipped(d, whole=True), "point", F.col("id"), "node")

    def matched_ways(self, e: Elements, kind: str) -> DataFrame:
        closed = compiler.is_closed(F.col("refs"))
        return self.matched(e.ways, kind, closed, False, compiler.way_admits(kind, F.col("tags"), closed))

    def filled_ways(self, e: Elements) -> DataFrame:
        """All ways that some table needs, as a row of its own or as a member, with their places: resolved once for all."""
        ids = [self.matched_ways(e, kind).select("id") for kind in ("linestring", "polygon") if self.numbers(kind)]
        for kind in ("polygon", "relation", "relation_member"):
            if self.numbers(kind):
                ids.append(resolve.member_ids(self.matched(e.relations, kind, F.lit(True), True).select("id", "members").dropDuplicates(["id"])))
        wanted = reduce(DataFrame.union, ids, e.ways.select("id").where("false")).distinct()
        return resolve.fill_ways(e.ways.join(wanted, "id", "left_semi"), e.coords)

    def way_geometries(self, e: Elements, kind: str, filled: DataFrame | None = None) -> DataFrame:
        d = self.matched_ways(e, kind)
        # Each way is resolved once, however many tables it goes to.
        if filled is None:
            filled = resolve.fill_ways(d.select("id", "refs").dropDuplicates(["id"]), e.coords)
        xs, ys = self._lines("points")
        make = kernel.line if kind == "linestring" else kernel.polygon
        shapes = filled.select("id", "points", make(xs, ys).alias("geometry")).where("geometry is not null")
        return d.join(shapes, "id")

    def way_rows(self, e: Elements, filled: DataFrame | None = None, hold: Hold = lambda name, df: df) -> dict[str, list[DataFrame]]:
        out: dict[str, list[DataFrame]] = {}
        for kind in ("linestring", "polygon"):
            if self.numbers(kind):
                for name, df in self.split(hold(kind, self.clipped(self.way_geometries(e, kind, filled))), kind, way_id(self.mapping, F.col("id")), "way").items():
                    out.setdefault(name, []).append(df)
        return out

    def polygon_relations(self, e: Elements, filled: DataFrame | None = None) -> DataFrame:
        d = self.matched(e.relations, "polygon", F.lit(True), True)
        full = resolve.fill_relations(d.select("id", "members").dropDuplicates(["id"]), e.ways, e.coords, filled)
        move = lambda p: place(p["x"], p["y"], self.srid)
        ways = F.transform("parts", lambda w: F.struct(w["refs"], F.transform(w["points"], lambda p: move(p)[0]), F.transform(w["points"], lambda p: move(p)[1])))
        shapes = full.select("id", "parts", kernel.multipolygon(ways, F.lit(RING_GAP[self.srid])).alias("geometry")).where("geometry is not null")
        return d.join(shapes, "id")

    def relation_rows(self, e: Elements, filled: DataFrame | None = None) -> dict[str, DataFrame]:
        d = self.matched(e.relations, "relation", F.lit(True), True)
        full = resolve.fill_relations(d.select("id", "members").dropDuplicates(["id"]), e.ways, e.coords, filled).select("id")
        return self.split(d.join(full, "id", "left_semi").withColumn("geometry", F.lit(None).cast("binary")), "relation", relation_id(self.mapping, F.col("id")), "relation")

    def member_rows(self, e: Elements, relations: DataFrame | None = None, filled: DataFrame | None = None) -> dict[str, DataFrame]:
        """Rows of e's relations, or of some of them; member relations are looked up among all."""
        d = self.matched(e.relations if relations is None else relations, "relation_member", F.lit(True), True)
        wanted = e.relations.join(d.select("id").distinct(), "id", "left_semi")
        rows = resolve.member_rows(wanted, e.relations, e.nodes, e.ways, e.coords, filled)
        x, y = place(F.col("lon"), F.col("lat"), self.srid)
        xs, ys = self._lines("points")
        geometry = F.when(F.col("type") == 0, kernel.point(x, y)).when(F.col("type") == 1, kernel.line(xs, ys)).otherwise(F.lit(bytearray(EMPTY_POLYGON)))
        rows = rows.withColumn("geometry", geometry)
        # One member without a geometry drops the relation.
        bad = rows.where("geometry is null").select("rel").distinct()
        rows = rows.join(bad, "rel", "left_anti")
        j = d.select(F.col("id").alias("rel"), "tags", "dest", "key", "value").join(rows, "rel")
        out = {}
        for name, n in self.numbers("relation_member").items():
            table = self.mapping.tables[name]
            out[name] = j.where(F.col("dest").isin(*n)).select(*[self._member_column(c) for c in table.columns], *self.source("relation", "rel"))
        return out

    def _member_column(self, c: ColumnDef) -> Column:
        member = dict(member_type=F.col("type"), member_role=F.col("role"), member_id=F.col("ref"), member_index=F.col("pos"))
        of = lambda tags, id_: columns.Row(F.col(tags), F.col("key"), F.col("value"), id_, F.col("geometry"), features=self.features, **member)
        if c.from_member:
            made = columns.build(c, of("member_tags", F.col("ref")))
            return F.when(F.col("member_tags").isNotNull() | F.lit(c.type == "geometry"), made).alias(c.name)
        return columns.build(c, of("tags", relation_id(self.mapping, F.col("rel"))))

    def build(self, elements: Elements, hold: Hold | None = None) -> dict[str, DataFrame]:
        """All tables of the mapping; a table that several kinds of elements feed is their union.

        hold(name, df) stores a step that several tables read and gives back what was stored: the ways with their places,
        which are then resolved once for all tables, and the geometries by kind.
        """
        parts: dict[str, list[DataFrame]] = {name: [] for name in self.mapping.tables}
        filled, held = None, hold or (lambda name, df: df)
        if hold and any(self.numbers(k) for k in ("linestring", "polygon", "relation", "relation_member")):
            filled = hold("ways", self.filled_ways(elements))
        for name, df in self.node_rows(elements).items():
            parts[name].append(df)
        for name, dfs in self.way_rows(elements, filled, held).items():
            parts[name] += dfs
        if self.numbers("polygon"):
            d = held("multipolygon", self.clipped(self.polygon_relations(elements, filled)))
            for name, df in self.split(d, "polygon", relation_id(self.mapping, F.col("id")), "relation").items():
                parts[name].append(df)
        if self.numbers("relation"):
            for name, df in self.relation_rows(elements, filled).items():
                parts[name].append(df)
        if self.numbers("relation_member"):
            for name, df in self.member_rows(elements, None, filled).items():
                parts[name].append(df)
        return {name: self._union(self.mapping.tables[name], dfs) for name, dfs in parts.items()}

    def _union(self, table: TableDef, dfs: list[DataFrame]) -> DataFrame:
        if not dfs:
            schema = ", ".join([f"`{c.name}` {columns.COLUMN_TYPES[c.type].spark}" for c in table.columns] + ["_kind string", "_eid bigint"] * self.origin)
            return self.spark.createDataFrame([], schema)
        out = dfs[0]
        for d in dfs[1:]:
            out = out.unionByName(d)
        return out
