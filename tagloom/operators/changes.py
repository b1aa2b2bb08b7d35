"""Applying changes: new element tables, the closure of affected elements, and the rows that replace theirs.

Only affected elements are matched and resolved again. Their closure is nodes to ways, nodes and ways to relations,
and relations to the relations that have them as members; it comes from the old and the new element tables, so the
result is the same as building everything anew.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import quantize
from ..functions.tiles import geometry_tiles, point_tiles
from ..plans import compiler
from ..plans.mapping import Mapping
from . import resolve
from .generalize import base_table, build_order, generalize_one
from .limit import Limit
from .tables import Elements, TableBuilder


def set_add(ids: Column, more: Column) -> Column:
    """An ordered set of ids with some more."""
    return F.array_sort(F.array_union(ids, more))


def set_remove(ids: Column, gone: Column) -> Column:
    """An ordered set of ids without some."""
    return F.array_sort(F.array_except(ids, gone))


def last_changes(changes: DataFrame) -> DataFrame:
    """The last change of each element by (seq, ord); the states in between are never seen."""
    w = Window.partitionBy("kind", "id").orderBy(F.desc("seq"), F.desc("ord"))
    return changes.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def after_sequence(changes: DataFrame, last_seq: int | None, force: bool = False) -> DataFrame:
    """Changes not applied yet; without a state, or by force, all of them."""
    return changes if last_seq is None or force else changes.where(F.col("seq") > last_seq)


def update_elements(old: Elements, changes: DataFrame, mapping: Mapping, limit: Limit | None = None, quantized: bool = False) -> Elements:
    """Element tables after changes (one for each element). Places of changed nodes stay exact unless quantized.

    A changed node without tags keeps its place alone. Ways and relations whose first reference is unknown are not taken in.
    """
    put = changes.where("action <> 'delete'")
    gone = lambda kind: changes.where(F.col("kind") == kind).select("id")
    at = [F.col("id"), *[(quantize(F.col(c)) if quantized else F.col(c)).alias(c) for c in ("lon", "lat")]]
    n = put.where("kind = 'node' and lon is not null and lat is not null")
    if limit is not None:
        n = limit.near(n)
    tags = lambda kind: F.coalesce(compiler.tag_filter(mapping, kind), F.expr("cast(map() as map<string,string>)")).alias("tags")
    n = n.select(*at, tags("node"))
    coords = old.coords.join(gone("node"), "id", "left_anti").unionByName(n.drop("tags"))
    nodes = old.nodes.join(gone("node"), "id", "left_anti").unionByName(n.where(F.size("tags") > 0))
    w = resolve.keep_by_first_ref(put.where("kind = 'way'").select("id", "refs", tags("way")), coords)
    ways = old.ways.join(gone("way"), "id", "left_anti").unionByName(w)
    r = put.where("kind = 'relation'").select("id", "members", tags("relation")).where(F.size("tags") > 0)
    r = resolve.keep_by_first_member(r, coords, ways)
    relations = old.relations.join(gone("relation"), "id", "left_anti").unionByName(r)
    return Elements(nodes, ways, relations, coords)


def affected(old: Elements, new: Elements, changes: DataFrame, deletes_cascade: bool = True) -> dict[str, DataFrame]:
    """Ids of the elements whose rows may change, by kind.

    With deletes_cascade=False only created and modified elements reach those that refer to them, so the rows
    of what refers to a deleted element stay until it is changed itself.
    """
    ids = lambda kind, d: d.where(F.col("kind") == kind).select("id")
    spread = changes if deletes_cascade else changes.where("action <> 'delete'")
    a, b = resolve.reverse_refs(old.ways, old.relations), resolve.reverse_refs(new.ways, new.relations)

    def up(name: str, key: str, to: str, start: DataFrame) -> DataFrame:
        both = a[name].union(b[name])
        return both.join(start.withColumnRenamed("id", key), key, "left_semi").select(F.col(to).alias("id"))

    nodes = ids("node", changes)
    ways = ids("way", changes).union(up("coord_ways", "node_id", "way_id", ids("node", spread))).distinct()
    moved = ids("way", spread).union(up("coord_ways", "node_id", "way_id", ids("node", spread))).distinct()
    relations = ids("relation", changes).union(up("coord_rels", "node_id", "rel_id", ids("node", spread))).union(up("way_rels", "way_id", "rel_id", moved))
    parents = lambda e: resolve.members_of(e.relations, 2).select(F.col("ref").alias("m"), F.col("rel").alias("id"))
    above = parents(old).union(parents(new)).join(ids("relation", spread).withColumnRenamed("id", "m"), "m", "left_semi").select("id")
    return {"node": nodes.distinct(), "way": ways, "relation": relations.union(above).distinct()}


def only(e: Elements, ids: dict[str, DataFrame]) -> Elements:
    """The given elements to build rows for; references are still resolved among all of them."""
    return Elements(e.nodes.join(ids["node"], "id", "left_semi"), e.ways.join(ids["way"], "id", "left_semi"), e.relations.join(ids["relation"], "id", "left_semi"), e.coords)


def build_rows(builder: TableBuilder, full: Elements, ids: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Rows of the given elements."""
    part = only(full, ids)
    b = replace(builder, origin=True)
    out: dict[str, list[DataFrame]] = {}
    add = lambda made: [out.setdefault(k, []).append(v) for k, v in made.items()]
    add(b.node_rows(part))
    for name, dfs in b.way_rows(part).items():
        out.setdefault(name, []).extend(dfs)
    rels = Elements(full.nodes, full.ways, part.relations, full.coords)
    if b.numbers("polygon"):
        from .tables import relation_id

        add(b.split(b.clipped(b.polygon_relations(rels)), "polygon", relation_id(b.mapping, F.col("id")), "relation"))
    if b.numbers("relation"):
        add(b.relation_rows(rels))
    if b.numbers("relation_member"):
        add(b.member_rows(full, part.relations))
    return {name: b._union(t, out.get(name, [])) for name, t in b.mapping.tables.items()}


def replace_rows(old: DataFrame, fresh: DataFrame, ids: dict[str, DataFrame]) -> DataFrame:
    """A table without the rows of some elements, and with the new ones. Rows are told apart by kind and id, as a node
    and a way may share an id."""
    gone = None
    for kind, d in ids.items():
        x = d.select(F.lit(kind).alias("_kind"), F.col("id").alias("_eid"))
        gone = x if gone is None else gone.union(x)
    return old.join(gone, ["_kind", "_eid"], "left_anti").unionByName(fresh)


def stale_tiles(builder: TableBuilder, e: Elements, ids: dict[str, DataFrame], max_zoom: int = 14) -> DataFrame:
    """Tiles (z, x, y) of the rows that the given elements have: points, lines, areas, and the ways of relations."""
    part, zoom = only(e, ids), F.lit(max_zoom)
    none = builder.spark.createDataFrame([], "z int, x int, y int")
    out = none
    n = builder.matched(part.nodes, "point", F.lit(False), False).select("id", "lon", "lat").distinct()
    out = out.union(n.select(F.explode(point_tiles(F.col("lon"), F.col("lat"), zoom)).alias("t")).select("t.*"))
    for kind, closed in (("linestring", False), ("polygon", True)):
        if builder.numbers(kind):
            w = builder.way_geometries(part, kind).select("id", "points").dropDuplicates(["id"])
            out = out.union(w.select(F.explode(geometry_tiles(F.col("points"), F.lit(closed), max_zoom)).alias("t")).select("t.*"))
    if builder.numbers("polygon"):
        r = builder.polygon_relations(Elements(e.nodes, e.ways, part.relations, e.coords)).select("id", "parts").dropDuplicates(["id"])
        ways = r.select(F.explode("parts").alias("p")).select("p.points")
        out = out.union(ways.select(F.explode(geometry_tiles(F.col("points"), F.lit(True), max_zoom)).alias("t")).select("t.*"))
    return out.distinct()


@dataclass
class State:
    """Element tables, table rows (with origins) and the last sequence."""

    elements: Elements
    tables: dict[str, DataFrame]
    last_seq: int | None = None


def with_generalized(mapping: Mapping, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Rows of tables and the generalised rows made from them. These come row by row from their source and keep its
    origins, so the rows of some elements are replaced in them as in any other table."""
    out = dict(tables)
    for g in build_order(mapping):
        out[g.name] = generalize_one(out[g.source], base_table(mapping, g.name), g)
    return out


def initial_state(builder: TableBuilder, elements: Elements) -> State:
    return State(elements, with_generalized(builder.mapping, replace(builder, origin=True).build(elements)))


def keep(name: str, df: DataFrame) -> DataFrame:
    """Hold a step's result in the executors' memory and disk, for states that are not stored."""
    return df.persist()


def apply_changes(builder: TableBuilder, state: State, changes: DataFrame, force: bool = False, quantized: bool = False, deletes_cascade: bool = True, cut: Callable[[str, DataFrame], DataFrame] = keep) -> tuple[State, dict[str, DataFrame]]:
    """The state after changes, and the affected ids by kind. Sequences up to the state's last are skipped.

    cut(name, df) holds what later steps read several times: the changes, the new element tables and the ids.
    """
    c = cut("changes", last_changes(after_sequence(changes, state.last_seq, force)))
    e = update_elements(state.elements, c, builder.mapping, builder.limit, quantized)
    coords, nodes = cut("coords", e.coords), cut("nodes", e.nodes)
    new = Elements(nodes, cut("ways", e.ways), cut("relations", e.relations), coords)
    ids = {kind: cut(f"ids_{kind}", d) for kind, d in affected(state.elements, new, c, deletes_cascade).items()}
    fresh = with_generalized(builder.mapping, build_rows(builder, new, ids))
    tables = {name: replace_rows(df, fresh[name], ids) for name, df in state.tables.items()}
    seq = changes.agg(F.max("seq")).first()[0]
    last = max((s for s in (seq, state.last_seq) if s is not None), default=None)
    return State(new, tables, last), ids
