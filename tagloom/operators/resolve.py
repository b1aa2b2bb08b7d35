"""Reference resolution by joins. All or nothing: an element with a missing reference is dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fill_ways(ways: DataFrame, coords: DataFrame) -> DataFrame:
    """Add `points`, array of (x = lon, y = lat) in the order of refs, to ways whose every ref is in coords.

    One shuffle by node id and one by way id; only ids and places travel. Ways without refs are dropped.
    """
    refs = ways.select("id", F.posexplode("refs").alias("pos", "ref"))
    c = coords.select(F.col("id").alias("ref"), "lon", "lat")
    found = refs.join(c, "ref").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "lon", "lat"))).alias("p"))
    full = ways.join(found, "id").where(F.size("p") == F.size("refs"))
    return full.withColumn("points", F.transform("p", lambda p: F.struct(p["lon"].alias("x"), p["lat"].alias("y")))).drop("p")


def members_of(relations: DataFrame, kind: int) -> DataFrame:
    """(rel, pos, ref, role) of the members of one type."""
    return relations.select(F.col("id").alias("rel"), F.posexplode("members").alias("pos", "m")).where(F.col("m.type") == kind).select("rel", "pos", "m.ref", "m.role")


def count_members(members: Column, kind: int) -> Column:
    return F.size(F.filter(members, lambda m: m["type"] == kind))


def member_ids(relations: DataFrame) -> DataFrame:
    """(id) of the way members, each once."""
    return members_of(relations, 1).select(F.col("ref").alias("id")).distinct()


def fill_relations(relations: DataFrame, ways: DataFrame, coords: DataFrame, filled: DataFrame | None = None) -> DataFrame:
    """Add `parts`, array of (pos, refs, points, tags) of the way members, to relations whose every way member is complete.

    `filled` are ways that fill_ways() has filled already, all members' ways among them.
    """
    wanted = members_of(relations, 1)
    if filled is None:
        filled = fill_ways(ways.join(member_ids(relations), "id", "left_semi"), coords)
    filled = filled.select("id", "refs", "points")
    parts = wanted.join(filled.withColumnRenamed("id", "ref"), "ref").groupBy("rel").agg(F.array_sort(F.collect_list(F.struct("pos", "refs", "points"))).alias("parts"))
    full = relations.join(parts.withColumnRenamed("rel", "id"), "id", "left")
    kind = "array<struct<pos:int,refs:array<bigint>,points:array<struct<x:double,y:double>>>>"
    full = full.withColumn("parts", F.coalesce("parts", F.expr(f"cast(array() as {kind})")))
    return full.where(F.size("parts") == count_members(F.col("members"), 1))


def member_rows(relations: DataFrame, known: DataFrame, nodes: DataFrame, ways: DataFrame, coords: DataFrame, filled: DataFrame | None = None) -> DataFrame:
    """One row for each member of relations whose every member is known (member relations: in `known`):

    rel, pos, type, ref, role, member_tags, lon, lat (nodes), points (ways). Node members fall back to bare places.
    Member tags are null for a member without stored tags.
    """
    m = relations.select(F.col("id").alias("rel"), F.size("members").alias("n"), F.posexplode("members").alias("pos", "m")).select("rel", "n", "pos", "m.*")
    n = m.where("type = 0").join(coords.select(F.col("id").alias("ref"), "lon", "lat"), "ref").join(nodes.select(F.col("id").alias("ref"), F.col("tags").alias("member_tags")), "ref", "left")
    w = m.where("type = 1")
    if filled is None:
        filled = fill_ways(ways.join(w.select(F.col("ref").alias("id")).distinct(), "id", "left_semi"), coords)
    w = w.join(filled.select(F.col("id").alias("ref"), F.col("tags").alias("member_tags"), "points"), "ref")
    r = m.where("type = 2").join(known.select(F.col("id").alias("ref"), F.col("tags").alias("member_tags")), "ref")
    rows = n.unionByName(w, allowMissingColumns=True).unionByName(r, allowMissingColumns=True)
    complete = rows.groupBy("rel").agg(F.count(F.lit(1)).alias("_have"), F.first("n").alias("_n")).where("_have = _n").select("rel")
    return rows.join(complete, "rel", "left_semi").drop("n")


def reverse_refs(ways: DataFrame, relations: DataFrame) -> dict[str, DataFrame]:
    """Who refers to whom: coord_ways (node_id, way_id), coord_rels (node_id, rel_id), way_rels (way_id, rel_id)."""
    of = lambda kind, name: members_of(relations, kind).select(F.col("ref").alias(name), F.col("rel").alias("rel_id")).distinct()
    return {
        "coord_ways": ways.select(F.explode("refs").alias("node_id"), F.col("id").alias("way_id")).distinct(),
        "coord_rels": of(0, "node_id"),
        "way_rels": of(1, "way_id"),
    }


def keep_by_first_ref(ways: DataFrame, coords: DataFrame) -> DataFrame:
    """Ways whose first ref is known; those without refs are dropped."""
    return ways.join(coords.select(F.col("id").alias("_first")), F.get("refs", F.lit(0)) == F.col("_first"), "left_semi")


def keep_by_first_member(relations: DataFrame, coords: DataFrame, ways: DataFrame) -> DataFrame:
    """Relations whose first node or way member is known, or that have none."""
    first = F.get(F.filter("members", lambda m: m["type"] < 2), F.lit(0))
    known = coords.select(F.lit(0).cast("tinyint").alias("_t"), F.col("id").alias("_i")).union(ways.select(F.lit(1).cast("tinyint").alias("_t"), F.col("id").alias("_i")))
    r = relations.withColumn("_f", first)
    hit = r.where("_f is not null").join(known, (F.col("_f.type") == F.col("_t")) & (F.col("_f.ref") == F.col("_i")), "left_semi")
    return hit.union(r.where("_f is null")).drop("_f")
