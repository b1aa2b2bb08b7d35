"""Elements by id, with what they refer to (full) or what refers to them (deps), as nested JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import resolve
from .tables import Elements


def points(elements: DataFrame, ids: list[int]) -> DataFrame:
    """Elements of some ids; the ids are literals of the filter, so Parquet files are pruned by their least and greatest id."""
    return elements.where(F.col("id").isin(*ids)) if ids else elements.where("false")


def lookup(spark: SparkSession, e: Elements, kind: str, ids: list[int], full: bool = False, deps: bool = False) -> DataFrame:
    """(id, json) for each id asked for; json is null for an unknown element. A node falls back to its bare place."""
    if full and deps:
        raise ValueError("full and deps exclude each other")
    asked = spark.createDataFrame([(i,) for i in ids], "id bigint")
    pack = lambda *cols: F.to_json(F.struct(*cols))
    if kind == "node":
        d = asked.join(e.coords, "id", "left").join(e.nodes.select("id", "tags"), "id", "left")
        cols = ["id", "lon", "lat", "tags"]
        if deps:
            up = resolve.reverse_refs(e.ways, e.relations)
            w = up["coord_ways"].groupBy(F.col("node_id").alias("id")).agg(F.sort_array(F.collect_set("way_id")).alias("ways"))
            r = up["coord_rels"].groupBy(F.col("node_id").alias("id")).agg(F.sort_array(F.collect_set("rel_id")).alias("relations"))
            d, cols = d.join(w, "id", "left").join(r, "id", "left"), [*cols, "ways", "relations"]
        return d.select("id", F.when(F.col("lon").isNotNull(), pack(*cols)).alias("json"))
    if kind == "way":
        d = asked.join(e.ways, "id", "left")
        cols = ["id", "refs", "tags"]
        if full:
            p = asked.join(e.ways, "id").select("id", F.posexplode("refs").alias("pos", "ref")).join(e.coords.withColumnRenamed("id", "ref"), "ref", "left")
            p = p.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", F.col("ref").alias("id"), "lon", "lat"))).alias("nodes"))
            d, cols = d.join(p, "id", "left"), [*cols, "nodes"]
        if deps:
            r = resolve.reverse_refs(e.ways, e.relations)["way_rels"].groupBy(F.col("way_id").alias("id")).agg(F.sort_array(F.collect_set("rel_id")).alias("relations"))
            d, cols = d.join(r, "id", "left"), [*cols, "relations"]
        return d.select("id", F.when(F.col("refs").isNotNull(), pack(*cols)).alias("json"))
    if kind == "relation":
        d = asked.join(e.relations, "id", "left")
        cols = ["id", "members", "tags"]
        if full:
            m = resolve.members_of(asked.join(e.relations, "id"), 1)
            w = m.join(e.ways.withColumnRenamed("id", "ref"), "ref", "left").groupBy(F.col("rel").alias("id")).agg(F.array_sort(F.collect_list(F.struct("pos", F.col("ref").alias("id"), "refs"))).alias("ways"))
            d, cols = d.join(w, "id", "left"), [*cols, "ways"]
        return d.select("id", F.when(F.col("members").isNotNull(), pack(*cols)).alias("json"))
    raise ValueError(f"unknown kind {kind}")
