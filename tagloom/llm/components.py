"""Connected components of a link table by alternating large-star and small-star steps, on the executors only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, forget


def _smallest(edges: DataFrame) -> DataFrame:
    """For each node u of directed edges (u, v): the smallest of u and its v."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def components(spark: SparkSession, links: DataFrame, limit: int = 60) -> DataFrame:
    """links (a, b) of any orderable type to rows (node, component), component being the least node reachable.

    Self links and repeated links are allowed; null ends are ignored. Nodes without a link do not appear.
    A hub's links are never gathered: its least neighbour is a partial aggregate and is joined back.
    """
    e = links.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    e = cut(spark, e.distinct(), "links")
    seen = None
    for _ in range(limit):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: every larger neighbour of u is linked to the least of u's neighbourhood.
        big = both.join(_smallest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        big = big.where("u <> v").distinct()
        # Small star: u and its smaller neighbours are linked to the least of them.
        least = big.groupBy("u").agg(F.min("v").alias("m"))
        small = big.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        last, e = e, cut(spark, small.where("u <> v").distinct(), "links")
        forget(spark, last)
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
