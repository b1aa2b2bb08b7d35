"""Ranks within groups of any size, by counts of hash buckets: no group has to fit one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_within(df: DataFrame, group: list[str], order: Column, rows: int, name: str = "rank", per_bucket: int = 2048) -> DataFrame:
    """Add `name` (0-based) of each row among the rows of its group, ordered by the text `order`, a hex digest.

    `rows` is the number of rows of df, or a bound. Rows are numbered within (group, first hex digits) and the
    numbers shifted by the sizes of the buckets before, summed in two steps of digits. Equal digests are equal
    rows to this order and get ranks in any order. Null groups are groups.
    """
    digits = max(2, math.ceil(math.log(max(rows, 1) / per_bucket + 1, 16)))
    half = digits // 2
    df = df.withColumn("_o", order).withColumn("_b", F.substring("_o", 1, digits))
    same = [F.col(g) for g in group]
    sizes = df.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_c"))
    upper = sizes.groupBy(*group, F.substring("_b", 1, half).alias("_u")).agg(F.sum("_c").alias("_s"))
    before = Window.partitionBy(*same).orderBy("_u").rowsBetween(Window.unboundedPreceding, -1)
    upper = upper.withColumn("_x", F.coalesce(F.sum("_s").over(before), F.lit(0))).drop("_s")
    before = Window.partitionBy(*same, "_u").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_u", F.substring("_b", 1, half)).withColumn("_y", F.coalesce(F.sum("_c").over(before), F.lit(0)))

    def join(a: DataFrame, b: DataFrame, extra: str) -> DataFrame:
        b = b.select(*[F.col(c).alias(f"_r{c}") for c in [*group, extra]], *[c for c in b.columns if c not in group and c != extra])
        on = a[extra] == b[f"_r{extra}"]
        for g in group:
            on = on & a[g].eqNullSafe(b[f"_r{g}"])
        return a.join(b, on).drop(*[f"_r{c}" for c in [*group, extra]])

    offsets = join(sizes.drop("_c"), upper, "_u").select(*group, "_b", (F.col("_x") + F.col("_y")).alias("_z"))
    numbered = df.withColumn("_n", F.row_number().over(Window.partitionBy(*same, F.col("_b")).orderBy("_o")))
    return join(numbered, offsets, "_b").withColumn(name, F.col("_z") + F.col("_n") - 1).drop("_o", "_b", "_n", "_z")
