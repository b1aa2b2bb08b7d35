"""Generalised tables: simplified, filtered copies of tables or of other generalised tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import kernel
from ..plans.mapping import GeneralizedDef, Mapping, MappingError, TableDef


def base_table(mapping: Mapping, name: str) -> TableDef:
    """The table at the end of a generalised table's chain of sources."""
    seen = set()
    while name in mapping.generalized:
        if name in seen:
            raise MappingError(f"generalized table {name} is its own source")
        seen.add(name)
        name = mapping.generalized[name].source
    if name not in mapping.tables:
        raise MappingError(f"missing source {name} for generalized table")
    return mapping.tables[name]


def build_order(mapping: Mapping) -> list[GeneralizedDef]:
    """Sources before what is made of them."""
    depth = {}
    for name in mapping.generalized:
        base_table(mapping, name)
        n, at = 0, name
        while at in mapping.generalized:
            n, at = n + 1, mapping.generalized[at].source
        depth[name] = n
    return [mapping.generalized[n] for n in sorted(depth, key=lambda n: (depth[n], n))]


def spark_filter(sql: str) -> str:
    """Quoted identifiers in Spark's quotes; string literals are left alone."""
    return re.sub(r"'(?:[^']|'')*'|\"([^\"]+)\"", lambda m: f"`{m[1]}`" if m[1] is not None else m[0], sql)


def generalize_one(source: DataFrame, table: TableDef, g: GeneralizedDef) -> DataFrame:
    """Rows of source that the filter accepts, with simplified geometries; all other columns as they are."""
    df = source.where(spark_filter(g.sql_filter)) if g.sql_filter else source
    kinds = {c.name: c.type for c in table.columns if c.type in ("geometry", "validated_geometry")}
    return df.select(*[kernel.generalize(F.col(f"`{c}`"), g.tolerance, kinds[c] == "validated_geometry").alias(c) if c in kinds else F.col(f"`{c}`") for c in df.columns])


def generalize(mapping: Mapping, tables: dict[str, DataFrame], chained: bool = True) -> dict[str, DataFrame]:
    """All generalised tables. With chained=False each is made from its base table at its own tolerance."""
    out = dict(tables)
    for g in build_order(mapping):
        base = base_table(mapping, g.name)
        out[g.name] = generalize_one(out[g.source if chained else base.name], base, g)
    return {g: out[g] for g in mapping.generalized}
