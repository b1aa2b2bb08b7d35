"""Column types of the mapping language: each builds an expression from an element's tags, match and geometry."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import kernel
from .geometry import web_mercator_scale

if TYPE_CHECKING:
    from ..plans.mapping import ColumnDef

INT_MIN, INT_MAX = -(2**31), 2**31 - 1
LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1
#: Z-order ranks of road classes, and of railways that are none of them.
ROAD_RANKS = {
    "minor": 3, "road": 3, "unclassified": 3, "residential": 3, "tertiary_link": 3, "tertiary": 4, "secondary_link": 3,
    "secondary": 5, "primary_link": 3, "primary": 6, "trunk_link": 3, "trunk": 8, "motorway_link": 3, "motorway": 9,
}
RAILWAY_RANK, DEFAULT_STEP = 7, 10
#: Tag values that mean no, and those that mean yes where a yes is asked for.
NO_VALUES, YES_VALUES = ("", "0", "false", "no"), ("true", "yes", "1")


@dataclass(frozen=True)
class Row:
    """What a column can be made from. member_* are null outside relation_member tables; features serves the GeoJSON types."""

    tags: Column
    key: Column
    value: Column
    id: Column
    geometry: Column
    member_type: Column | None = None
    member_role: Column | None = None
    member_id: Column | None = None
    member_index: Column | None = None
    features: Callable[[str], tuple[str, Column, list[dict[str, str]]]] | None = None

    def tag(self, key: str) -> Column:
        return F.try_element_at(self.tags, F.lit(key))


@dataclass(frozen=True)
class ColumnType:
    make: Callable[[ColumnDef, Row], Column]
    spark: str
    of_member: bool = False  # made from the member itself, never from the relation


def _arg_list(c: ColumnDef, name: str) -> list[str]:
    v = c.args.last(name)
    if not isinstance(v, list) or not all(isinstance(x, str) for x in v):
        raise ValueError(f"column {c.name}: args need a list of strings {name!r}")
    return v


def ranks_of(names: list[str]) -> dict[str, int]:
    """1-based places; the last one counts for a repeated name."""
    return {n: i + 1 for i, n in enumerate(names)}


def choose(value: Column, table: dict[str, int], default: Column) -> Column:
    """Look a value up in a fixed table."""
    if not table:
        return default
    pairs = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, F.coalesce(value, F.lit(""))), default)


def truth(value: Column) -> Column:
    """False for a missing tag and the values that mean no; everything else is true."""
    return ~F.coalesce(value, F.lit("")).isin(*NO_VALUES)


def integer(value: Column) -> Column:
    """A base-10 number with an optional sign that fits 32 bits, or null."""
    return F.when(F.coalesce(value, F.lit("")).rlike("^[+-]?[0-9]+$"), value.try_cast("int"))


def saturated(value: Column, bits: int) -> Column:
    """A number cut off at the ends of its type; 0 for what is no number."""
    low, high = -(2 ** (bits - 1)), 2 ** (bits - 1) - 1
    v = F.coalesce(value, F.lit(""))
    number = F.when(F.length(v) <= 38, v.try_cast("decimal(38,0)"))
    huge = F.when(v.startswith("-"), F.lit(low)).otherwise(F.lit(high)).cast("decimal(38,0)")
    inside = F.greatest(F.lit(low).cast("decimal(38,0)"), F.least(F.lit(high).cast("decimal(38,0)"), F.coalesce(number, huge)))
    return F.when(v.rlike("^[+-]?[0-9]+$"), inside).otherwise(F.lit(0).cast("decimal(38,0)"))


def direction(value: Column) -> Column:
    return F.when(value.isin("1", "yes", "true"), 1).when(value == "-1", -1).otherwise(0).cast("short")


def z_order(tags: Callable[[str], Column], rank: Column, step: int, bits: int) -> Column:
    """Layer and rank, one step down for tunnels and up for bridges; null when it does not fit 32 bits."""
    yes = lambda k: F.when(tags(k).isin(*YES_VALUES), F.lit(step)).otherwise(F.lit(0))
    z = saturated(tags("layer"), bits) * step + rank - yes("tunnel") + yes("bridge")
    return F.when(z.between(INT_MIN, INT_MAX), z.try_cast("int"))


def _wayzorder(c: ColumnDef, r: Row) -> Column:
    if c.args.last("ranks") is None:
        road = choose(r.value, ROAD_RANKS, F.lit(0))
        rank = F.when((road == 0) & r.tag("railway").isNotNull(), F.lit(RAILWAY_RANK)).otherwise(road)
        return z_order(r.tag, rank, DEFAULT_STEP, 64)
    ranks = ranks_of(_arg_list(c, "ranks"))
    default = c.args.last("default", 0)
    # Only a default with a decimal point counts.
    return z_order(r.tag, choose(r.value, ranks, F.lit(int(default) if isinstance(default, float) else 0)), len(ranks), 32)


def _zorder(c: ColumnDef, r: Row) -> Column:
    names, key = _arg_list(c, "ranks"), c.args.last("key", "")
    ranks = {n: len(names) - i for i, n in enumerate(names)}
    return choose(r.tag(key) if key else r.value, ranks, F.lit(0)).cast("int")


def _enumerate(c: ColumnDef, r: Row) -> Column:
    return choose(r.tag(c.key) if c.key else r.value, ranks_of(_arg_list(c, "values")), F.lit(0)).cast("int")


def _categorize(c: ColumnDef, r: Row) -> Column:
    values, default = c.args.last("values"), c.args.last("default")
    if values is None or not isinstance(default, int) or isinstance(default, bool):
        raise ValueError(f"column {c.name}: categorize_int needs values and an integer default")
    table = {str(k): int(v) for k, v in values}
    out = [choose(r.tag(k), table, F.lit(None).cast("int")) for k in (*((c.key,) if c.key else ()), *c.keys)]
    return F.coalesce(*out, F.lit(default)).cast("int")


def suffix_replace(value: Column, changes: dict[str, str]) -> Column:
    """Replace each listed suffix at a word's end, in one pass from the left; of suffixes that start alike the longest wins.

    The text is cut at every hit and put together again, so that a replacement is never searched for hits.
    """
    names = sorted(changes, key=lambda s: (-len(s), s))
    any_ = "(?:" + "|".join(re.escape(n) for n in names) + ")(?![0-9A-Za-z_])"
    v = F.coalesce(value, F.lit(""))
    between = F.split(v, any_, -1)
    hits = F.regexp_extract_all(v, F.lit(f"({any_})"), F.lit(1))
    table = F.create_map(*[F.lit(x) for kv in changes.items() for x in kv])
    new = F.transform(hits, lambda h: F.coalesce(F.try_element_at(table, h), h))
    joined = F.array_join(F.flatten(F.zip_with(between, new, lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    return F.when(v == "", v).otherwise(joined)


def _suffixreplace(c: ColumnDef, r: Row) -> Column:
    changes = c.args.last("suffixes")
    if not changes or not all(isinstance(x, str) for kv in changes for x in kv):
        raise ValueError(f"column {c.name}: args need a dictionary of strings 'suffixes'")
    return suffix_replace(r.tag(c.key), dict(changes))


def hstore(tags: Column, include: list[str] | None = None) -> Column:
    """Tags in hstore notation, ordered by key."""
    kept = F.map_filter(tags, lambda k, _: k.isin(*include)) if include is not None else tags
    quote = lambda s: F.concat(F.lit('"'), F.replace(F.replace(s, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    return F.array_join(F.transform(F.array_sort(F.map_entries(kept)), lambda e: F.concat(quote(e["key"]), F.lit("=>"), quote(e["value"]))), ", ")


def _hstore(c: ColumnDef, r: Row) -> Column:
    return hstore(r.tags, _arg_list(c, "include") if c.args.last("include") is not None else None)


def _area(_: ColumnDef, r: Row) -> Column:
    return F.nullif(kernel.area(r.geometry), F.lit(0.0)).cast("float")


def _webmerc_area(_: ColumnDef, r: Row) -> Column:
    b = kernel.bounds(r.geometry)
    return (F.nullif(kernel.area(r.geometry), F.lit(0.0)) * web_mercator_scale(F.get(b, F.lit(1)), F.get(b, F.lit(3)))).cast("float")


def _feature_hits(c: ColumnDef, r: Row) -> tuple[Column, list[dict[str, str]]]:
    path = c.args.last("geojson")
    if not path or r.features is None:
        raise ValueError(f"column {c.name}: args need the path 'geojson'")
    name, wkbs, properties = r.features(path)
    return F.call_function("geo_hits", r.geometry, F.lit(name), wkbs), properties


def _intersects(c: ColumnDef, r: Row) -> Column:
    return F.size(_feature_hits(c, r)[0]) > 0


def _intersects_feature(c: ColumnDef, r: Row) -> Column:
    hits, properties = _feature_hits(c, r)
    key = c.args.last("property")
    if not key:
        raise ValueError(f"column {c.name}: args need the name 'property'")
    values = F.array(*[F.lit(p.get(key)).cast("string") for p in properties])
    return F.get(F.array_compact(F.transform(hits, lambda i: F.get(values, i))), F.lit(0))


def _member(name: str) -> Callable[[ColumnDef, Row], Column]:
    def make(_: ColumnDef, r: Row) -> Column:
        out = getattr(r, name)
        return F.lit(None) if out is None else out

    return make


_GEOMETRY = ColumnType(lambda c, r: r.geometry, "binary")
#: The closed registry of column types.
COLUMN_TYPES: dict[str, ColumnType] = {
    "bool": ColumnType(lambda c, r: truth(r.tag(c.key)), "boolean"),
    "boolint": ColumnType(lambda c, r: truth(r.tag(c.key)).cast("short"), "short"),
    "id": ColumnType(lambda c, r: r.id, "long"),
    "string": ColumnType(lambda c, r: F.coalesce(r.tag(c.key), F.lit("")), "string"),
    "direction": ColumnType(lambda c, r: direction(r.tag(c.key)), "short"),
    "integer": ColumnType(lambda c, r: integer(r.tag(c.key)), "int"),
    "mapping_key": ColumnType(lambda c, r: r.key, "string"),
    "mapping_value": ColumnType(lambda c, r: r.value, "string"),
    "member_id": ColumnType(_member("member_id"), "long", True),
    "member_role": ColumnType(_member("member_role"), "string", True),
    "member_type": ColumnType(_member("member_type"), "short", True),
    "member_index": ColumnType(_member("member_index"), "int", True),
    "geometry": _GEOMETRY,
    "validated_geometry": _GEOMETRY,
    "hstore_tags": ColumnType(_hstore, "string"),
    "wayzorder": ColumnType(_wayzorder, "int"),
    "pseudoarea": ColumnType(_area, "float"),
    "area": ColumnType(_area, "float"),
    "webmerc_area": ColumnType(_webmerc_area, "float"),
    "zorder": ColumnType(_zorder, "int"),
    "enumerate": ColumnType(_enumerate, "int"),
    "string_suffixreplace": ColumnType(_suffixreplace, "string"),
    "categorize_int": ColumnType(_categorize, "int"),
    "geojson_intersects": ColumnType(_intersects, "boolean"),
    "geojson_intersects_feature": ColumnType(_intersects_feature, "string"),
}


def build(c: ColumnDef, row: Row) -> Column:
    kind = COLUMN_TYPES[c.type]
    return kind.make(c, row).cast(kind.spark).alias(c.name)
