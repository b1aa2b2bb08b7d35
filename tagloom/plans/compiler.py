"""Mapping rules to column expressions: tag filters, first-match routing, and row filters.

Everything here is made of built-in functions over a tags column of type map<string,string>, so it stays within
code generation and never calls Python for a row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .mapping import ANY, Mapping, Rule, TableDef

#: Relation types that a polygon table without relation_types accepts.
MULTIPOLYGON_TYPES = ("multipolygon", "boundary", "land_area")
#: Element kinds that a table type is fed from, for the tag filters.
NODE_KINDS, WAY_KINDS = ("point",), ("linestring", "polygon")
RELATION_KINDS = ("linestring", "polygon", "relation", "relation_member")


def tag(tags: Column, key: str) -> Column:
    return F.try_element_at(tags, F.lit(key))


def isin(value: Column, values) -> Column:
    values = list(dict.fromkeys(values))
    return F.coalesce(value.isin(*values), F.lit(False)) if values else F.lit(False)


# --- tag filters -----------------------------------------------------------------------------------------------


def _wanted(mapping: Mapping, kinds: tuple[str, ...]) -> tuple[set[str], dict[str, set[str]]]:
    """Keys kept whatever their value, and keys kept for certain values."""
    free: set[str] = {"area", *mapping.tags.include}
    valued: dict[str, set[str]] = {}
    for t in mapping.tables.values():
        for kind in kinds:
            for _, rules in t.rules(kind):
                for r in rules:
                    valued.setdefault(r.key, set()).add(r.value)
    free |= {k for k, v in valued.items() if ANY in v}
    return free, valued


def _extra(mapping: Mapping, kinds: tuple[str, ...]) -> set[str]:
    out: set[str] = set()
    for t in mapping.tables.values():
        for kind in kinds:
            if not t.serves(kind):
                continue
            for c in t.columns:
                out |= {c.key, *c.keys} - {""}
            out |= {k for k, _ in t.filters.exclude_tags}
            if kind in ("polygon", "relation", "relation_member") and t.relation_types is not None:
                out.add("type")
    return out


def glob_regexp(pattern: str) -> str | None:
    """Shell pattern to an anchored regular expression; * and ? do not cross a slash; None if it is malformed."""
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        if c == "*":
            out += "[^/]*"
        elif c == "?":
            out += "[^/]"
        elif c == "[":
            end = pattern.find("]", i + 2)
            if end < 0:
                return None
            body = pattern[i + 1 : end]
            negated = body.startswith("^")
            body = body[negated:].replace("\\", "\\\\").replace("[", "\\[").replace("&&", "&\\&")
            out += "[" + "^" * negated + body + "]"
            i = end
        elif c == "\\":
            if i + 1 == len(pattern):
                return None
            i += 1
            out += "\\Q" + pattern[i] + "\\E"
        else:
            out += "\\Q" + c + "\\E"
        i += 1
    return f"^{out}$"


def tag_filter(mapping: Mapping, kind: str, tags: Column | None = None) -> Column:
    """The tags that an element of kind node, way or relation keeps."""
    tags = F.col("tags") if tags is None else tags
    if mapping.tags.load_all:
        plain = [k for k in mapping.tags.exclude if not set("?*[") & set(k)]
        globs = [g for g in (glob_regexp(k) for k in mapping.tags.exclude if set("?*[") & set(k)) if g]
        if not mapping.tags.exclude:
            return tags

        def keep(k: Column, _: Column) -> Column:
            out = ~k.isin(*plain) if plain else F.lit(True)
            for g in globs:
                out = out & ~k.rlike(g)
            return out

        return F.map_filter(tags, keep)
    kinds = {"node": NODE_KINDS, "way": WAY_KINDS, "relation": RELATION_KINDS}[kind]
    free, valued = _wanted(mapping, kinds)
    # Members' own columns are read from nodes and ways, so their keys are kept there as well.
    free |= _extra(mapping, (*kinds, "relation_member"))
    valued = {k: v for k, v in valued.items() if k not in free}
    if kind == "relation" and "type" not in free:
        valued["type"] = valued.get("type", set()) | set(MULTIPOLYGON_TYPES)

    def keep(k: Column, v: Column) -> Column:
        out = k.isin(*sorted(free))
        for key, values in sorted(valued.items()):
            out = out | ((k == key) & v.isin(*sorted(values)))
        return out

    return F.map_filter(tags, keep)


# --- row filters -----------------------------------------------------------------------------------------------


def require_or_reject(tags: Column, key: str, values: tuple[str, ...], require: bool) -> Column:
    value = tag(tags, key)
    hit = value.isNotNull() if ANY in values else isin(value, values)
    return hit if require else ~hit


def regexp_filter(tags: Column, key: str, pattern: str, require: bool) -> Column:
    hit = F.coalesce(tag(tags, key).rlike(pattern), F.lit(False))
    return hit if require else ~hit


def area_filter(tags: Column, key: Column, closed: Column, area_tags: tuple[str, ...]) -> Column:
    """Linestring tables: a closed way that is an area by its area tag or its matched key is none of theirs."""
    area = F.coalesce(tag(tags, "area"), F.lit(""))
    return ~(closed & ((area == "yes") | ((area != "no") & isin(key, area_tags))))


def linear_filter(tags: Column, key: Column, closed: Column, linear_tags: tuple[str, ...]) -> Column:
    """Polygon tables: a way that is linear by its area tag or its matched key is none of theirs."""
    area = F.coalesce(tag(tags, "area"), F.lit(""))
    return ~(closed & (area == "no")) & ~((area != "yes") & isin(key, linear_tags))


def relation_type_filter(tags: Column, table: TableDef) -> Column | None:
    if table.relation_types is not None:
        return isin(tag(tags, "type"), table.relation_types)
    return isin(tag(tags, "type"), MULTIPOLYGON_TYPES) if table.type == "polygon" else None


def row_filter(mapping: Mapping, table: TableDef, tags: Column, key: Column, closed: Column, relation: bool) -> Column:
    out = F.lit(True)
    f = table.filters
    for k, v in f.exclude_tags:
        out = out & require_or_reject(tags, k, (v,), False)
    for k, v in f.require:
        out = out & require_or_reject(tags, k, v, True)
    for k, v in f.reject:
        out = out & require_or_reject(tags, k, v, False)
    for k, v in f.require_regexp:
        out = out & regexp_filter(tags, k, v, True)
    for k, v in f.reject_regexp:
        out = out & regexp_filter(tags, k, v, False)
    if table.type == "linestring" and mapping.area_tags is not None:
        out = out & area_filter(tags, key, closed, mapping.area_tags)
    if table.type == "polygon" and mapping.linear_tags is not None:
        out = out & linear_filter(tags, key, closed, mapping.linear_tags)
    if relation and (types := relation_type_filter(tags, table)) is not None:
        out = out & types
    return out


# --- matching --------------------------------------------------------------------------------------------------


def first_match(tags: Column, rules: tuple[Rule, ...]) -> Column:
    """struct(key, value) of the rule of least order that the tags meet, or null.

    Neighbouring rules of one key are one branch, so the expression grows with the number of keys.
    """
    out: Column | None = None
    groups: list[tuple[str, list[str]]] = []
    for r in sorted(rules, key=lambda r: r.order):
        if groups and groups[-1][0] == r.key and (ANY in groups[-1][1]) == (r.value == ANY):
            groups[-1][1].append(r.value)
        else:
            groups.append((r.key, [r.value]))
    match = lambda k, v: F.struct(k.alias("key"), v.alias("value"))
    for key, values in groups:
        if key == ANY:
            if ANY not in values:
                continue
            test, made = F.lit(True), match(F.lit(ANY), F.lit(ANY))
        else:
            value = tag(tags, key)
            test = value.isNotNull() if ANY in values else isin(value, values)
            made = match(F.lit(key), value)
        out = F.when(test, made) if out is None else out.when(test, made)
    return F.lit(None).cast("struct<key:string,value:string>") if out is None else out


@dataclass(frozen=True)
class Destination:
    table: TableDef
    sub_mapping: str
    match: Column


def destinations(mapping: Mapping, kind: str, tags: Column, closed: Column, relation: bool) -> list[Destination]:
    """For each table and sub-mapping that elements of this kind can reach, the match: struct(key, value), or null
    when no rule is met or a filter drops the winner. The next best rule is not tried."""
    out = []
    for t in mapping.tables.values():
        for name, rules in t.rules(kind):
            m = first_match(tags, rules)
            out.append(Destination(t, name, F.when(m.isNotNull() & row_filter(mapping, t, tags, m["key"], closed, relation), m)))
    return out


def is_closed(refs: Column) -> Column:
    return (F.size(refs) >= 4) & (F.get(refs, F.lit(0)) == F.get(refs, F.size(refs) - 1))


def way_admits(kind: str, tags: Column, closed: Column) -> Column:
    """Whether a way may be a linestring or a polygon at all, by its shape and area tag."""
    area = F.coalesce(tag(tags, "area"), F.lit(""))
    return ~(closed & (area == "yes")) if kind == "linestring" else closed & (area != "no")
