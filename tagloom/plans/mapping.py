"""The mapping language: YAML or JSON text to dataclasses.

Key order and repeated keys carry meaning (the first rule wins), so mappings of keys to values are kept as ordered
pairs. JSON is read as YAML, which also accepts trailing commas.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from pathlib import Path

import yaml

ANY = "__any__"
TABLE_TYPES = ("point", "linestring", "polygon", "geometry", "relation", "relation_member")


class MappingError(ValueError):
    """The mapping is not valid."""


class Pairs(list):
    """Ordered (key, value) pairs of a YAML mapping, repeated keys included."""

    def last(self, key: str, default=None):
        """The value of a key that stands for one setting: as in any YAML mapping, the last one given."""
        out = default
        for k, v in self:
            if k == key:
                out = v
        return default if out is None else out


class _Loader(yaml.SafeLoader):
    pass


def _pairs(loader: _Loader, node: yaml.MappingNode) -> Pairs:
    return Pairs((loader.construct_object(k, deep=True), loader.construct_object(v, deep=True)) for k, v in node.value)


_Loader.add_constructor(yaml.resolver.BaseResolver.DEFAULT_MAPPING_TAG, _pairs)


@dataclass(frozen=True)
class Rule:
    """One accepted tag; order decides between rules of the same destination."""

    key: str
    value: str
    order: int


@dataclass(frozen=True)
class ColumnDef:
    name: str
    type: str
    key: str = ""
    keys: tuple[str, ...] = ()
    args: Pairs = field(default_factory=Pairs)
    from_member: bool = False


@dataclass(frozen=True)
class Filters:
    require: tuple[tuple[str, tuple[str, ...]], ...] = ()
    reject: tuple[tuple[str, tuple[str, ...]], ...] = ()
    require_regexp: tuple[tuple[str, str], ...] = ()
    reject_regexp: tuple[tuple[str, str], ...] = ()
    exclude_tags: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class TableDef:
    name: str
    type: str
    columns: tuple[ColumnDef, ...]
    mapping: tuple[Rule, ...] = ()
    sub_mappings: tuple[tuple[str, tuple[Rule, ...]], ...] = ()
    type_mappings: tuple[tuple[str, tuple[Rule, ...]], ...] = ()
    filters: Filters = Filters()
    relation_types: tuple[str, ...] | None = None

    def serves(self, kind: str) -> bool:
        return self.type in (kind, "geometry")

    def rules(self, kind: str) -> list[tuple[str, tuple[Rule, ...]]]:
        """(sub-mapping name, rules) of the destinations that elements of this kind can reach."""
        out: dict[str, list[Rule]] = {}
        if self.serves(kind):
            out[""] = list(self.mapping)
            plural = {"point": "points", "linestring": "linestrings", "polygon": "polygons"}.get(kind)
            out[""] += dict(self.type_mappings).get(plural, ())
            for name, rules in self.sub_mappings:
                out[name] = list(rules)
        return [(name, tuple(rules)) for name, rules in out.items() if rules]


@dataclass(frozen=True)
class GeneralizedDef:
    name: str
    source: str
    tolerance: float
    sql_filter: str = ""


@dataclass(frozen=True)
class TagOptions:
    load_all: bool = False
    exclude: tuple[str, ...] = ()
    include: tuple[str, ...] = ()


@dataclass(frozen=True)
class Mapping:
    tables: dict[str, TableDef]
    generalized: dict[str, GeneralizedDef]
    tags: TagOptions = TagOptions()
    area_tags: tuple[str, ...] | None = None
    linear_tags: tuple[str, ...] | None = None
    single_id_space: bool = False

    @staticmethod
    def load(path: str | Path) -> Mapping:
        return Mapping.parse(Path(path).read_text())

    @staticmethod
    def parse(text: str) -> Mapping:
        try:
            top = yaml.load(text, _Loader)
        except yaml.YAMLError as e:
            raise MappingError(str(e)) from e
        if not isinstance(top, Pairs):
            raise MappingError("the mapping is not a dictionary")
        tables = {str(name): _table(str(name), d) for name, d in _dict(top.last("tables"), "tables")}
        generalized = {str(name): _generalized(str(name), d) for name, d in _dict(top.last("generalized_tables"), "generalized_tables")}
        tags, areas = _dict(top.last("tags"), "tags"), _dict(top.last("areas"), "areas")
        strings = lambda d, key: tuple(map(str, d.last(key, ())))
        return Mapping(
            tables,
            generalized,
            TagOptions(bool(tags.last("load_all", False)), strings(tags, "exclude"), strings(tags, "include")),
            strings(areas, "area_tags") if areas.last("area_tags") is not None else None,
            strings(areas, "linear_tags") if areas.last("linear_tags") is not None else None,
            bool(top.last("use_single_id_space", False)),
        )


def _dict(value, what: str) -> Pairs:
    if value is None:
        return Pairs()
    if not isinstance(value, Pairs):
        raise MappingError(f"{what} is not a dictionary")
    return value


def _values(value, what: str) -> tuple[str, ...]:
    if not isinstance(value, list) or isinstance(value, Pairs) or not all(isinstance(v, str) for v in value):
        raise MappingError(f"{what}: values must be a list of strings")
    return tuple(value)


def _key_values(value, what: str) -> tuple[tuple[str, tuple[str, ...]], ...]:
    """Repeated keys are joined, in order."""
    out: dict[str, tuple[str, ...]] = {}
    for k, v in _dict(value, what):
        if not isinstance(k, str):
            raise MappingError(f"{what}: key {k!r} is not a string")
        out[k] = out.get(k, ()) + _values(v, f"{what}.{k}")
    return tuple(out.items())


def _rules(value, what: str) -> tuple[Rule, ...]:
    out: list[Rule] = []
    for k, v in _dict(value, what):
        if not isinstance(k, str):
            raise MappingError(f"{what}: key {k!r} is not a string")
        for x in _values(v, f"{what}.{k}"):
            out.append(Rule(k, x, len(out)))
    return tuple(out)


def _table(name: str, value) -> TableDef:
    d = _dict(value, name)
    kind = d.last("type")
    if not kind:
        raise MappingError(f"missing type for table {name}")
    if kind not in TABLE_TYPES:
        raise MappingError(f"unknown type {kind} for table {name}")
    mapping, subs = _rules(d.last("mapping"), name), _dict(d.last("mappings"), name)
    if kind == "geometry" and (mapping or subs):
        raise MappingError(f"table {name} is of type geometry and needs type_mappings")
    columns = tuple(_column(name, c) for c in (d.last("columns") or d.last("fields") or ()))
    f = _dict(d.last("filters"), name)
    types = d.last("relation_types")
    return TableDef(
        name,
        kind,
        columns,
        mapping,
        tuple((str(k), _rules(_dict(v, name).last("mapping"), f"{name}.{k}")) for k, v in subs),
        tuple((str(k), _rules(v, f"{name}.{k}")) for k, v in _dict(d.last("type_mappings"), name)),
        Filters(
            _key_values(f.last("require"), name),
            _key_values(f.last("reject"), name),
            tuple((str(k), str(v)) for k, v in _dict(f.last("require_regexp"), name)),
            tuple((str(k), str(v)) for k, v in _dict(f.last("reject_regexp"), name)),
            tuple((str(k), str(v)) for k, v in (f.last("exclude_tags") or ())),
        ),
        tuple(map(str, types)) if types is not None else None,
    )


def _column(table: str, value) -> ColumnDef:
    from ..functions.columns import COLUMN_TYPES

    d = _dict(value, table)
    kind = d.last("type", "")
    if kind not in COLUMN_TYPES:
        raise MappingError(f"unknown column type {kind!r} in table {table}")
    return ColumnDef(str(d.last("name", "")), kind, str(d.last("key", "")), tuple(map(str, d.last("keys", ()))), _dict(d.last("args"), table), bool(d.last("from_member", False)))


def _generalized(name: str, value) -> GeneralizedDef:
    d = _dict(value, name)
    source = d.last("source")
    if not source:
        raise MappingError(f"missing source for generalized table {name}")
    return GeneralizedDef(name, str(source), float(d.last("tolerance", 0.0)), str(d.last("sql_filter", "")))
