import pytest
from pyspark.sql import functions as F

from tagloom.functions import columns
from tagloom.functions.columns import Row
from tagloom.plans import compiler
from tagloom.plans.mapping import Mapping, MappingError


def tags_df(spark, rows):
    return spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "id bigint, tags map<string,string>")


def matches(spark, mapping, kind, rows, closed=False, relation=False):
    df = tags_df(spark, rows)
    d = compiler.destinations(Mapping.parse(mapping), kind, F.col("tags"), F.lit(closed), relation)
    out = []
    cols = [F.struct(F.lit(x.table.name).alias("t"), F.lit(x.sub_mapping).alias("s"), x.match.alias("m")).alias(f"c{i}") for i, x in enumerate(d)]
    for r in df.select("id", *cols).orderBy("id").collect():
        out.append(sorted((c["t"], c["s"], c["m"]["key"], c["m"]["value"]) for c in r[1:] if c["m"] is not None))
    return out


def test_order_decides_and_repeated_keys_count(spark):
    m = "tables: {t: {type: point, mapping: {a: [x], b: [__any__], a: [__any__]}}}"
    assert matches(spark, m, "point", [{"a": "x", "b": "1"}, {"a": "y", "b": "1"}, {"a": "y"}, {"c": "1"}]) == [
        [("t", "", "a", "x")], [("t", "", "b", "1")], [("t", "", "a", "y")], [],
    ]


def test_any_key_reports_any(spark):
    m = "tables: {all: {type: point, mapping: {__any__: [__any__]}}}"
    assert matches(spark, m, "point", [{"a": "x"}]) == [[("all", "", "__any__", "__any__")]]


def test_filters_drop_the_winner_without_a_second_try(spark):
    m = "tables: {t: {type: point, mapping: {a: [x], b: [y]}, filters: {require: {c: [__any__]}, reject: {d: [bad, worse]}}}}"
    assert matches(spark, m, "point", [{"a": "x", "b": "y"}, {"a": "x", "c": "1"}, {"a": "x", "c": "1", "d": "worse"}, {"b": "y", "c": "", "d": "ok"}]) == [
        [], [("t", "", "a", "x")], [], [("t", "", "b", "y")],
    ]


def test_regexp_filters(spark):
    m = "tables: {t: {type: point, mapping: {a: [__any__]}, filters: {require_regexp: {l: '^-?[0-9]+$'}, reject_regexp: {n: 'x'}}}}"
    got = matches(spark, m, "point", [{"a": "1"}, {"a": "1", "l": "-3"}, {"a": "1", "l": "3a"}, {"a": "1", "l": "3", "n": "axb"}])
    assert [bool(x) for x in got] == [False, True, False, False]


@pytest.mark.parametrize(
    ("kind", "closed", "tags", "hit"),
    [
        ("linestring", True, {"highway": "pedestrian"}, False),
        ("linestring", True, {"highway": "pedestrian", "area": "no"}, True),
        ("linestring", True, {"highway": "pedestrian", "area": "yes"}, False),
        ("linestring", False, {"highway": "pedestrian", "area": "yes"}, True),
        ("polygon", True, {"barrier": "wall"}, False),
        ("polygon", True, {"barrier": "wall", "area": "yes"}, True),
        ("polygon", True, {"landuse": "x", "area": "no"}, False),
        ("polygon", True, {"landuse": "x"}, True),
    ],
)
def test_area_rules(spark, kind, closed, tags, hit):
    m = """
areas: {area_tags: [highway], linear_tags: [barrier]}
tables: {l: {type: linestring, mapping: {highway: [__any__]}}, p: {type: polygon, mapping: {barrier: [__any__], landuse: [__any__]}}}"""
    assert bool(matches(spark, m, kind, [tags], closed)[0]) == hit


def test_relation_types(spark):
    m = "tables: {p: {type: polygon, mapping: {a: [x]}}, r: {type: relation, relation_types: [route], mapping: {a: [x]}}}"
    rows = [{"a": "x"}, {"a": "x", "type": "boundary"}, {"a": "x", "type": "route"}]
    assert [len(x) for x in matches(spark, m, "polygon", rows, True, True)] == [0, 1, 0]
    assert [len(x) for x in matches(spark, m, "relation", rows, True, True)] == [0, 0, 1]


def test_tag_filters(spark):
    m = Mapping.parse("tags: {include: [source]}\ntables: {t: {type: point, mapping: {a: [x, y], b: [__any__]}, columns: [{name: n, key: name, type: string}]}}")
    df = tags_df(spark, [{"a": "x", "b": "1", "c": "2", "name": "n", "source": "s", "area": "yes"}, {"a": "z"}])
    got = [r[0] for r in df.select(compiler.tag_filter(m, "node")).collect()]
    assert got == [{"a": "x", "b": "1", "name": "n", "source": "s", "area": "yes"}, {}]
    rel = tags_df(spark, [{"type": "multipolygon"}, {"type": "route"}]).select(compiler.tag_filter(m, "relation")).collect()
    assert [r[0] for r in rel] == [{"type": "multipolygon"}, {}]


@pytest.mark.parametrize(("pattern", "key", "gone"), [("tiger:*", "tiger:a", True), ("tiger:*", "tiger:a/b", False), ("a?c", "abc", True), ("a?c", "ac", False), ("[ab]x", "bx", True), ("[^a]x", "bx", True), ("[a", "[a", False), ("a.c", "abc", False)])
def test_exclude_patterns(spark, pattern, key, gone):
    m = Mapping.parse(f"tags: {{load_all: true, exclude: ['{pattern}', zz]}}\ntables: {{}}")
    got = tags_df(spark, [{key: "1", "keep": "2"}]).select(compiler.tag_filter(m, "node")).first()[0]
    assert (key not in got) == gone and "keep" in got


@pytest.mark.parametrize("text", ["tables: {t: {mapping: {a: [x]}}}", "tables: {t: {type: geometry, mapping: {a: [x]}}}", "tables: {t: {type: nothing}}", "tables: {t: {type: point, columns: [{name: a, type: b}]}}", "tables: {t: {type: point, mapping: {a: x}}}", "[1"])
def test_invalid_mappings(text):
    with pytest.raises(MappingError):
        Mapping.parse(text)


def test_json_with_trailing_commas_and_fields_alias():
    m = Mapping.parse('{"tables": {"t": {"type": "point", "fields": [{"name": "id", "type": "id"},], "filters": null, "mapping": {"a": ["b",],},},},}')
    assert m.tables["t"].columns[0].type == "id" and m.tables["t"].mapping[0].value == "b"


def column(spark, definition, rows, value="v", key="k"):
    m = Mapping.parse("tables: {t: {type: point, columns: [" + definition + "]}}")
    row = Row(F.col("tags"), F.lit(key), F.lit(value), F.col("id"), F.lit(None).cast("binary"))
    return [r[0] for r in tags_df(spark, rows).orderBy("id").select(columns.build(m.tables["t"].columns[0], row)).collect()]


def test_bool_and_integer(spark):
    rows = [{}, {"x": ""}, {"x": "0"}, {"x": "no"}, {"x": "false"}, {"x": "maybe"}, {"x": "yes"}]
    assert column(spark, "{name: c, key: x, type: bool}", rows) == [False] * 5 + [True] * 2
    rows = [{"x": v} for v in ("1", "-7", "+3", " 5 ", "1.0", "1e3", "2147483647", "2147483648", "", "abc")] + [{}]
    assert column(spark, "{name: c, key: x, type: integer}", rows) == [1, -7, 3, None, None, None, 2147483647, None, None, None, None]


def test_direction_and_string(spark):
    assert column(spark, "{name: c, key: x, type: direction}", [{"x": v} for v in ("yes", "1", "true", "-1", "no")] + [{}]) == [1, 1, 1, -1, 0, 0]
    assert column(spark, "{name: c, key: x, type: string}", [{}, {"x": "a"}]) == ["", "a"]


def test_way_z_order(spark):
    d = "{name: z, type: wayzorder}"
    rows = [{}, {"layer": "1"}, {"layer": "-2", "tunnel": "yes"}, {"bridge": "true"}, {"layer": "no"}, {"layer": "11111111111111111"}, {"railway": "rail"}, {"layer": "99999999999999999999999999999999999999999999"}]
    assert column(spark, d, rows, "motorway") == [9, 19, -21, 19, 9, None, 9, None]
    assert column(spark, d, [{"railway": "rail"}, {}], "other") == [7, 0]


def test_ranked_z_order_ignores_whole_number_default(spark):
    args = "ranks: [a, b, c]"
    assert column(spark, "{name: z, type: wayzorder, args: {%s, default: 5}}" % args, [{"layer": "1"}], "x") == [3]
    assert column(spark, "{name: z, type: wayzorder, args: {%s, default: 5.0}}" % args, [{"layer": "1"}], "x") == [8]
    assert column(spark, "{name: z, type: wayzorder, args: {%s}}" % args, [{"tunnel": "1"}, {"layer": "3000000000"}], "c") == [0, None]


def test_enumerate_zorder_categorize(spark):
    assert column(spark, "{name: e, type: enumerate, args: {values: [a, b]}}", [{}], "b") == [2]
    assert column(spark, "{name: e, type: enumerate, key: x, args: {values: [a, b]}}", [{"x": "a"}, {}], "b") == [1, 0]
    assert column(spark, "{name: e, type: zorder, args: {ranks: [a, b]}}", [{}], "a") == [2]
    d = "{name: e, type: categorize_int, key: x, keys: [y], args: {default: -1, values: {a: 5, b: 0}}}"
    assert column(spark, d, [{"x": "a", "y": "b"}, {"x": "q", "y": "b"}, {}]) == [5, 0, -1]


def test_suffix_replace(spark):
    d = "{name: s, key: n, type: string_suffixreplace, args: {suffixes: {straße: str., Straße: Str., 'allee.x': X}}}"
    rows = [{"n": v} for v in ("Hauptstraße", "Straße", "straßenbahn", "straße straße", "alleeyx", "allee.x", "")] + [{}]
    assert column(spark, d, rows) == ["Hauptstr.", "Str.", "straßenbahn", "str. str.", "alleeyx", "X", "", ""]


def test_hstore_is_sorted_and_escaped(spark):
    assert column(spark, "{name: h, type: hstore_tags}", [{"b": 'say "x"', "a": "c:\\d"}]) == ['"a"=>"c:\\\\d", "b"=>"say \\"x\\""']
    assert column(spark, "{name: h, type: hstore_tags, args: {include: [a]}}", [{"b": "1", "a": "2"}, {}]) == ['"a"=>"2"', ""]
