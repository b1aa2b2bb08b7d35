import gzip
import json
import os
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tagloom.engine import Engine
from tagloom.functions import kernel
from tagloom.operators import changes as ch
from tagloom.operators import tables as tb
from tagloom.operators.sinks import NullSink, ParquetSink, Router, open_sink, table_prefix, write_tiles
from tagloom.plans.mapping import Mapping, MappingError
from tagloom.sources import pbf, xml
from tagloom.streaming import state as rs
from tagloom.sources.files import ChangeFile, sequence_of
from tagloom.streaming.stream import stream_changes

MAPPING = """
tags: {include: [layer, bridge, tunnel]}
areas: {area_tags: [landuse, water], linear_tags: [barrier]}
tables:
  places: {type: point, mapping: {place: [__any__]}, columns: [{name: osm_id, type: id}, {name: geometry, type: geometry}, {name: name, key: name, type: string}]}
  roads:
    type: linestring
    mappings: {car: {mapping: {highway: [__any__]}}, rail: {mapping: {railway: [__any__]}}}
    columns: [{name: osm_id, type: id}, {name: geometry, type: geometry}, {name: type, type: mapping_value}, {name: z, type: wayzorder}]
  uses:
    type: polygon
    mapping: {landuse: [__any__]}
    columns: [{name: osm_id, type: id}, {name: geometry, type: validated_geometry}, {name: type, type: mapping_value}, {name: area, type: area}]
  waters: {type: polygon, mapping: {water: [__any__]}, columns: [{name: osm_id, type: id}, {name: geometry, type: geometry}, {name: area, type: webmerc_area}]}
  routes: {type: relation, relation_types: [route], mapping: {route: [bus]}, columns: [{name: osm_id, type: id}, {name: ref, key: ref, type: string}]}
  stops:
    type: relation_member
    relation_types: [route]
    mapping: {route: [bus]}
    columns: [{name: osm_id, type: id}, {name: member, type: member_id}, {name: i, type: member_index}, {name: role, type: member_role}, {name: kind, type: member_type}, {name: geometry, type: geometry}, {name: line, key: name, type: string}, {name: name, key: name, type: string, from_member: true}]
generalized_tables:
  uses_gen0: {source: uses_gen1, tolerance: 20.0, sql_filter: 'ST_Area("geometry")>3000000'}
  uses_gen1: {source: uses, tolerance: 5.0, sql_filter: 'ST_Area(geometry)>1000000'}
"""


def node(i, lon, lat, **tags):
    return ("node", i, lon, lat, None, None, tags)


def way(i, refs, **tags):
    return ("way", i, None, None, refs, None, tags)


def rel(i, members, **tags):
    return ("relation", i, None, None, None, members, tags)


#: Squares around (8, 53): corners 1-4 large, 5-8 small inside; a road; a route with a stop.
ROWS = [
    *[node(i, 8 + x, 53 + y) for i, (x, y) in enumerate([(0, 0), (0.1, 0), (0.1, 0.1), (0, 0.1), (0.02, 0.02), (0.05, 0.02), (0.05, 0.05), (0.02, 0.05)], 1)],
    node(20, 8.2, 53.2, place="city", name="Town"),
    node(21, 8.3, 53.3, place="village", note="x"),
    way(100, [1, 2, 3, 4, 1], landuse="wood"),
    way(101, [5, 6, 7, 8, 5]),
    way(102, [1, 20, 21], highway="primary", railway="tram", layer="1"),
    way(103, [1, 999], highway="track"),
    way(104, [1, 2], highway="path", bridge="yes"),
    way(105, [2, 3, 4, 1], junk="x"),
    rel(200, [(1, 100, "outer"), (1, 101, "outer")], type="multipolygon", landuse="park"),
    rel(201, [(1, 104, ""), (1, 105, "")], type="multipolygon", water="lake"),
    rel(202, [(1, 104, ""), (0, 20, "stop"), (0, 1, "stop"), (2, 200, "")], type="route", route="bus", ref="7", name="Line 7"),
    rel(203, [(1, 777, "")], type="route", route="bus", ref="8"),
]


def write_xml(path, rows):
    def esc(tags):
        return "".join(f'<tag k="{k}" v="{v}"/>' for k, v in tags.items())

    out = "<osm>"
    for kind, i, lon, lat, refs, members, tags in rows:
        if kind == "node":
            out += f'<node id="{i}" lon="{lon}" lat="{lat}">{esc(tags)}</node>\n'
        elif kind == "way":
            out += f'<way id="{i}">' + "".join(f'<nd ref="{r}"/>' for r in refs) + esc(tags) + "</way>\n"
        else:
            out += f'<relation id="{i}">' + "".join(f'<member type="{("node", "way", "relation")[t]}" ref="{r}" role="{o}"/>' for t, r, o in members) + esc(tags) + "</relation>\n"
    path.write_text(out + "</osm>")
    return str(path)


def change_xml(changes):
    out = "<osmChange>"
    for action, (kind, i, lon, lat, refs, members, tags) in changes:
        body = "".join(f'<nd ref="{r}"/>' for r in refs or ()) + "".join(f'<member type="{("node", "way", "relation")[t]}" ref="{r}" role="{o}"/>' for t, r, o in members or ())
        at = f' lon="{lon}" lat="{lat}"' if lon is not None else ""
        out += f'<{action}><{kind} id="{i}"{at}>{body}' + "".join(f'<tag k="{k}" v="{v}"/>' for k, v in tags.items()) + f"</{kind}></{action}>"
    return (out + "</osmChange>").encode()


CHANGES = [
    ("modify", node(20, 8.25, 53.2, place="town", name="New Town")),
    ("modify", node(3, 8.1, 53.12)),
    ("delete", ("node", 21, None, None, None, None, {})),
    ("create", node(22, 8.4, 53.4, place="hamlet")),
    ("modify", way(104, [1, 2], highway="steps")),
    ("modify", way(100, [1, 2, 3, 4, 1], water="pond")),
    ("create", way(106, [1, 22], highway="service")),
    ("create", way(107, [888, 22], highway="service")),
    ("delete", ("relation", 201, None, None, None, None, {})),
    ("modify", rel(203, [(1, 106, "")], type="route", route="bus", ref="9")),
]


@pytest.fixture(scope="module")
def engine(spark):
    return Engine(spark, Mapping.parse(MAPPING))


@pytest.fixture(scope="module")
def elements(spark, engine, tmp_path_factory):
    e = engine.read(write_xml(tmp_path_factory.mktemp("osm") / "a.osm", ROWS))
    return e.map(lambda d: d.cache())


@pytest.fixture(scope="module")
def tables(engine, elements):
    return {k: v.cache() for k, v in engine.tables(elements).items()}


def by_id(df):
    return {r.osm_id: r for r in df.collect()}


def test_reading_keeps_what_is_needed(elements):
    assert {r.id for r in elements.nodes.collect()} == {20, 21}
    assert elements.coords.count() == 10
    assert elements.nodes.where("id = 21").first().tags == {"place": "village"}
    assert elements.ways.count() == 6 and elements.relations.count() == 4


def test_point_and_line_rows(tables):
    assert {k: r.name for k, r in by_id(tables["places"]).items()} == {20: "Town", 21: ""}
    rows = sorted((r.osm_id, r.type, r.z) for r in tables["roads"].collect())
    assert rows == [(102, "primary", 16), (102, "tram", 17), (104, "path", 10)]  # one row for each sub-mapping; 103 lacks a node


def test_polygons(spark, tables):
    uses = by_id(tables["uses"])
    assert set(uses) == {100, -200}
    assert uses[-200].area < uses[100].area  # the small square is a hole whatever its role says
    kinds = tables["uses"].select("osm_id", kernel.kind(F.col("geometry")).alias("k"), kernel.call("ST_IsValid", "geometry").alias("v"))
    assert {(r.k, r.v) for r in kinds.collect()} == {("Polygon", True)}
    waters = by_id(tables["waters"])
    assert set(waters) == {-201} and waters[-201].area > 0  # merged from two open ways


def test_relations_and_members(spark, tables):
    assert {k: r.ref for k, r in by_id(tables["routes"]).items()} == {-202: "7"}  # 203 lacks a way
    rows = [(r.member, r.i, r.role, r.kind, r.line, r.name) for r in tables["stops"].orderBy("i").collect()]
    assert rows == [(104, 0, "", 1, "Line 7", ""), (20, 1, "stop", 0, "Line 7", "Town"), (1, 2, "stop", 0, "Line 7", None), (200, 3, "", 2, "Line 7", "")]
    kinds = tables["stops"].select("i", kernel.kind(F.col("geometry")).alias("k"), kernel.call("ST_IsEmpty", "geometry").alias("e")).orderBy("i").collect()
    assert [(r.k, r.e) for r in kinds] == [("LineString", False), ("Point", False), ("Point", False), ("Polygon", True)]


def test_generalized(engine, tables):
    g = engine.generalize(tables)
    assert {r.osm_id for r in g["uses_gen1"].collect()} == {100, -200} and set(g["uses_gen0"].columns) == set(tables["uses"].columns)
    bad = Mapping.parse("tables: {}\ngeneralized_tables: {a: {source: b}, b: {source: a}}")
    with pytest.raises(MappingError):
        Engine(engine.spark, bad).generalize({})


def test_single_id_space(spark, elements):
    m = Mapping.parse("use_single_id_space: true\ntables: {all: {type: geometry, type_mappings: {points: {place: [__any__]}, linestrings: {highway: [__any__]}, polygons: {landuse: [__any__]}}, relation_types: [multipolygon], columns: [{name: osm_id, type: id}]}}")
    e = Engine(spark, m)
    got = sorted(r[0] for r in e.tables(elements)["all"].collect())
    assert got == sorted([20, 21, -102, -104, -100, -(10**17) - 200])


def test_limit_clips_and_filters(spark, elements, tmp_path):
    p = tmp_path / "limit.geojson"
    p.write_text(json.dumps({"type": "Polygon", "coordinates": [[[7.9, 52.9], [8.05, 52.9], [8.05, 53.3], [7.9, 53.3], [7.9, 52.9]]]}))
    e = Engine(spark, Mapping.parse(MAPPING), limit_path=str(p))
    t = e.tables(elements)
    assert t["places"].count() == 0
    assert {r.osm_id for r in t["roads"].collect()} == {102, 104}
    whole = t["uses"].select("osm_id", "area").collect()
    assert {r.osm_id for r in whole} == {100, -200}


def test_pbf_round_trip(spark, engine, tables, tmp_path):
    blocks = [pbf.encode_block(ROWS[:6]), pbf.encode_block(ROWS[6:])]
    path = tmp_path / "a.pbf"
    path.write_bytes(pbf.encode_file(blocks, 1700000000))
    assert pbf.read_header(str(path))["timestamp"] == 1700000000
    got = pbf.read_elements(spark, str(path), partition_bytes=1)
    rows = {(r.id, tuple(r.refs), tuple(sorted(r.tags.items()))) for r in got["ways"].collect()}
    assert rows == {(w[1], tuple(w[4]), tuple(sorted(w[6].items()))) for w in ROWS if w[0] == "way"}
    members = {r.id: [tuple(m) for m in r.members] for r in got["relations"].collect()}
    assert members == {r[1]: r[5] for r in ROWS if r[0] == "relation"}
    e = engine.read(str(path))
    assert {r.osm_id for r in engine.tables(e)["uses"].collect()} == {100, -200}


def comparable(df):
    cols = [F.hex(c).alias(c) if t == "binary" else F.round(c, 3).alias(c) if t == "float" else F.col(c) for c, t in df.drop("_kind", "_eid").dtypes]
    return sorted(map(str, df.select(*cols).collect()))


def test_incremental_equals_full(spark, elements, tmp_path):
    path = tmp_path / "001.osc.gz"
    path.write_bytes(gzip.compress(change_xml(CHANGES)))
    changes = xml.read_changes(spark, str(path), first_seq=5).cache()
    assert [r.ord for r in changes.orderBy("ord").collect()] == list(range(len(CHANGES)))
    e = Engine(spark, Mapping.parse(MAPPING), state_dir=str(tmp_path / "state"))
    e.start(elements)
    assert e.apply(changes) == 2
    new = e.load()
    full = e.tables(new.elements)
    full |= e.generalize(full)
    assert set(new.tables) == set(full) and e.mapping.generalized
    for name, df in new.tables.items():
        assert comparable(df) == comparable(full[name]), name
    ids = lambda name: {r.osm_id for r in new.tables[name].collect()}
    assert ids("places") == {20, 22} and ids("uses") == {-200} and ids("waters") == {100}
    assert 106 in ids("roads") and 107 not in ids("roads")
    assert {r.ref for r in new.tables["routes"].collect()} == {"7", "9"}
    assert e.apply(changes) == 2  # the sequence is known, so no version is made


def test_stream_versions_and_tiles(spark, elements, tmp_path):
    e = Engine(spark, Mapping.parse(MAPPING), state_dir=str(tmp_path / "state"), tiles_dir=str(tmp_path / "tiles"))
    e.start(elements)
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "000007.osc").write_bytes(change_xml(CHANGES))
    q = stream_changes(spark, e, str(folder), str(tmp_path / "check"), once=True)
    q.awaitTermination()
    assert e.load().last_seq == 7
    assert {r.osm_id for r in e.current_tables()["places"].collect()} == {20, 22}
    lines = [x for f in (tmp_path / "tiles").rglob("*.tiles") for x in f.read_text().split()]
    assert lines and all(len(x.split("/")) == 3 for x in lines) and len(lines) == len(set(lines))


def test_change_files_in_any_order_of_time(spark, elements, tmp_path):
    """Twelve files whose times do not follow their sequences, and a gap: all up to the gap are applied, none is lost."""
    mapping = Mapping.parse("tables: {places: {type: point, mapping: {place: [__any__]}, columns: [{name: osm_id, type: id}, {name: name, key: name, type: string}]}}")
    e = Engine(spark, mapping, state_dir=str(tmp_path / "state"))
    e.start(elements, last_seq=10)
    folder, order = tmp_path / "in", [17, 12, 21, 11, 19, 14, 22, 13, 20, 16, 18]  # 15 is missing
    folder.mkdir()

    def put(seq, at):
        f = folder / f"{seq}.osc"
        f.write_bytes(change_xml([("modify", node(20, 8.2, 53.2, place="city", name=f"name {seq}"))]))
        os.utime(f, (1_700_000_000 + at, 1_700_000_000 + at))

    for i, seq in enumerate(order):
        put(seq, i)
    stream = lambda: stream_changes(spark, e, str(folder), str(tmp_path / "check"), max_files=3, once=True).awaitTermination()
    name = lambda: {r.osm_id: r.name for r in e.current_tables()["places"].collect()}[20]
    stream()
    assert (e.load().last_seq, name()) == (14, "name 14")
    put(15, 100)
    stream()
    assert (e.load().last_seq, name()) == (22, "name 22")
    assert rs.load(spark, str(tmp_path / "state")).seq == 22


def test_sequences_of_given_files(spark, tmp_path):
    for n in ("1.osc", "11.osc"):
        (tmp_path / n).write_bytes(change_xml([("modify", node(20, 8.2, 53.2, name=n))]))
    got = xml.read_changes(spark, [str(tmp_path / "11.osc"), str(tmp_path / "1.osc")], 5).collect()
    assert sorted((r.seq, r.tags["name"]) for r in got) == [(5, "11.osc"), (6, "1.osc")]
    got = xml.read_changes(spark, f"{tmp_path}/*.osc").collect()
    assert sorted((r.seq, r.tags["name"]) for r in got) == [(0, "1.osc"), (1, "11.osc")]


def test_start_of_changes_after_an_import():
    files = [ChangeFile(90, "a", datetime(2024, 1, 1, 11, tzinfo=UTC)), ChangeFile(100, "b", datetime(2024, 1, 1, 12, tzinfo=UTC))]
    step = timedelta(hours=1), timedelta(hours=2)
    data = int(datetime(2024, 1, 1, 10, 30, tzinfo=UTC).timestamp())
    assert rs.after_import({"sequence": 77, "url": "u"}, files, *step) == rs.Replication(77, "", "u")
    assert rs.after_import({"sequence": None, "timestamp": data}, files, *step).seq == 100 - 2 - 2
    assert rs.after_import({"timestamp": data}, [], *step) is None and rs.after_import({}, files, *step) is None


def test_failed_steps_are_tried_again():
    slept, calls = [], []

    def step():
        calls.append(1)
        if len(calls) < 4:
            raise OSError("not yet")
        return "done"

    assert rs.retry(step, 5, slept.append) == "done" and slept == [2, 4, 8]
    with pytest.raises(OSError):
        rs.retry(lambda: (_ for _ in ()).throw(OSError()), 2, slept.append)


def test_lookup(engine, elements):
    got = {r.id: json.loads(r.json) if r.json else None for r in engine.lookup(elements, "way", [104, 5000], full=True).collect()}
    assert got[5000] is None and [n["id"] for n in got[104]["nodes"]] == [1, 2]
    got = {r.id: json.loads(r.json) for r in engine.lookup(elements, "node", [1, 20], deps=True).collect()}
    assert got[1]["ways"] == [100, 102, 103, 104, 105] and got[1]["relations"] == [202] and "tags" not in got[1]
    with pytest.raises(ValueError):
        engine.lookup(elements, "way", [1], True, True)


def test_rotation(spark, tmp_path):
    s = ParquetSink(spark, str(tmp_path))
    df = lambda n: spark.createDataFrame([(n,)], "v int")
    at = lambda schema: s.read("t", schema).first()[0] if s.exists("t", schema) else None
    s.write("t", df(1))
    s.deploy(["t", "missing"])
    assert (at("import"), at("public"), at("backup")) == (None, 1, None)
    s.write("t", df(2))
    s.deploy(["t"])
    assert (at("import"), at("public"), at("backup")) == (None, 2, 1)
    s.revert(["t"])
    assert (at("import"), at("public"), at("backup")) == (2, 1, None)
    s.deploy(["t"])
    s.remove_backup(["t"])
    assert (at("public"), at("backup")) == (2, None)


def test_router_prefix_and_null_sink(spark, tmp_path):
    assert [table_prefix(x) for x in (None, "NONE", "abc", "abc_")] == ["osm_", "", "abc_", "abc_"]
    with pytest.raises(KeyError):
        Router(NullSink(), ["a"]).write({"b": spark.range(1)})
    open_sink("null").write("a", spark.range(1))
    with pytest.raises(ValueError):
        open_sink("other")
    assert write_tiles(spark.createDataFrame([], "z int, x int, y int"), str(tmp_path)) is None


def test_replication_state(spark, tmp_path):
    assert rs.load(spark, str(tmp_path)) is None
    rs.save(spark, str(tmp_path), rs.Replication(5, "2024-01-01T00:00:00Z", "u"))
    assert rs.load(spark, str(tmp_path)).seq == 5
    now = datetime(2024, 1, 1, 12, 0, tzinfo=UTC)
    assert rs.start_sequence(1000, now, now - timedelta(minutes=90), timedelta(hours=1), timedelta(hours=2)) == 1000 - 2 - 2
    w = rs.waits()
    assert [next(w) for _ in range(9)] == [2, 4, 8, 16, 32, 64, 128, 256, 300]
    assert [sequence_of(p) for p in ("/a/000/001/234.osc.gz", "/x/17.osc", "/data/123/456/789/42.osc.gz", "/b/7.3.osc", "/x/none.osc")] == [1234, 17, 42, 7, 0]


def test_stored_tables_resolve_ways_once(spark, engine, elements, tables, tmp_path, monkeypatch):
    """One resolution for all tables of the mapping, and the rows that tables built apart have."""
    from tagloom.operators import resolve

    calls, plain = [], resolve.fill_ways
    monkeypatch.setattr(resolve, "fill_ways", lambda w, c: calls.append(1) or plain(w, c))
    sink = ParquetSink(spark, str(tmp_path))
    engine.write(sink, elements)
    assert len(calls) == 1 and not (tmp_path / "import" / "_steps").exists()
    for name, df in tables.items():
        assert comparable(sink.read(name)) == comparable(df), name
    plans = []
    engine.builder.build(elements, lambda name, df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or sink.hold(name, df))
    assert sum("explode(refs" in p for p in plans) == 1  # refs are joined with places in one step alone


def test_missing_member_drops_all_rows(spark, engine, elements):
    e = tb.Elements(elements.nodes, elements.ways, elements.relations, elements.coords.where("id <> 20"))
    assert engine.tables(e)["stops"].count() == 0


def test_clustering_keeps_rows_and_neighbours(spark, tables):
    from tagloom.engine import optimize
    from tagloom.operators.sinks import spatial_order

    out = optimize(tables["roads"], 2)
    assert out.columns == tables["roads"].columns and out.count() == tables["roads"].count()
    grid = spark.range(400).selectExpr("id", "id % 20 * 18.0 - 180 as lon", "floor(id / 20) * 9.0 - 90 as lat")
    parts = spatial_order(grid, F.col("lon"), F.col("lat"), 4).withColumn("p", F.spark_partition_id())
    spans = parts.groupBy("p").agg(F.count(F.lit(1)).alias("n"), (F.max("lon") - F.min("lon")).alias("w"), (F.max("lat") - F.min("lat")).alias("h")).collect()
    assert len(spans) == 4 and sum(r.n for r in spans) == 400
    assert sum((r.w + 18) * (r.h + 9) for r in spans) < 2.5 * 360 * 180  # rows at random: 4
