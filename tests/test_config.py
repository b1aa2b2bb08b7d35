import json
from datetime import timedelta

import pytest
from test_engine import CHANGES, ROWS, change_xml, node, write_xml

from tagloom import cli, config


def test_overlay_and_checks(tmp_path):
    p = tmp_path / "c.json"
    p.write_text(json.dumps({"mapping": "m.yml", "srid": 4326, "limit_to": "a.geojson", "replication_interval": "30s", "expire_tiles_zoom": 3, "unknown": 1}))
    o = config.load(str(p), {"limit_to": "NONE", "srid": None})
    assert (o.srid, o.limit_to, o.replication_interval, o.expire_tiles_zoom) == (4326, "", timedelta(minutes=1), 14)
    for bad in ({}, {"mapping": "m", "srid": 900913}):
        with pytest.raises(config.ConfigError):
            config.load(None, bad)
    with pytest.raises(config.ConfigError):
        config.check_import(None, True, False, True, False, False, False)


@pytest.mark.parametrize(("text", "seconds"), [(5, 300), ("1h30m", 5400), ("90s", 90), ("1.5h", 5400)])
def test_durations(text, seconds):
    assert config.duration(text).total_seconds() == seconds


def test_commands(spark, tmp_path, capsys):
    (tmp_path / "m.yml").write_text("tables: {places: {type: point, mapping: {place: [__any__]}, columns: [{name: osm_id, type: id}, {name: name, key: name, type: string}]}}")
    base = ["--mapping", str(tmp_path / "m.yml"), "--store", str(tmp_path / "store"), "--state-dir", str(tmp_path / "state")]
    run = lambda *a: cli.main([a[0], *base, *a[1:]], spark)
    places = lambda: {r.osm_id: r.name for r in spark.read.parquet(str(tmp_path / "store/public/osm_places")).collect()}
    run("import", "--read", write_xml(tmp_path / "a.osm", ROWS), "--write", "--diff", "--deploy")
    assert places() == {20: "Town", 21: ""}
    run("import", "--read", write_xml(tmp_path / "b.osm", [node(20, 8.2, 53.2, place="city", name="Other"), node(30, 8, 53, place="x")]), "--append", "--write", "--deploy")
    assert places() == {20: "Other", 21: "", 30: ""}
    (tmp_path / "7.osc").write_bytes(change_xml(CHANGES))
    run("diff", str(tmp_path / "7.osc"))
    assert places() == {20: "New Town", 22: ""}  # from the state of the first import
    run("lookup", "node", "20", "12345")
    out = capsys.readouterr().out.split("\n")
    assert json.loads(out[0])["tags"]["name"] == "New Town" and out[1] == "null"

