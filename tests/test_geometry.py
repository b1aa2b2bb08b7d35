import itertools
import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tagloom.functions import geometry, kernel, tiles
from tagloom.operators.limit import Limit
from tagloom.sources import geojson


@pytest.fixture(scope="module")
def geo(spark):
    return kernel.register(spark)


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_projection_and_back(spark):
    x, y = one(spark, geometry.project_x(F.lit(8.0)), geometry.project_y(F.lit(53.0)))
    assert (x, y) == (pytest.approx(890555.9263461898, abs=1e-6), pytest.approx(6982997.920389788, abs=1e-6))
    assert one(spark, geometry.unproject_x(F.lit(x)), geometry.unproject_y(F.lit(y))) == (pytest.approx(8.0), pytest.approx(53.0))


def test_quantize(spark):
    for v in (-180.0, -0.1, 0.0, 8.123456789, 179.9):
        q = one(spark, geometry.quantize(F.lit(v)))[0]
        assert 0 <= v - q <= 1 / 11930464.7083 + 1e-12


def wkt(spark, text, *fs):
    return one(spark, *[f(F.call_function("geo_from_wkt", F.lit(text))) for f in fs])


def test_bow_tie_is_repaired_by_a_buffer(geo):
    fixed = lambda g: kernel.repair(g)
    area, valid = wkt(geo, "POLYGON((0 0, 10 10, 10 0, 0 12, 0 0))", lambda g: kernel.area(fixed(g)), lambda g: kernel.call("ST_IsValid", fixed(g)))
    assert valid and area > 0


def multi(spark, ways, gap=0.1):
    rows = [([r for r, _, _ in w], [float(x) for _, x, _ in w], [float(y) for _, _, y in w]) for w in ways]
    df = spark.createDataFrame([(rows,)], "w array<struct<refs:array<bigint>,xs:array<double>,ys:array<double>>>")
    g = kernel.multipolygon(F.col("w"), F.lit(gap))
    return df.select(kernel.area(g), kernel.kind(g), kernel.call("ST_IsValid", g)).first()


def square(low, high, first):
    at = [(low, low), (high, low), (high, high), (low, high)]
    refs = [first, first + 1, first + 2, first + 3, first]
    return [(r, *p) for r, p in zip(refs, [*at, at[0]])]


def test_nested_holes(geo):
    area, kind, valid = multi(geo, [square(i, 10 - i, 10 * i + 1) for i in (0, 1, 2, 3, 4)])
    assert (area, kind, valid) == (100 - 64 + 36 - 16 + 4, "MultiPolygon", True)


@pytest.mark.parametrize("order", itertools.permutations(range(4)))
def test_fragments_in_any_order_and_direction(geo, order):
    ring = square(0, 10, 1)
    parts = [ring[i : i + 2] for i in range(4)]
    ways = [parts[i] if k % 2 else parts[i][::-1] for k, i in enumerate(order)]
    assert multi(geo, ways)[0] == 100


def test_gap_and_open_rings(geo):
    almost = [(1, 0, 0), (2, 10, 0), (3, 10, 10), (4, 0, 10), (5, 0, 0.05)]
    assert multi(geo, [almost])[0] == pytest.approx(100, abs=1)
    assert multi(geo, [almost], 0.01)[0] is None
    assert multi(geo, [square(0, 10, 1), [(50, 2, 2), (51, 3, 3)]])[0] == 100  # an open extra ring is ignored
    assert multi(geo, [[(1, 0, 0)]])[0] is None


def test_line_and_polygon_limits(geo):
    xs = lambda *v: F.array(*[F.lit(float(x)) for x in v])
    assert one(geo, kernel.line(xs(1, 1), xs(2, 2)))[0] is None
    assert one(geo, kernel.size(kernel.line(xs(0, 3), xs(0, 4))))[0] == 5
    assert one(geo, kernel.polygon(xs(0, 1, 0), xs(0, 1, 0)))[0] is None
    assert one(geo, kernel.area(kernel.polygon(xs(0, 2, 2, 0), xs(0, 0, 2, 0))))[0] == 2


def test_functions_compile_where_spark_is_a_zip(tmp_path):
    """A fresh Python that takes pyspark from its zip, as a cluster's driver may."""
    import glob
    import os
    import subprocess
    import sys

    import pyspark

    home = os.path.dirname(pyspark.__file__)
    zips = glob.glob(f"{home}/python/lib/*.zip")
    if not zips:
        pytest.skip("no zip of pyspark here")
    code = """
import pyspark
from pyspark.sql import SparkSession, functions as F
from tagloom.functions import kernel
assert ".zip" in pyspark.__file__, pyspark.__file__
s = kernel.register(SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate())
print("found", s.range(1).select(kernel.kind(kernel.point(F.lit(1.0), F.lit(2.0)))).first()[0])
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    (tmp_path / "run.py").write_text(code)
    env = dict(os.environ, SPARK_HOME=home, PYTHONPATH=os.pathsep.join([*zips, root]))
    done = subprocess.run([sys.executable, str(tmp_path / "run.py")], env=env, capture_output=True, text=True, timeout=180, check=False)
    assert "found Point" in done.stdout, done.stderr[-2000:]


def test_ewkb(geo):
    h = one(geo, geometry.ewkb_hex(kernel.point(F.lit(1.0), F.lit(2.0)), 3857))[0]
    assert h == "0101000020110F0000000000000000F03F0000000000000040"
    assert one(geo, geometry.ewkb_hex(F.lit(None).cast("binary"), 3857))[0] == ""


def limit(spark, srid=4326, buffer=0.0):
    box = [[0, 0], [10, 0], [10, 10], [0, 10], [0, 0]]
    return Limit.of(spark, geojson.parse('{"type": "Polygon", "coordinates": [%s]}' % box), srid, buffer)


def test_clip(geo):
    def parts(text):
        g = F.call_function("geo_from_wkt", F.lit(text))
        d = geo.range(1).select(F.explode(limit(geo).parts(g)).alias("g"))
        return [tuple(r) for r in d.select(kernel.kind("g"), F.round(kernel.size(F.col("g")), 6), F.round(kernel.area(F.col("g")), 6)).collect()]

    assert parts("POINT(20 20)") == []
    assert parts("POINT(5 5)") == [("Point", 0, 0)]
    assert sorted(parts("LINESTRING(-5 2, 5 2, 5 20, 6 20, 6 5)")) == [("LineString", 5, 0), ("LineString", 13, 0)]
    assert parts("LINESTRING(1 1, 9 9)") == [("LineString", round(math.hypot(8, 8), 6), 0)]
    assert parts("POLYGON((5 5, 15 5, 15 15, 5 15, 5 5))")[0][2] == 25


def test_lines_that_cross_themselves_are_clipped_as_their_steps_are(geo):
    """Random lines against a box, step by step; places are tenths, so that steps meet at places without exact coordinates."""
    r = random.Random(5)
    lines = [(i, [r.randrange(-200, 300) / 10 for _ in range(7)], [r.randrange(-200, 300) / 10 for _ in range(7)]) for i in range(5000)]

    def inside(x, y, dx, dy):
        t0, t1 = 0.0, 1.0
        for at, step in ((x, dx), (y, dy)):
            if step:
                a, b = sorted(((0 - at) / step, (10 - at) / step))
                t0, t1 = max(t0, a), min(t1, b)
            elif not 0 <= at <= 10:
                return 0.0
        return max(0.0, t1 - t0) * math.hypot(dx, dy)

    want = {i: sum(inside(a, b, c - a, d - b) for a, b, c, d in zip(x, y, x[1:], y[1:], strict=False)) for i, x, y in lines}
    d = geo.createDataFrame(lines, "id bigint, x array<double>, y array<double>").select("id", kernel.line(F.col("x"), F.col("y")).alias("g"))
    got = dict(d.select("id", F.explode(limit(geo).parts(F.col("g"))).alias("p")).groupBy("id").agg(F.sum(kernel.size(F.col("p")))).collect())
    assert all(got.get(i, 0.0) == pytest.approx(w, abs=1e-6) for i, w in want.items())


def test_halved_limit_covers_the_whole_and_clips_the_same(geo):
    """A wavy outline of many corners: its parts add up to it, and clipping by a part is clipping by the whole."""
    n = 600
    ring = [[(10 + math.sin(11 * t)) * math.cos(t), (10 + math.sin(11 * t)) * math.sin(t)] for t in (2 * math.pi * i / n for i in range(n))]
    area = Limit.of(geo, geojson.parse('{"type": "Polygon", "coordinates": [%s]}' % [*ring, ring[0]]), 4326)
    whole = F.lit(bytearray(area.wkb))
    cells = geo.range(1).select(F.explode(F.call_function("geo_cells", whole, F.lit(0.5))).alias("g"))
    n_cells, total = cells.agg(F.count("g"), F.sum(kernel.area(F.col("g")))).first()
    assert n_cells > 4 and total == pytest.approx(geo.range(1).select(kernel.area(whole)).first()[0], rel=1e-9)
    boxes = geo.range(400).select((F.col("id") % 20 * 1.2 - 12).alias("x"), (F.floor(F.col("id") / 20) * 1.2 - 12).alias("y"))
    g = kernel.polygon(F.array("x", F.col("x") + 1, F.col("x") + 1, "x", "x"), F.array("y", "y", F.col("y") + 1, F.col("y") + 1, "y"))
    cut = lambda c: F.round(kernel.area(c), 9)
    both = boxes.select(area.parts(g).alias("p"), cut(kernel.call("ST_Intersection", g, whole)).alias("b"))
    rows = both.select(F.when(F.size("p") > 0, cut(F.get("p", F.lit(0)))).otherwise(0.0).alias("a"), "b").collect()
    assert all(abs(r.a - r.b) < 1e-6 for r in rows) and sum(0 < r.b < 1 for r in rows) > 20


def test_near(geo):
    nodes = geo.createDataFrame([(1, 5.0, 5.0), (2, 10.5, 5.0), (3, 12.0, 5.0)], "id bigint, lon double, lat double")
    assert {r.id for r in limit(geo, buffer=1.0).near(nodes).collect()} == {1, 2}


def test_geojson():
    f = geojson.parse('{"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"a": 1, "b": 1.5, "c": 1e30, "d": true}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[0,0],[1,0],[1,1],[0,0]]], [[[5,5],[6,5],[6,6],[5,5]]]]}}]}')
    assert len(f) == 2 and f[0].properties == {"a": "1", "b": "1.5", "c": "1e+30", "d": "true"}
    with pytest.raises(ValueError):
        geojson.parse('{"type": "Point", "coordinates": [1, 2]}')


# --- tiles, against a plain restatement ---


def tile(lon, lat, z):
    n = 2**z
    return (lon + 180) / 360 * n, (1 - math.log(math.tan((90 + lat) * math.pi / 360)) / math.pi) / 2 * n


def plain_line(points, z):
    out = set()
    for (a, b), (c, d) in zip(points, points[1:]):
        x1, y1 = tile(a, b, z)
        x2, y2 = tile(c, d, z)
        end = (int(x2), int(y2))
        if (int(x1), int(y1)) != end:
            dx, dy, sx, sy = abs(x2 - x1), abs(y2 - y1), (1 if x2 > x1 else -1), (1 if y2 > y1 else -1)
            u, v = (x1, y1) if dx >= dy else (y1, x1)
            su, sv, du, dv = (sx, sy, dx, dy) if dx >= dy else (sy, sx, dy, dx)
            e, i = 2 * dv - du, 0
            while i < du:
                out.add((int(u), int(v)) if dx >= dy else (int(v), int(u)))
                while e >= 0:
                    v, e = v + sv, e - 2 * du
                u, e, i = u + su, e + 2 * dv, i + 1
        out.add(end)
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.floats(7.9, 8.3), st.floats(52.8, 53.2)), min_size=2, max_size=6))
def test_line_tiles(spark, points):
    df = spark.createDataFrame([([p for p in points],)], "p array<struct<x:double,y:double>>")
    got = df.select(tiles.line_tiles(F.col("p"), F.lit(14))).first()[0]
    assert {(t["x"], t["y"]) for t in got} == plain_line(points, 14)


@pytest.mark.parametrize(("closed", "points", "zoom"), [(True, [(8.0, 53.0), (8.01, 53.01), (8.0, 53.01), (8.0, 53.0)], 14), (True, [(8.0, 53.0), (9.0, 53.0), (9.0, 54.0), (8.0, 53.0)], 10), (True, [(-180.0, -85.0), (180.0, 85.0)], 2), (False, [(-180.0, -85.0), (180.0, 85.0)], 4)])
def test_zoom(spark, closed, points, zoom):
    df = spark.createDataFrame([(points,)], "p array<struct<x:double,y:double>>")
    assert df.select(tiles.zoom_for(tiles.box(F.col("p")), F.lit(closed), 14)).first()[0] == zoom


def test_point_tiles(spark):
    n = lambda lon, lat: len(one(spark, tiles.point_tiles(F.lit(lon), F.lit(lat), F.lit(14)))[0])
    mid = 360 / 2**14
    assert (n(mid * 2.5 - 180, 53.0) in (1, 2), n(0.0, 0.0), n(0.0, 90.0)) == (True, 4, 0)
