"""Map tiles that a changed geometry makes stale, as built-in expressions over lon/lat in degrees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geometry import POLE, project_x, project_y, unproject_x, unproject_y

#: Padding of a point in tiles, and the most tiles of a box and of a line before the zoom goes down.
PADDING = 0.2
MOST_BOX, MOST_LINE = 64, 500
TILES = "array<struct<z:int,x:int,y:int>>"


def tile_xy(lon: Column, lat: Column, zoom: Column) -> Column:
    """struct(x, y), fractional; (-1, -1) outside the square."""
    x, y = project_x(lon), project_y(lat)
    size = 2 * POLE / F.pow(F.lit(2.0), zoom)
    inside = x.between(-POLE, POLE) & y.between(-POLE, POLE)
    return F.when(inside, F.struct(((x + POLE) / size).alias("x"), ((POLE - y) / size).alias("y"))).otherwise(F.struct(F.lit(-1.0).alias("x"), F.lit(-1.0).alias("y")))


def _none() -> Column:
    return F.expr(f"cast(array() as {TILES})")


def _grid(z: Column, x1: Column, x2: Column, y1: Column, y2: Column) -> Column:
    """All tiles of a rectangle; empty when it is upside down."""
    down = lambda v: F.floor(F.greatest(v, F.lit(0.0))).cast("int")
    xs, ys = F.sequence(down(x1), down(x2)), F.sequence(down(y1), down(y2))
    tile = lambda x, y: F.struct(z.cast("int").alias("z"), x.alias("x"), y.alias("y"))
    made = F.flatten(F.transform(xs, lambda x: F.transform(ys, lambda y: tile(x, y))))
    return F.when((down(x1) <= down(x2)) & (down(y1) <= down(y2)), made).otherwise(_none())


def point_tiles(lon: Column, lat: Column, zoom: Column) -> Column:
    """The point's tile and those within a padding of it; negative tiles are cut off at 0."""
    t = tile_xy(lon, lat, zoom)
    return F.when(t["x"] < 0, _none()).otherwise(_grid(zoom, t["x"] - PADDING, t["x"] + PADDING, t["y"] - PADDING, t["y"] + PADDING))


def box(points: Column) -> Column:
    """Least and greatest lon and lat of points (x, y), without those at (0, 0)."""
    p = F.filter(points, lambda p: (p["x"] != 0) | (p["y"] != 0))
    xs, ys = F.transform(p, lambda p: p["x"]), F.transform(p, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"), F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy"))


def square(b: Column) -> Column:
    """A box in the unit square of zoom 0, struct(x1, y1, x2, y2); null when it is empty or a corner is outside."""
    p, q = tile_xy(b["minx"], b["maxy"], F.lit(0)), tile_xy(b["maxx"], b["miny"], F.lit(0))
    corners = F.struct(p["x"].alias("x1"), p["y"].alias("y1"), q["x"].alias("x2"), q["y"].alias("y2"))
    return F.when((p["x"] >= 0) & (q["x"] >= 0) & b["minx"].isNotNull(), corners)


def _size(u: Column, zoom: Column) -> Column:
    """Tiles that a box of the unit square covers, as a whole number."""
    n = F.pow(F.lit(2.0), zoom)
    return F.floor(F.abs(((u["x2"] - u["x1"]) * n + 1) * ((u["y2"] - u["y1"]) * n + 1)))


def _zoom(u: Column, closed: Column, max_zoom: int) -> Column:
    """The zoom of zoom_for() from the unit square: the number of tiles is a quadratic in the scale, whose root gives
    the zoom but for rounding, so its neighbours are tried as well."""
    limit = F.when(closed, F.lit(MOST_BOX)).otherwise(F.lit(MOST_LINE))
    a, b = u["x2"] - u["x1"], u["y2"] - u["y1"]
    scale = 2.0 * (limit - 1) / (a + b + F.sqrt((a + b) * (a + b) + 4.0 * a * b * (limit - 1)))
    guess = F.when(a + b > 0, F.floor(F.log2(scale)).cast("int")).otherwise(F.lit(max_zoom))
    near = F.transform(F.array(F.lit(1), F.lit(0), F.lit(-1)), lambda d: F.greatest(F.lit(1), F.least(guess + d, F.lit(max_zoom))))
    fits = F.filter(near, lambda z: _size(u, z) < limit)
    # A box outside the square covers no tile, so it fits at every zoom.
    return F.when(u.isNull(), F.lit(max_zoom)).otherwise(F.coalesce(F.get(fits, F.lit(0)), F.lit(0)))


def zoom_for(b: Column, closed: Column, max_zoom: int) -> Column:
    """The highest zoom, from max_zoom down to 1, at which the box has few enough tiles; 0 when there is none."""
    return _let(square(b), lambda u: _zoom(u, closed, max_zoom))


def _box_tiles(u: Column, zoom: Column) -> Column:
    n = F.pow(F.lit(2.0), zoom)
    return F.when(u.isNull(), _none()).otherwise(_grid(zoom, u["x1"] * n, u["x2"] * n, u["y1"] * n, u["y2"] * n))


def box_tiles(b: Column, zoom: Column) -> Column:
    return _let(square(b), lambda u: _box_tiles(u, zoom))


def _walk(p: Column, q: Column, zoom: Column) -> Column:
    """Tiles from p to q. The walk goes one tile along the longer axis at a time; how often it has stepped along
    the other one by then is a floor of a ratio, so no state is carried."""
    dx, dy = F.abs(q["x"] - p["x"]), F.abs(q["y"] - p["y"])
    steep = dy > dx
    long, short = F.greatest(dx, dy), F.least(dx, dy)
    sign = lambda a, b: F.when(b > a, F.lit(1.0)).otherwise(F.lit(-1.0))
    sx, sy = sign(p["x"], q["x"]), sign(p["y"], q["y"])

    def tile(i: Column) -> Column:
        k = F.when(i == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.floor((2 * short - long + 2 * short * (i - 1)) / (2 * long)) + 1))
        x = p["x"] + F.when(steep, sx * k).otherwise(sx * i)
        y = p["y"] + F.when(steep, sy * i).otherwise(sy * k)
        return F.struct(zoom.cast("int").alias("z"), x.cast("int").alias("x"), y.cast("int").alias("y"))

    last = F.struct(zoom.cast("int").alias("z"), q["x"].cast("int").alias("x"), q["y"].cast("int").alias("y"))
    steps = F.when(long > 0, F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(long).cast("int") - 1))).otherwise(F.expr("cast(array() as array<int>)"))
    same = (p["x"].cast("int") == q["x"].cast("int")) & (p["y"].cast("int") == q["y"].cast("int"))
    return F.when(same, F.array(last)).otherwise(F.concat(F.transform(steps, tile), F.array(last)))


def line_tiles(points: Column, zoom: Column) -> Column:
    """Tiles along a line; segments with an end at (0, 0) are skipped, and nothing follows a segment that leaves the square."""
    at = F.transform(points, lambda p: F.struct(tile_xy(p["x"], p["y"], zoom).alias("t"), ((p["x"] == 0) & (p["y"] == 0)).alias("empty")))
    pairs = F.transform(F.sequence(F.lit(0), F.size(points) - 2), lambda i: F.struct(F.get(at, i).alias("a"), F.get(at, i + 1).alias("b")))

    def step(acc: Column, s: Column) -> Column:
        skip = s["a"]["empty"] | s["b"]["empty"]
        out = ~skip & ((s["a"]["t"]["x"] < 0) | (s["b"]["t"]["x"] < 0))
        more = F.concat(acc["tiles"], _walk(s["a"]["t"], s["b"]["t"], zoom))
        return F.struct(F.when(skip | out | acc["done"], acc["tiles"]).otherwise(more).alias("tiles"), (acc["done"] | out).alias("done"))

    walked = F.aggregate(pairs, F.struct(_none().alias("tiles"), F.lit(False).alias("done")), step, lambda a: a["tiles"])
    one = F.get(points, F.lit(0))
    return F.when(F.size(points) == 0, _none()).when(F.size(points) == 1, point_tiles(one["x"], one["y"], zoom)).otherwise(F.array_distinct(walked))


def _let(value: Column, f) -> Column:
    """f of a value that is computed once: the name is bound by a lambda, so the expression does not grow."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def geometry_tiles(points: Column, closed: Column, max_zoom: int) -> Column:
    """Stale tiles of a line or an area (x = lon, y = lat): the box or the line at the highest zoom that has few tiles."""

    def at(u: Column, z: Column) -> Column:
        return F.when((F.size(points) == 0) | (z == 0), _none()).when(closed, _box_tiles(u, z)).otherwise(line_tiles(points, z))

    return _let(box(points), lambda b: _let(square(b), lambda u: _let(_zoom(u, closed, max_zoom), lambda z: at(u, z))))


def projected_tiles(points: Column, closed: Column, max_zoom: int) -> Column:
    """geometry_tiles() of points in web mercator."""
    return _let(F.transform(points, lambda p: F.struct(unproject_x(p["x"]).alias("x"), unproject_y(p["y"]).alias("y"))), lambda q: geometry_tiles(q, closed, max_zoom))
