"""Map projection and polygons: closed-form UTM, hulls, point-in-polygon masks."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import scalar
from ..functions.workers import ship

#: The WGS 84 ellipsoid, and UTM's scale and false origins.
AXIS, FLATTENING, SCALE, EASTING, SOUTH = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0, 10000000.0
_N = FLATTENING / (2 - FLATTENING)
#: Rectifying radius and the coefficients of Krueger's series to the fourth order of n.
RADIUS = AXIS / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
FORWARD = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
INVERSE = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)
LATITUDE = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
    56 * _N**3 / 15 - 136 * _N**4 / 35,
    4279 * _N**4 / 630,
)


def utm_forward(lon: Column, lat: Column, zone: Column, south: Column) -> tuple[Column, Column]:
    """Easting and northing of geographic coordinates, as column expressions."""
    eccentric = F.lit(2 * math.sqrt(_N) / (1 + _N))
    phi, turn = F.radians(lat), F.radians(lon - (zone * 6 - 183))
    sine = F.sin(phi)
    t = F.sinh(F.atanh(sine) - eccentric * F.atanh(eccentric * sine))
    xi, eta = F.atan2(t, F.cos(turn)), F.atanh(F.sin(turn) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(FORWARD, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return EASTING + SCALE * RADIUS * x, F.when(south, F.lit(SOUTH)).otherwise(0.0) + SCALE * RADIUS * y


def utm_inverse(x: Column, y: Column, zone: Column, south: Column) -> tuple[Column, Column]:
    """Longitude and latitude of UTM coordinates, as column expressions."""
    xi = (y - F.when(south, F.lit(SOUTH)).otherwise(0.0)) / (SCALE * RADIUS)
    eta = (x - EASTING) / (SCALE * RADIUS)
    a, b = xi, eta
    for j, c in enumerate(INVERSE, 1):
        a = a - c * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        b = b - c * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(a) / F.cosh(b))
    lat = chi
    for j, c in enumerate(LATITUDE, 1):
        lat = lat + c * F.sin(2 * j * chi)
    return zone * 6 - 183 + F.degrees(F.atan2(F.sinh(b), F.cos(a))), F.degrees(lat)


def tile_box(lon: Column, lat: Column, reach: float = 0.2) -> Column:
    """Corner points of a box of `reach` degrees around a tile's centre."""
    corner = lambda dx, dy: F.struct((lon + dx).alias("x"), (lat + dy).alias("y"))
    return F.array(corner(-reach, -reach), corner(reach, -reach), corner(reach, reach), corner(-reach, reach))


def wkt(points: Column) -> Column:
    """A polygon's ring as WKT."""
    ring = F.concat(points, F.slice(points, 1, 1))
    said = F.transform(ring, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string")))
    return F.concat(F.lit("POLYGON (("), F.array_join(said, ", "), F.lit("))"))


def area_centroid(points: Column) -> Column:
    """Struct (area, x, y) of a simple polygon (array of struct x, y) by the shoelace formula."""
    ring = F.zip_with(points, F.concat(F.slice(points, 2, F.size(points)), F.slice(points, 1, 1)), lambda p, q: F.struct(p.alias("p"), q.alias("q")))
    cross = lambda e: e["p"]["x"] * e["q"]["y"] - e["q"]["x"] * e["p"]["y"]
    total = lambda f: F.aggregate(F.transform(ring, f), F.lit(0.0), lambda s, x: s + x)
    twice = total(cross)
    cx, cy = total(lambda e: (e["p"]["x"] + e["q"]["x"]) * cross(e)), total(lambda e: (e["p"]["y"] + e["q"]["y"]) * cross(e))
    return F.struct((F.abs(twice) / 2).alias("area"), (cx / (3 * twice)).alias("x"), (cy / (3 * twice)).alias("y"))


def union_measure(polygons: list[list[np.ndarray]]) -> tuple[float, float, float]:
    """Area and centroid of the union of polygons, each a list of rings (n, 2) by the even-odd rule.

    The plane is cut into horizontal slabs at every corner and every crossing of two edges. Within
    a slab edges don't cross, so the union is a row of trapezoids, which are summed exactly.
    """
    parts, levels = [], set()
    for number, rings in enumerate(polygons):
        for ring in rings:
            ring = np.asarray(ring, float)
            for (ax, ay), (bx, by) in zip(ring, np.roll(ring, -1, axis=0)):
                levels |= {ay, by}
                if ay != by:
                    parts.append((min(ay, by), max(ay, by), ax, ay, (bx - ax) / (by - ay), number))
    bottoms, tops, ex, ey, slope, _ = np.array(parts, float).reshape(-1, 6).T
    for i in range(len(parts)):  # where this edge crosses the later ones
        apart = slope[i] - slope[i + 1 :]
        with np.errstate(divide="ignore", invalid="ignore"):
            y = (ex[i + 1 :] - ex[i] + slope[i] * ey[i] - slope[i + 1 :] * ey[i + 1 :]) / apart
        levels.update(y[(apart != 0) & (y > np.maximum(bottoms[i], bottoms[i + 1 :])) & (y < np.minimum(tops[i], tops[i + 1 :]))].tolist())
    area = sx = sy = 0.0
    order = sorted(levels)
    for low, high in zip(order, order[1:]):
        at = lambda e, y: e[2] + (y - e[3]) * e[4]
        edges = sorted((parts[k] for k in np.flatnonzero((bottoms <= low) & (tops >= high))), key=lambda e: (at(e, (low + high) / 2), e[5]))
        odd: set[int] = set()
        for left, right in zip(edges, edges[1:]):
            odd ^= {left[5]}
            if not odd:
                continue
            a, b, c, d = at(left, low), at(right, low), at(left, high), at(right, high)
            below, above, tall = b - a, d - c, high - low
            piece = (below + above) * tall / 2
            if piece <= 0:
                continue
            area += piece
            sy += piece * low + tall * tall * (below + 2 * above) / 6
            sx += tall * (b * b - a * a + d * d - c * c + b * d - a * c) / 6
    return (area, sx / area, sy / area) if area else (0.0, math.nan, math.nan)


def _rings(frame: pd.DataFrame, by: list[str]) -> list[list[np.ndarray]]:
    """Polygons of rows (by..., points), each row a ring."""
    as_ring = lambda ring: np.array([[p["x"], p["y"]] for p in ring], float).reshape(-1, 2)
    return [[as_ring(r) for r in part["points"]] for _, part in frame.groupby(by)]


def union_centroid(polygons: DataFrame, points: str, by: list[str] | None = None) -> DataFrame:
    """area, x, y of the union of polygons; what several cover counts once.

    Rows are rings (by..., points); without by each row is a polygon. A region's outline is one
    task's work: it holds corners, not pixels.
    """
    ship(polygons.sparkSession)
    rows = polygons.select(*(by or []), F.col(points).alias("points"))
    if not by:
        rows, by = rows.withColumn("_polygon", F.monotonically_increasing_id()), ["_polygon"]

    def measure(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([union_measure(_rings(frame, by))], columns=["area", "x", "y"])

    return rows.withColumn("_all", F.lit(1)).groupBy("_all").applyInPandas(measure, "area double, x double, y double")


def best_epsg(polygons: DataFrame, points: str, by: list[str] | None = None) -> DataFrame:
    """epsg of the UTM zone of the centroid of the polygons' union (geographic coordinates)."""
    return union_centroid(polygons, points, by).select(scalar.utm_epsg(F.col("x"), F.col("y")).alias("epsg"))


def convex_hull(points: np.ndarray) -> np.ndarray:
    """Corners of the hull of points (n, 2), counter-clockwise, by the monotone chain."""
    points = np.unique(np.asarray(points, float), axis=0)
    if len(points) < 3:
        return points

    def half(rows) -> list:
        out: list = []
        for p in rows:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    return np.array(half(points) + half(points[::-1]))


def hulls(vertices: DataFrame, by: str) -> DataFrame:
    """by, points: the convex hull of the vertices (by, x, y) of each group.

    Each partition first keeps the hull of its own share, so a group of many vertices never
    meets in one task.
    """
    ship(vertices.sparkSession)
    made = f"{by} {dict(vertices.dtypes)[by]}, x double, y double"

    def local(batches):
        for frame in batches:
            for key, part in frame.groupby(by, dropna=False):
                hull = convex_hull(part[["x", "y"]].to_numpy())
                yield pd.DataFrame({by: [key] * len(hull), "x": hull[:, 0], "y": hull[:, 1]})

    def whole(frame: pd.DataFrame) -> pd.DataFrame:
        hull = convex_hull(frame[["x", "y"]].to_numpy())
        return pd.DataFrame({by: [frame[by].iloc[0]], "points": [[{"x": x, "y": y} for x, y in hull]]})

    shares = vertices.select(by, F.col("x").cast("double"), F.col("y").cast("double")).mapInPandas(local, made)
    return shares.groupBy(by).applyInPandas(whole, f"{by} {dict(vertices.dtypes)[by]}, points array<struct<x:double,y:double>>")


def inside(x: Column, y: Column, points: Column) -> Column:
    """Whether a point lies in a polygon (array of struct x, y), by crossings of a ray."""
    ring = F.zip_with(points, F.concat(F.slice(points, 2, F.size(points)), F.slice(points, 1, 1)), lambda p, q: F.struct(p.alias("p"), q.alias("q")))

    def crosses(e: Column) -> Column:
        p, q = e["p"], e["q"]
        spans = (p["y"] > y) != (q["y"] > y)
        return spans & (x < p["x"] + F.try_divide((q["x"] - p["x"]) * (y - p["y"]), q["y"] - p["y"]))

    return F.size(F.filter(ring, crosses)) % 2 == 1


def crossings(points: Column, y: Column) -> Column:
    """Ascending x at which the edges of a ring (array of struct x, y) pass a horizontal line."""
    ring = F.zip_with(points, F.concat(F.slice(points, 2, F.size(points)), F.slice(points, 1, 1)), lambda p, q: F.struct(p.alias("p"), q.alias("q")))
    passing = F.filter(ring, lambda e: (e["p"]["y"] > y) != (e["q"]["y"] > y))
    return F.array_sort(F.transform(passing, lambda e: e["p"]["x"] + (e["q"]["x"] - e["p"]["x"]) * (y - e["p"]["y"]) / (e["q"]["y"] - e["p"]["y"])))


def rasterize(polygons: DataFrame, key: str | list[str], points: str, pixel: float, left: float, top: float) -> DataFrame:
    """key..., col, row of the pixels of a grid whose centres lie in each polygon.

    A polygon is all rings of a key, holes and parts among them, by the even-odd rule. Each
    ring gives its crossings with the rows of pixels it spans; a row's crossings are sorted
    together and the pixels between each two are made, so the work is edges and pixels inside.
    """
    keys = [key] if isinstance(key, str) else key
    box = scalar.polygon_box(F.col(points))
    rows = polygons.filter(F.size(points) > 0).select(*keys, points, box.alias("_box"))
    first, last = F.floor((top - F.col("_box.y1")) / pixel), F.floor((top - F.col("_box.y0")) / pixel)
    rows = rows.withColumn("row", F.explode(F.sequence(first, last)))
    lines = rows.select(*keys, "row", crossings(F.col(points), top - (F.col("row") + 0.5) * pixel).alias("_x")).filter(F.size("_x") > 0)
    lines = lines.groupBy(*keys, "row").agg(F.array_sort(F.flatten(F.collect_list("_x"))).alias("_x"))
    lines = lines.withColumn("_k", F.explode(F.sequence(F.lit(0), F.floor(F.size("_x") / 2).cast("int") - 1)))
    # a centre lies inside from the first crossing on, up to but without the second
    edge = lambda k: F.ceil((F.get("_x", k) - left) / pixel - 0.5)
    spans = lines.select(*keys, "row", edge(2 * F.col("_k")).alias("_a"), (edge(2 * F.col("_k") + 1) - 1).alias("_b")).filter("_a <= _b")
    places = F.transform(F.sequence("_a", "_b"), lambda c: c.cast("int"))
    return spans.select(*keys, F.explode(places).alias("col"), F.col("row").cast("int").alias("row"))


def raster_frame(points: DataFrame, pixel: float) -> DataFrame:
    """left, top, width, height of the raster around points (x, y): extents over the pixel, rounded up, one at least."""
    box = points.agg(F.min("x").alias("left"), F.max("y").alias("top"), F.max("x").alias("_r"), F.min("y").alias("_b"))
    size = lambda a, b: F.ceil((F.col(a) - F.col(b)) / pixel).cast("int")
    made = box.select("left", "top", size("_r", "left").alias("width"), size("top", "_b").alias("height"))
    return made.withColumn("width", F.when((F.col("width") > 0) & (F.col("height") > 0), F.col("width")).otherwise(F.raise_error(F.lit("the region has no extent")).cast("int")))


def hull_mask(vertices: DataFrame, by: str, pixel: float, left: float, top: float) -> DataFrame:
    """by, col, row: the pixels in the convex hull of each group's vertices (by, x, y)."""
    return rasterize(hulls(vertices, by), by, "points", pixel, left, top)


#: Letters of MGRS columns (by zone modulo 3) and rows, and of latitude bands from 80 degrees south.
MGRS_COLUMNS, MGRS_ROWS, MGRS_BANDS = ("STUVWXYZ", "ABCDEFGH", "JKLMNPQR"), "ABCDEFGHJKLMNPQRSTUV", "CDEFGHJKLMNPQRSTUVWX"


def mgrs_corner(tile: Column) -> Column:
    """Struct (zone, south, x, y) of the south-west corner of a 100 km square such as 33UWP or 3VXG."""
    zone = F.regexp_extract(tile, r"^(\d{1,2})", 1).cast("int")
    letters = F.regexp_extract(tile, r"^\d{1,2}([A-Z]{3})", 1)
    place = lambda where, k: F.instr(where, F.substring(letters, k, 1)) - 1
    band = place(F.lit(MGRS_BANDS), 1)
    column = F.when(zone % 3 == 0, place(F.lit(MGRS_COLUMNS[0]), 2)).when(zone % 3 == 1, place(F.lit(MGRS_COLUMNS[1]), 2)).otherwise(place(F.lit(MGRS_COLUMNS[2]), 2))
    row = place(F.lit(MGRS_ROWS), 3)
    # even zones start their row letters five later; letters repeat every 2000 km, so the band says which time
    low = F.pmod(row - F.when(zone % 2 == 0, 5).otherwise(0), F.lit(20)) * 100_000.0
    south = band < 10
    # the northing of the band's southern edge at the zone's middle, within 100 km
    edge = utm_forward(zone * 6 - 183.0, band * 8.0 - 80, zone, south)[1]
    y = low + F.ceil((edge - 100_000.0 - low) / 2_000_000) * 2_000_000
    return F.struct(zone.alias("zone"), south.alias("south"), ((column + 1) * 100_000.0).alias("x"), y.alias("y"))


def tile_centre(tile: Column) -> Column:
    """Struct (lon, lat) of the middle of a 100 km square."""
    corner = mgrs_corner(tile)
    lon, lat = utm_inverse(corner["x"] + 50_000, corner["y"] + 50_000, corner["zone"], corner["south"])
    return F.struct(lon.alias("lon"), lat.alias("lat"))


def tile_circle(tile: Column, radius: float = 500.0, corners: int = 64) -> Column:
    """Corners (lon, lat as x, y) of the circle around the middle of a 100 km square, drawn in metres."""
    corner = mgrs_corner(tile)

    def at(k: Column) -> Column:
        turn = k * (2 * math.pi / corners)
        lon, lat = utm_inverse(corner["x"] + 50_000 + radius * F.cos(turn), corner["y"] + 50_000 + radius * F.sin(turn), corner["zone"], corner["south"])
        return F.struct(lon.alias("x"), lat.alias("y"))

    return F.transform(F.sequence(F.lit(0), F.lit(corners - 1)), at)


def clip_polygon(points: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """The part of a polygon (array of struct x, y) inside a box, as a ring; empty where they don't meet.

    One side of the box after the other cuts the ring: corners inside stay, and edges that pass
    the side give the point where they do.
    """

    def cut(ring: Column, axis: str, bound: Column, sign: int) -> Column:
        other = "y" if axis == "x" else "x"
        depth = lambda p: (p[axis] - bound) * sign
        edges = F.zip_with(ring, F.concat(F.slice(ring, 2, F.greatest(F.size(ring), F.lit(1))), F.slice(ring, 1, 1)), lambda p, q: F.struct(p.alias("p"), q.alias("q")))

        def kept(e: Column) -> Column:
            p, q = e["p"], e["q"]
            along = p[other] + (q[other] - p[other]) * F.try_divide(bound - p[axis], q[axis] - p[axis])
            met = F.struct(bound.alias("x"), along.alias("y")) if axis == "x" else F.struct(along.alias("x"), bound.alias("y"))
            corner = F.when(depth(p) >= 0, F.array(F.struct(p["x"].alias("x"), p["y"].alias("y"))))
            crossing = F.when((depth(p) > 0) & (depth(q) < 0) | (depth(p) < 0) & (depth(q) > 0), F.array(met))
            nothing = F.array().cast("array<struct<x:double,y:double>>")
            return F.concat(F.coalesce(corner, nothing), F.coalesce(crossing, nothing))

        return F.flatten(F.transform(edges, kept))

    box = [c.cast("double") for c in (x0, y0, x1, y1)]
    for axis, bound, sign in (("x", box[0], 1), ("y", box[1], 1), ("x", box[2], -1), ("y", box[3], -1)):
        points = cut(points, axis, bound, sign)
    return points


def _edges(points: Column) -> Column:
    """The edges of a ring as array of struct (p, q)."""
    return F.zip_with(points, F.concat(F.slice(points, 2, F.greatest(F.size(points), F.lit(1))), F.slice(points, 1, 1)), lambda p, q: F.struct(p.alias("p"), q.alias("q")))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, however often use names it."""
    return F.transform(F.array(value), use)[0]


def _side(p: Column, q: Column, r: Column) -> Column:
    """Positive where r lies left of the line from p to q."""
    return (q["x"] - p["x"]) * (r["y"] - p["y"]) - (q["y"] - p["y"]) * (r["x"] - p["x"])


def intersects(left: Column, right: Column) -> Column:
    """Whether two simple polygons (array of struct x, y) have a point in common: crossing or touching edges, or one inside the other."""

    def crossing(e: Column, f: Column) -> Column:
        a, b = _side(e["p"], e["q"], f["p"]), _side(e["p"], e["q"], f["q"])
        c, d = _side(f["p"], f["q"], e["p"]), _side(f["p"], f["q"], e["q"])
        meet = lambda k: (F.greatest(e["p"][k], e["q"][k]) >= F.least(f["p"][k], f["q"][k])) & (F.greatest(f["p"][k], f["q"][k]) >= F.least(e["p"][k], e["q"][k]))
        return (F.signum(a) * F.signum(b) <= 0) & (F.signum(c) * F.signum(d) <= 0) & meet("x") & meet("y")

    met = _let(_edges(right), lambda edges: F.exists(_edges(left), lambda e: F.exists(edges, lambda f: crossing(e, f))))
    return met | inside(left[0]["x"], left[0]["y"], right) | inside(right[0]["x"], right[0]["y"], left)


def clip_convex(points: Column, window: Column) -> Column:
    """The part of a polygon inside a convex one, as a ring; fewer than three corners where they have no area in common."""
    kind = "array<struct<x:double,y:double>>"
    turn = F.signum(F.aggregate(_edges(window), F.lit(0.0), lambda s, e: s + e["p"]["x"] * e["q"]["y"] - e["q"]["x"] * e["p"]["y"]))

    def cut(ring: Column, side: Column) -> Column:
        deep = F.transform(ring, lambda r: F.struct(r["x"].alias("x"), r["y"].alias("y"), (_side(side["p"], side["q"], r) * side["turn"]).alias("depth")))

        def kept(e: Column) -> Column:
            p, q = e["p"], e["q"]
            part = F.try_divide(p["depth"], p["depth"] - q["depth"])
            met = F.struct((p["x"] + (q["x"] - p["x"]) * part).alias("x"), (p["y"] + (q["y"] - p["y"]) * part).alias("y"))
            corner = F.when(p["depth"] >= 0, F.array(F.struct(p["x"].alias("x"), p["y"].alias("y"))))
            crossed = F.when((p["depth"] > 0) & (q["depth"] < 0) | (p["depth"] < 0) & (q["depth"] > 0), F.array(met))
            return F.concat(F.coalesce(corner, F.array().cast(kind)), F.coalesce(crossed, F.array().cast(kind)))

        return F.flatten(_let(deep, lambda corners: F.transform(_edges(corners), kept))).cast(kind)

    sides = _let(turn, lambda sign: F.transform(_edges(window), lambda e: F.struct(e["p"].alias("p"), e["q"].alias("q"), sign.alias("turn"))))
    return F.aggregate(sides, points.cast(kind), cut)


def tidy(points: Column) -> Column:
    """A ring without repeated neighbouring corners and without a closing one; empty where fewer than three are left."""
    same = lambda p, q: (p["x"] == q["x"]) & (p["y"] == q["y"])
    kept = F.filter(points, lambda p, k: (k == 0) | ~same(p, F.element_at(points, F.greatest(k, F.lit(1)))))
    closed = F.coalesce((F.size(kept) > 1) & same(F.get(kept, F.lit(0)), F.try_element_at(kept, F.lit(-1))), F.lit(False))
    ring = F.when(closed, F.slice(kept, 1, F.size(kept) - 1)).otherwise(kept)
    return F.when(F.size(ring) >= 3, ring).otherwise(F.slice(ring, 1, 0))


def same_polygon(left: Column, right: Column) -> Column:
    """Whether two rings have the same corners in the same cyclic order, in either direction."""
    n = F.size(left)
    turned = lambda ring, k: F.concat(F.slice(ring, k + 1, n), F.slice(ring, 1, k))
    either = lambda k: (turned(right, k) == left) | (turned(F.reverse(right), k) == left)
    return (n == F.size(right)) & F.exists(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), either)
