"""Queries on grids, boxes, rasters and whole pipelines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar, storage
from ..operators import geometry, grid, scenes, series
from ..sources import arrays
from .registry import query, table, vectors

#: The proxies' rasters: lineitem's keys as pixels (at least so many), vectors as a map of 20 in a row.
WIDTH, HEIGHT, CELL = 2000, 100, 20
ORIGIN_X, ORIGIN_Y, STEP = 500000.0, 5300080.0, 10.0


def _raster(spark, d):
    """Width and height that hold every key of lineitem, WIDTH x HEIGHT at least."""
    most = table(spark, d, "lineitem").agg(F.max("l_partkey").alias("x"), F.max("l_suppkey").alias("y")).first()
    return max(WIDTH, most.x or 0), max(HEIGHT, most.y or 0)


def _roi(spark, d):
    """row, col, v: pixels of lineitem; v is set where the quantity is high."""
    rows = table(spark, d, "lineitem")
    return rows.groupBy((F.col("l_suppkey") - 1).alias("row"), (F.col("l_partkey") - 1).alias("col")).agg(F.max((F.col("l_quantity") > 48).cast("int")).alias("v"))


_ROI = """
    SELECT l_suppkey - 1 AS row, l_partkey - 1 AS col, max(CASE WHEN l_quantity > 48 THEN 1 ELSE 0 END) AS v FROM lineitem GROUP BY ALL
"""
_SIZE = f"SELECT greatest({WIDTH}, max(l_partkey)) AS w, greatest({HEIGHT}, max(l_suppkey)) AS h FROM lineitem"
_GRID = f"""
    SELECT CAST(px AS INTEGER) AS px, CAST(py AS INTEGER) AS py, px * {CELL} AS x0, py * {CELL} AS y0, least(px * {CELL} + {CELL}, w) AS x1, least(py * {CELL} + {CELL}, h) AS y1
    FROM (SELECT w, h, unnest(range((w + {CELL} - 1) // {CELL})) AS px FROM ({_SIZE})), (SELECT unnest(range((h + {CELL} - 1) // {CELL})) AS py FROM ({_SIZE}))
"""


@query(f"""
    WITH r AS ({_ROI}), g AS ({_GRID}), h AS (SELECT DISTINCT col // {CELL} AS px, row // {CELL} AS py FROM r WHERE v <> 0)
    SELECT x0 || '_' || y0 || '_' || x1 || '_' || y1 AS patch_id, g.px, g.py FROM g JOIN h ON g.px = h.px AND g.py = h.py
""")
def patch_grid_nonzero(spark, d):
    patches = grid.patch_grid(spark, *_raster(spark, d), CELL)
    return grid.patches_with_data(patches, _roi(spark, d), CELL).select("patch_id", "px", "py")


def _boxes(spark, d):
    """Boxes of customers (patches) and suppliers (tiles) on a synthetic map."""
    c, s = F.col("c_custkey"), F.col("s_suppkey")
    x, y = (c * 37 % 1000).cast("double"), (c * 91 % 700).cast("double")
    left = table(spark, d, "customer").select(c.alias("patch"), x.alias("x0"), y.alias("y0"), (x + 10).alias("x1"), (y + 10).alias("y1"))
    x, y = (s * 53 % 900).cast("double"), (s * 29 % 600).cast("double")
    right = table(spark, d, "supplier").select(s.alias("tile"), x.alias("x0"), y.alias("y0"), (x + 40).alias("x1"), (y + 30).alias("y1"))
    return left, right


_BOXES = """
    l AS (SELECT c_custkey AS patch, (c_custkey * 37 % 1000)::DOUBLE AS x0, (c_custkey * 91 % 700)::DOUBLE AS y0, x0 + 10 AS x1, y0 + 10 AS y1 FROM customer),
    r AS (SELECT s_suppkey AS tile, (s_suppkey * 53 % 900)::DOUBLE AS x0, (s_suppkey * 29 % 600)::DOUBLE AS y0, x0 + 40 AS x1, y0 + 30 AS y1 FROM supplier)
"""
_TOUCH = "l.x1 >= r.x0 AND l.x0 <= r.x1 AND l.y1 >= r.y0 AND l.y0 <= r.y1"


@query(f"WITH {_BOXES} SELECT patch, tile FROM l JOIN r ON {_TOUCH}")
def patch_tile_overlap(spark, d):
    return grid.overlapping(*_boxes(spark, d), 64.0, "patch", "tile")


@query(f"""
    WITH {_BOXES}, a AS (
        SELECT patch, tile, 1 AS tier FROM l JOIN r ON {_TOUCH}
        UNION ALL SELECT patch, tile, 2 FROM l JOIN r ON l.x1 + 1 >= r.x0 AND l.x0 - 1 <= r.x1 AND l.y1 + 1 >= r.y0 AND l.y0 - 1 <= r.y1
        UNION ALL SELECT patch, tile, 3 FROM l, r),
    b AS (SELECT *, rank() OVER (PARTITION BY patch ORDER BY tier) AS k FROM a)
    SELECT patch, tile, CAST(tier AS INTEGER) AS tier FROM b WHERE k = 1
""")
def patch_tile_overlap_tiers(spark, d):
    return grid.overlapping_tiers(*_boxes(spark, d), 64.0, 1.0, "patch", "tile")


@query(f"""
    WITH r AS ({_ROI}), w AS (SELECT col - 100 AS wx, row - 3 AS wy, v FROM r WHERE col BETWEEN 100 AND 119 AND row BETWEEN 3 AND 10),
         g AS (SELECT k AS cell, k % 25 AS wx, k // 25 AS wy FROM (SELECT unnest(range(250)) AS k))
    SELECT cell, CAST(coalesce(v, 0) AS INTEGER) AS v, v IS NOT NULL AS valid FROM g LEFT JOIN w ON g.wx = w.wx AND g.wy = w.wy
""")
def window_extract_pad(spark, d):
    held = grid.extract_window(_roi(spark, d), 100, 3, 20, 8).select((F.col("wy") * 25 + F.col("wx")).alias("cell"), "v", F.lit(True).alias("valid"))
    return grid.dense(spark, held, "cell", 250, {"v": F.lit(0), "valid": F.lit(False)}).select("cell", "v", "valid")


@query("""
    SELECT k AS cell, round(coalesce(embedding[1], 0)::DOUBLE, 6) AS first, CAST(coalesce(len(embedding), 64) AS INTEGER) AS n
    FROM (SELECT unnest(range((SELECT greatest(3000, max(vec_id) + 1) FROM embeddings))) AS k) LEFT JOIN embeddings ON vec_id = k
""")
def dense_scatter(spark, d):
    sparse = table(spark, d, "embeddings").select(F.col("vec_id").alias("cell"), F.col("embedding").alias("vec"))
    cells = grid.dense(spark, sparse, "cell", max(3000, vectors(spark, d)), {"vec": F.array_repeat(F.lit(0.0).cast("float"), 64)})
    return cells.select("cell", F.round(F.col("vec")[0].cast("double"), 6).alias("first"), F.size("vec").alias("n"))


def _map(spark, d):
    """A map of the first elements of all vectors, 20 in a row."""
    rows = table(spark, d, "embeddings")
    return rows.select((F.col("vec_id") % 20).cast("int").alias("col"), F.expr("vec_id div 20").cast("int").alias("row"), F.col("embedding")[0].cast("double").alias("v"), "vec_id")


def _rows(spark, d):
    """Rows of _map()."""
    return -(-vectors(spark, d) // 20)


_MAP = "SELECT CAST(vec_id % 20 AS INTEGER) AS col, CAST(vec_id // 20 AS INTEGER) AS row, embedding[1]::DOUBLE AS v, vec_id FROM embeddings"
#: Rows of the map, and of the map that is 8 / 5 as high.
_HIGH = "SELECT r, (r * 8 + 4) // 5 AS t FROM (SELECT (max(vec_id) + 20) // 20 AS r FROM embeddings)"


@query(f"""
    WITH m AS ({_MAP}), s AS (SELECT col, row, v, 0 AS ord FROM m UNION ALL SELECT col + 10, row + 5, -v, 1 FROM m)
    SELECT CAST(col AS INTEGER) AS col, CAST(row AS INTEGER) AS row, round(arg_max(v, ord), 6) AS v FROM s GROUP BY col, row
""")
def stitch_last_wins(spark, d):
    first = _map(spark, d).select("col", "row", "v", F.lit(0).alias("ord"), F.lit(0).alias("ox"), F.lit(0).alias("oy"))
    second = _map(spark, d).select("col", "row", (-F.col("v")).alias("v"), F.lit(1).alias("ord"), F.lit(10).alias("ox"), F.lit(5).alias("oy"))
    return grid.stitch(first.unionByName(second), "v", ["ord"]).withColumn("v", F.round("v", 6))


@query(f"""
    WITH m AS ({_MAP}), g AS (SELECT CAST(k % 30 AS INTEGER) AS col, CAST(k // 30 AS INTEGER) AS row, k % 30 * (20 / 30) AS x, k // 30 * (r / t) AS y, r FROM (SELECT r, t, unnest(range(30 * t)) AS k FROM ({_HIGH}))),
    c AS (SELECT col, row, floor(x) AS x0, least(floor(x) + 1, 19) AS x1, floor(y) AS y0, least(floor(y) + 1, r - 1) AS y1, x - floor(x) AS fx, y - floor(y) AS fy FROM g)
    SELECT c.col, c.row, round(a.v * (1 - fx) * (1 - fy) + b.v * fx * (1 - fy) + e.v * (1 - fx) * fy + f.v * fx * fy, 5) AS v FROM c
    JOIN m a ON a.col = x0 AND a.row = y0 JOIN m b ON b.col = x1 AND b.row = y0 JOIN m e ON e.col = x0 AND e.row = y1 JOIN m f ON f.col = x1 AND f.row = y1
""")
def bilinear_resample(spark, d):
    rows = _rows(spark, d)
    return grid.bilinear(spark, _map(spark, d), "v", (20, rows), (30, -(-rows * 8 // 5))).withColumn("v", F.round("v", 5))


@query(f"""
    WITH m AS ({_MAP}), g AS (SELECT CAST(k % 30 AS INTEGER) AS col, CAST(k // 30 AS INTEGER) AS row, r, t FROM (SELECT r, t, unnest(range(30 * t)) AS k FROM ({_HIGH})))
    SELECT g.col, g.row, round(v, 6) AS v FROM g JOIN m ON m.col = least(floor((g.col + 0.5) * 20 / 30), 19) AND m.row = least(floor((g.row + 0.5) * r / t), r - 1)
""")
def nearest_resample(spark, d):
    rows = _rows(spark, d)
    return grid.nearest(spark, _map(spark, d), "v", (20, rows), (30, -(-rows * 8 // 5))).withColumn("v", F.round("v", 6))


@query(f"""
    WITH r AS ({_ROI}), q AS (SELECT r.* FROM r, ({_SIZE}) WHERE col < w // 7 * 7 AND row < h // 7 * 7)
    SELECT CAST(col // 7 AS INTEGER) AS col, CAST(row // 7 AS INTEGER) AS row, round(avg(v), 6) AS v FROM q GROUP BY col // 7, row // 7
""")
def block_mean(spark, d):
    return grid.block_mean(_roi(spark, d), "v", 7, *_raster(spark, d)).withColumn("v", F.round("v", 6))


@query(f"""
    WITH m AS ({_MAP}), b AS (SELECT col // 2 AS col, row // 2 AS row, avg(v) AS v FROM m, ({_HIGH}) WHERE row < r // 2 * 2 GROUP BY col // 2, row // 2)
    SELECT CAST(col AS INTEGER) AS col, CAST(row AS INTEGER) AS row, round(v, 6) AS v, {ORIGIN_X} + {STEP} * 2 * col AS x, {ORIGIN_Y} - {STEP} * 2 * row AS y FROM b
""")
def downsample_export(spark, d):
    small = grid.block_mean(_map(spark, d), "v", 2, 20, _rows(spark, d))
    return small.select("col", "row", F.round("v", 6).alias("v"), scalar.to_world(F.col("col"), ORIGIN_X, 2 * STEP).alias("x"), scalar.to_world(F.col("row"), ORIGIN_Y, -2 * STEP).alias("y"))


@query(f"""
    WITH r AS ({_ROI}), c AS (SELECT count(*) AS total, count(*) FILTER (v <> 0) AS roi_pixels, count(*) FILTER (col % 3 = 0) AS touched, count(*) FILTER (col % 3 = 0 AND v <> 0) AS touched_roi FROM r)
    SELECT *, round(touched * 100.0 / nullif(roi_pixels, 0), 6)::DOUBLE AS pct_of_roi, round(touched * 100.0 / nullif(total, 0), 6)::DOUBLE AS pct_of_total, round(touched_roi * 100.0 / nullif(roi_pixels, 0), 6)::DOUBLE AS pct_inside_roi FROM c
""")
def coverage_stats(spark, d):
    cells = _roi(spark, d).withColumn("seen", (F.col("col") % 3 == 0).cast("int"))
    stats = grid.coverage(cells, "seen", "v")
    return stats.withColumns({c: F.round(c, 6) for c in ("pct_of_roi", "pct_of_total", "pct_inside_roi")})


@query(f"""
    WITH r AS ({_ROI}), w AS (SELECT row, col, {ORIGIN_X} + {STEP} * col AS x, {ORIGIN_Y} - {STEP} * row AS y FROM r)
    SELECT row, col, x, y, CAST(trunc((x + 3 - {ORIGIN_X}) / {STEP}) AS INTEGER) AS col_back, CAST(trunc((y - 3 - {ORIGIN_Y}) / -{STEP}) AS INTEGER) AS row_back,
           greatest(0, least(col - 50, 199)) AS low, greatest(greatest(0, least(col - 50, 199)) + 1, least(col + 50, 200)) AS high FROM w
""")
def affine_roundtrip(spark, d):
    x, y = scalar.to_world(F.col("col"), ORIGIN_X, STEP), scalar.to_world(F.col("row"), ORIGIN_Y, -STEP)
    low = scalar.window_low(F.col("col") - 50, F.lit(200))
    return _roi(spark, d).select(
        "row", "col", x.alias("x"), y.alias("y"), scalar.to_pixel(x + 3, ORIGIN_X, STEP).alias("col_back"), scalar.to_pixel(y - 3, ORIGIN_Y, -STEP).alias("row_back"),
        low.alias("low"), scalar.window_high(low, F.col("col") + 50, F.lit(200)).alias("high"),
    )


@query(f"""
    WITH {_BOXES}, k AS (SELECT unnest(range(20)) AS k), p AS (
        SELECT tile, k, x0 + (x1 - x0) * (k / 20) AS x, y0 AS y FROM r, k UNION ALL SELECT tile, 20 + k, x1, y0 + (y1 - y0) * (k / 20) FROM r, k
        UNION ALL SELECT tile, 40 + k, x1 + (x0 - x1) * (k / 20), y1 FROM r, k UNION ALL SELECT tile, 60 + k, x0, y1 + (y0 - y1) * (k / 20) FROM r, k)
    SELECT tile, CAST(k AS INTEGER) AS place, round(y, 6) AS first, round(x, 6) AS second FROM p
""")
def densified_boundary(spark, d):
    _, tiles = _boxes(spark, d)
    ring = scalar.swapped(scalar.boundary(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")))
    points = tiles.select("tile", F.posexplode(ring).alias("place", "p"))
    return points.select("tile", "place", F.round("p.x", 6).alias("first"), F.round("p.y", 6).alias("second"))


@query(f"""
    WITH {_BOXES} SELECT c_nationkey AS nation, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM l JOIN customer ON c_custkey = patch GROUP BY c_nationkey
""")
def envelope(spark, d):
    boxes, _ = _boxes(spark, d)
    nations = table(spark, d, "customer").select(F.col("c_custkey").alias("patch"), F.col("c_nationkey").alias("nation"))
    return grid.envelope(boxes.join(nations, "patch"), "nation")


@query(f"""
    WITH {_BOXES}, f AS (SELECT tile, x0, y0, x0 < 100 OR y0 < 100 OR x1 > 600 OR y1 > 400 AS clipped FROM r),
         p AS (SELECT tile, x0 + 2 * k AS x, y0 + k AS y, clipped FROM f, (SELECT unnest(range(20)) AS k))
    SELECT tile, x, y, clipped FROM p WHERE NOT clipped OR (x BETWEEN 100 AND 600 AND y BETWEEN 100 AND 400)
""")
def bbox_clip(spark, d):
    _, tiles = _boxes(spark, d)
    steps = tiles.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(19))))
    pixels = steps.select("tile", (F.col("x0") + 2 * F.col("k")).alias("x"), (F.col("y0") + F.col("k")).alias("y"))
    return grid.clip(pixels, tiles, (100, 100, 600, 400), "tile").select("tile", "x", "y", "clipped")


#: Diamonds around a tile's middle, as (offset x, y, half width, half height): the outline, its hole, and a second part.
DIAMONDS = ((0.0, 0.0, 20.3, 15.7), (1.0, -0.5, 8.1, 6.3), (31.0, 6.0, 5.2, 4.1))
_IN = " + ".join(f"(abs(x - cx - {dx}) / {w} + abs(y - cy - {dy}) / {h} < 1)::INTEGER" for dx, dy, w, h in DIAMONDS)


@query(f"""
    WITH {_BOXES}, c AS (SELECT tile, x0 + 20 AS cx, y0 + 15 AS cy FROM r),
         g AS (SELECT tile, cx, cy, CAST(i AS INTEGER) AS col, CAST(j AS INTEGER) AS row, i * 3 + 1.5 AS x, 700 - j * 3 - 1.5 AS y FROM c, (SELECT unnest(range(-8, 330)) AS i), (SELECT unnest(range(0, 240)) AS j))
    SELECT tile, col, row FROM g WHERE ({_IN}) % 2 = 1
""")
def rasterize_polygons(spark, d):
    """Pixels whose centres lie in a polygon of two parts, one with a hole."""
    _, tiles = _boxes(spark, d)
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))

    def ring(dx, dy, w, h):
        cx, cy = F.col("x0") + 20 + dx, F.col("y0") + 15 + dy
        return F.array(corner(cx - w, cy + 0.0), corner(cx + 0.0, cy - h), corner(cx + w, cy + 0.0), corner(cx + 0.0, cy + h))

    rings = tiles.select("tile", F.explode(F.array(*[ring(*d) for d in DIAMONDS])).alias("points"))
    return geometry.rasterize(rings, "tile", "points", 3.0, 0.0, 700.0)


@query(f"""
    WITH {_BOXES}, w AS (SELECT patch, (x0 - 100) / 4 AS c, (650 - y1) / 4 AS r, (x1 - x0) / 4 AS dc, (y1 - y0) / 4 AS dr FROM l)
    SELECT patch, CAST(greatest(0, round_even(c, 0)) AS INTEGER) AS c0, CAST(least(150, round_even(c + dc, 0)) AS INTEGER) AS c1,
           CAST(greatest(0, round_even(r, 0)) AS INTEGER) AS r0, CAST(least(120, round_even(r + dr, 0)) AS INTEGER) AS r1
    FROM w WHERE greatest(0, round_even(c, 0)) < 150 AND round_even(c + dc, 0) > 0 AND greatest(0, round_even(r, 0)) < 120 AND round_even(r + dr, 0) > 0
""")
def bounds_window(spark, d):
    """Windows of the patches' bounds in a raster of 150 x 120 pixels, rounded half to even and held inside."""
    patches, _ = _boxes(spark, d)
    cols = scalar.bounds_window(F.col("x0"), F.col("x1"), 100.0, 4.0, F.lit(150))
    rows = scalar.bounds_window(F.col("y1"), F.col("y0"), 650.0, -4.0, F.lit(120))
    held = patches.select("patch", cols.alias("c"), rows.alias("r")).filter("c is not null and r is not null")
    return held.select("patch", F.col("c.start").alias("c0"), F.col("c.end").alias("c1"), F.col("r.start").alias("r0"), F.col("r.end").alias("r1"))


@query("""
    WITH p AS (SELECT c_custkey, c_custkey % 3 * 500 AS x, c_custkey % 2 * 500 AS y FROM customer),
    s AS (SELECT *, least(500, 1200 - x) AS w, least(500, 700 - y) AS h FROM p),
    b AS (SELECT *, 10 + x / 1200 * 12 AS l, 10 + (x + w) / 1200 * 12 AS r, 47 - y / 700 * 7 AS t, 47 - (y + h) / 700 * 7 AS u FROM s)
    SELECT c_custkey, round((r - l) / w, 9) AS dx, round(l, 9) AS left, round(-(t - u) / h, 9) AS dy, round(t, 9) AS top FROM b
""")
def patch_affine(spark, d):
    """Affines of patches in a raster of geographic bounds, by their share of it."""
    key = F.col("c_custkey")
    made = scalar.patch_affine(key % 3 * 500, key % 2 * 500, 500, 1200, 700, (10.0, 40.0, 22.0, 47.0))
    return table(spark, d, "customer").select("c_custkey", made.alias("a")).select("c_custkey", *[F.round(f"a.{c}", 9).alias(c) for c in ("dx", "left", "dy", "top")])


#: Vectors as what was made of patches: 100 a patch, 10 x 10 pixels of 20 m, from rasters of 10 m or 20 m.
_LEFT, _TOP = 1013.0, 5003.0


def _crop_sql(step: int) -> str:
    def axis(low: str, first: str, origin: float, sign: int) -> str:
        """Target and own windows along an axis: first is the patch's edge, sign the direction of its pixels."""
        off, most = f"({sign} * ({first} - {origin}) / {step}.0)", f"{low}max"
        start, end = f"greatest(0, round_even({off}, 0))", f"least({most}, round_even({off} + a * s / {step}.0, 0))"
        own = f"(({sign} * ({origin} - {first}) + {{}} * {step}.0) / a * 10 / s)"
        return f"""{start} AS {low}0, {end} AS {low}1, greatest(0, round_even({own.format(start)}, 0)) AS s{low}0, least(10, round_even({own.format(end)}, 0)) AS s{low}1"""

    return f"""
    WITH m AS (SELECT vec_id // 100 AS n, vec_id % 100 // 10 AS r, vec_id % 10 AS c, embedding[1]::DOUBLE AS v FROM embeddings),
    z AS (SELECT 1200 // {step} AS cmax, (max(n) // 4 * 210 + 210) // {step} AS rmax FROM m),
    p AS (SELECT n, 1000.0 + n % 4 * 190 AS l, 5000.0 - n // 4 * 210 AS t, CASE WHEN n % 2 = 0 THEN 10 ELSE 20 END AS a, CASE WHEN n % 2 = 0 THEN 20 ELSE 10 END AS s FROM (SELECT DISTINCT n FROM m)),
    w AS (SELECT n, {axis("c", "l", _LEFT, 1)}, {axis("r", "t", _TOP, -1)}, cmax, rmax FROM p, z),
    x AS (SELECT *, c1 - c0 = sc1 - sc0 AND r1 - r0 = sr1 - sr0 AS same FROM w WHERE c0 < cmax AND r0 < rmax AND c1 > c0 AND r1 > r0 AND sc1 > sc0 AND sr1 > sr0),
    k AS (SELECT n, c + c0 - sc0 AS col, r + r0 - sr0 AS row, v FROM m JOIN x USING (n) WHERE same AND c >= sc0 AND c < sc1 AND r >= sr0 AND r < sr1),
    q AS (SELECT *, sc0 + (col - c0) * ((sc1 - sc0) / (c1 - c0)) AS px, sr0 + (row - r0) * ((sr1 - sr0) / (r1 - r0)) AS py
          FROM (SELECT *, unnest(range(r0::BIGINT, r1::BIGINT)) AS row FROM (SELECT *, unnest(range(c0::BIGINT, c1::BIGINT)) AS col FROM x WHERE NOT same))),
    f AS (SELECT *, floor(px) AS x0, least(floor(px) + 1, sc1 - 1) AS x1, floor(py) AS y0, least(floor(py) + 1, sr1 - 1) AS y1, px - floor(px) AS fx, py - floor(py) AS fy FROM q),
    g AS (SELECT n, col, row, x0 AS c, y0 AS r, (1 - fy) * (1 - fx) AS h FROM f UNION ALL SELECT n, col, row, x1, y0, (1 - fy) * fx FROM f
          UNION ALL SELECT n, col, row, x0, y1, fy * (1 - fx) FROM f UNION ALL SELECT n, col, row, x1, y1, fy * fx FROM f),
    e AS (SELECT * FROM k UNION ALL SELECT n, col, row, sum(h * v) FROM g JOIN m USING (n, c, r) GROUP BY n, col, row)
    SELECT CAST(col AS INTEGER) AS col, CAST(row AS INTEGER) AS row, round(CAST(CAST(arg_max(v, n) AS FLOAT) AS DOUBLE), 4) + 0.0::DOUBLE AS v FROM e GROUP BY col, row
    """


def _crop(spark, d, step):
    rows, last = table(spark, d, "embeddings"), (vectors(spark, d) - 1) // 100
    n, k = F.expr("vec_id div 100").cast("int"), F.col("vec_id") % 100
    name = F.format_string("p%08d", n)
    made = rows.select(name.alias("patch_id"), F.expr("vec_id % 100 div 10").cast("int").alias("row"), (k % 10).cast("int").alias("col"), F.slice("embedding", 1, 2).alias("vec"))
    even = F.col("n") % 2 == 0
    patches = rows.select(n.alias("n")).distinct().select(
        F.format_string("p%08d", "n").alias("patch_id"), (1000.0 + F.col("n") % 4 * 190).alias("left"), (5000.0 - F.expr("n div 4") * 210).alias("top"),
        F.when(even, 10.0).otherwise(20.0).alias("a"), F.when(even, -10.0).otherwise(-20.0).alias("e"), F.when(even, 20).otherwise(10).alias("width"), F.when(even, 20).otherwise(10).alias("height"),
        F.lit(10).alias("rep_width"), F.lit(10).alias("rep_height"),
    )
    target = {"left": _LEFT, "top": _TOP, "a": float(step), "e": -float(step), "width": 1200 // step, "height": (last // 4 * 210 + 210) // step}
    return grid.stitch_crop(patches, made, target).select("col", "row", (F.round(F.col("vec")[0].cast("double"), 4) + F.lit(0.0)).alias("v"))


@query(_crop_sql(20))
def stitch_crop(spark, d):
    """Patches' vectors laid into a target raster of the same pixel size."""
    return _crop(spark, d, 20)


@query(_crop_sql(15))
def stitch_crop_smooth(spark, d):
    """Patches' vectors laid into a finer target raster."""
    return _crop(spark, d, 15)


@query(f"""
    WITH {_BOXES}, b AS (SELECT patch, tile, least(l.x1, r.x1) - greatest(l.x0, r.x0) AS w, least(l.y1, r.y1) - greatest(l.y0, r.y0) AS h FROM l JOIN r ON {_TOUCH})
    SELECT patch, tile, round(w * h, 6)::DOUBLE AS area, w * h > 0 AS solid FROM b
""")
def polygon_overlap(spark, d):
    """Area that patches and tiles have in common, by the exact test and the clip of one polygon by the other."""
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    ring = F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1"))
    patches, tiles = (rows.withColumn("points", ring) for rows in _boxes(spark, d))

    def common(pairs):
        clipped = pairs.withColumn("c", geometry.clip_convex(F.col("p"), F.col("q"))).withColumn("c", geometry.tidy(F.col("c")))
        area = F.when(F.size("c") >= 3, geometry.area_centroid(F.col("c"))["area"]).otherwise(0.0)
        return clipped.withColumns({"area": F.round(area, 6), "solid": area > 0}).drop("c")

    return grid.overlapping_polygons(patches.select("patch", "points"), tiles.select("tile", "points"), 64.0, "patch", "tile", common)


@query(f"""
    WITH m AS ({_MAP}), g AS (SELECT CAST(k % 36 AS INTEGER) AS col, CAST(k // 36 AS INTEGER) AS row, r FROM (SELECT r, unnest(range(36 * t)) AS k FROM ({_HIGH}))),
    c AS (SELECT col, row, r, floor((3 + (col + 0.5) * 6) / 10) AS sx, floor((2 + (row + 0.5) * 6) / 10) AS sy FROM g)
    SELECT c.col, c.row, round(v, 6) AS v FROM c JOIN m ON m.col = sx AND m.row = sy WHERE sx BETWEEN 0 AND 19 AND sy BETWEEN 0 AND r - 1
""")
def nearest_affine(spark, d):
    """A map of 10 m onto a shifted raster of 6 m."""
    rows = _rows(spark, d)
    source = {"left": ORIGIN_X, "top": ORIGIN_Y, "a": 10.0, "e": -10.0, "width": 20, "height": rows}
    target = {"left": ORIGIN_X + 3, "top": ORIGIN_Y - 2, "a": 6.0, "e": -6.0, "width": 36, "height": -(-rows * 8 // 5)}
    return grid.nearest_affine(spark, _map(spark, d), "v", source, target).withColumn("v", F.round("v", 6))


@query("""
    SELECT CAST(vec_id // 20 AS INTEGER) AS row, CAST(vec_id % 20 AS INTEGER) AS col, round(embedding[1]::DOUBLE, 6) AS first, round(embedding[2]::DOUBLE, 6) AS second
    FROM embeddings WHERE vec_id // 20 BETWEEN 5 AND 19 AND vec_id % 20 BETWEEN 3 AND 14
""")
def array_window(spark, d):
    """Vectors written to an array file and a window of it read back, only its bytes."""
    rows, n = table(spark, d, "embeddings"), _rows(spark, d)
    cells = rows.select(F.lit("map").alias("name"), F.expr("vec_id div 20").cast("int").alias("row"), (F.col("vec_id") % 20).cast("int").alias("col"), F.slice("embedding", 1, 2).alias("v"))
    folder = storage.new_path(spark, "arrays")
    shapes = spark.createDataFrame([("map", [n, 20, 2])], "name string, shape array<int>").withColumn("shape", F.concat(F.array(F.lit(1)), "shape"))
    made = arrays.write_arrays(arrays.lines(cells, "name", "v", 20, 2, "float32"), folder, "map", shapes, "name", "float32").collect()
    if made[0]["status"] != "done":
        raise RuntimeError(made[0]["error"])
    read = arrays.pixels(arrays.read_arrays(spark, folder, rows=(5, 20), cols=(3, 15)))
    return read.select("row", "col", F.round(F.col("bands")[0], 6).alias("first"), F.round(F.col("bands")[1], 6).alias("second"))


@query(f"""
    WITH {_BOXES}, e AS (SELECT tile, x0, y0, x1, y1 FROM r), xs AS (SELECT DISTINCT x0 AS x FROM e UNION SELECT DISTINCT x1 FROM e), ys AS (SELECT DISTINCT y0 AS y FROM e UNION SELECT DISTINCT y1 FROM e),
    cx AS (SELECT x AS a, lead(x) OVER (ORDER BY x) AS b FROM xs), cy AS (SELECT y AS a, lead(y) OVER (ORDER BY y) AS b FROM ys),
    g AS (SELECT DISTINCT cx.a AS xa, cx.b AS xb, cy.a AS ya, cy.b AS yb FROM cx JOIN e ON e.x0 <= cx.a AND e.x1 >= cx.b JOIN cy ON e.y0 <= cy.a AND e.y1 >= cy.b)
    SELECT round(sum((xb - xa) * (yb - ya)), 3) AS area, round(sum((xb - xa) * (yb - ya) * (xa + xb) / 2) / sum((xb - xa) * (yb - ya)), 6) AS x,
           round(sum((xb - xa) * (yb - ya) * (ya + yb) / 2) / sum((xb - xa) * (yb - ya)), 6) AS y FROM g
""")
def union_centroid(spark, d):
    """Area and centroid of what all tiles cover together, each place once."""
    _, tiles = _boxes(spark, d)
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    boxes = tiles.select(F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1")).alias("points"))
    made = geometry.union_centroid(boxes, "points")
    return made.select(F.round("area", 3).alias("area"), F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


#: UTM on WGS 84 in metres, written out for the SQL alone: eccentricity, scale times the
#: rectifying radius, and the four coefficients of the forward series.
_ECCENTRIC, _RADIUS = 0.0818191908426215, 0.9996 * 6367449.145823415
_SERIES = "".join(f" + {a} * {{0}}({2 * j} * xi) * {{1}}({2 * j} * eta)" for j, a in enumerate(("8.377318206244698e-4", "7.608527773572307e-7", "1.197645503329453e-9", "2.429170607201359e-12"), 1))


@query(f"""
    WITH p AS (SELECT c_custkey, (c_custkey * 7 % 3600) / 10.0 - 180 AS lon, (c_custkey * 13 % 1640) / 10.0 - 80 AS lat FROM customer),
    z AS (SELECT *, CAST(trunc((lon + 180) / 6) AS INTEGER) + 1 AS zone FROM p),
    a AS (SELECT *, radians(lat) AS phi, radians(lon - (zone * 6 - 183)) AS turn, {_ECCENTRIC!r} AS e FROM z),
    b AS (SELECT *, sinh(atanh(sin(phi)) - e * atanh(e * sin(phi))) AS t FROM a),
    c AS (SELECT *, atan2(t, cos(turn)) AS xi, atanh(sin(turn) / sqrt(1 + t * t)) AS eta FROM b)
    SELECT c_custkey, zone, round(500000.0 + {_RADIUS!r} * (eta{_SERIES.format('cos', 'sinh')}), 2) AS x,
           round(CASE WHEN lat < 0 THEN 10000000.0 ELSE 0 END + {_RADIUS!r} * (xi{_SERIES.format('sin', 'cosh')}), 2) AS y,
           round(lon, 6) AS lon_back, round(lat, 6) AS lat_back FROM c
""")
def utm_project(spark, d):
    """Projects and projects back."""
    key = F.col("c_custkey")
    lon, lat = (key * 7 % 3600) / 10.0 - 180, (key * 13 % 1640) / 10.0 - 80
    rows = table(spark, d, "customer").select("c_custkey", lon.alias("lon"), lat.alias("lat")).withColumn("zone", scalar.utm_zone(F.col("lon")))
    x, y = geometry.utm_forward(F.col("lon"), F.col("lat"), F.col("zone"), F.col("lat") < 0)
    rows = rows.withColumns({"x": x, "y": y})
    back = geometry.utm_inverse(F.col("x"), F.col("y"), F.col("zone"), F.col("lat") < 0)
    return rows.select("c_custkey", "zone", F.round("x", 2).alias("x"), F.round("y", 2).alias("y"), F.round(back[0], 6).alias("lon_back"), F.round(back[1], 6).alias("lat_back"))


@query(f"""
    WITH {_BOXES}, n AS (SELECT DISTINCT c_nationkey AS nation, x0 AS x, y0 AS y FROM l JOIN customer ON c_custkey = patch),
    e AS (SELECT a.nation, a.x AS ax, a.y AS ay, b.x AS ex, b.y AS ey FROM n a JOIN n b ON a.nation = b.nation AND (a.x <> b.x OR a.y <> b.y)),
    s AS (SELECT e.nation, ax, ay, ex, ey, max((ex - ax) * (p.y - ay) - (ey - ay) * (p.x - ax)) AS most,
                 max(CASE WHEN (ex - ax) * (p.y - ay) = (ey - ay) * (p.x - ax) THEN (p.x - ax) * (ex - ax) + (p.y - ay) * (ey - ay) END) AS far,
                 min(CASE WHEN (ex - ax) * (p.y - ay) = (ey - ay) * (p.x - ax) THEN (p.x - ax) * (ex - ax) + (p.y - ay) * (ey - ay) END) AS near
          FROM e JOIN n p ON p.nation = e.nation GROUP BY ALL),
    k AS (SELECT * FROM s WHERE most <= 0 AND near >= 0 AND far <= (ex - ax) ** 2 + (ey - ay) ** 2)
    SELECT DISTINCT nation, ax AS x, ay AS y FROM k
    UNION SELECT nation, x, y FROM n WHERE nation IN (SELECT nation FROM n GROUP BY nation HAVING count(*) < 3)
""")
def hull_corners(spark, d):
    """Corners of the convex hull of each nation's points: an edge has all points on one side and none beyond its ends."""
    boxes, _ = _boxes(spark, d)
    nations = table(spark, d, "customer").select(F.col("c_custkey").alias("patch"), F.col("c_nationkey").alias("nation"))
    points = boxes.join(nations, "patch").select("nation", F.col("x0").alias("x"), F.col("y0").alias("y"))
    return geometry.hulls(points, "nation").select("nation", F.explode("points").alias("p")).select("nation", "p.x", "p.y")


@query(f"""
    WITH roi AS (SELECT l_suppkey - 1 AS row, l_partkey - 1 AS col FROM lineitem WHERE l_quantity > 48 GROUP BY ALL),
    hit AS (SELECT DISTINCT col // {CELL} AS px, row // {CELL} AS py FROM roi),
    obs AS (SELECT l_suppkey - 1 AS row, l_partkey - 1 AS col, CAST(dayofyear(l_shipdate) AS INTEGER) AS doy, CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END AS mask,
                   l_orderkey % 2 AS tile, l_orderkey, l_linenumber, l_extendedprice, l_quantity
            FROM lineitem),
    m AS (SELECT col // {CELL} AS px, row // {CELL} AS py, row, col, doy, arg_max(l_quantity, {{'m': mask, 't': tile, 'o': l_orderkey, 'n': l_linenumber, 'p': l_extendedprice, 'q': l_quantity}}) AS v, max(mask) AS mask
          FROM obs GROUP BY ALL)
    SELECT CAST(m.px AS INTEGER) AS px, CAST(m.py AS INTEGER) AS py, m.row, m.col, count(*) AS days, CAST(sum(mask) AS BIGINT) AS valid, round(sum(v), 4) AS total
    FROM m JOIN hit ON m.px = hit.px AND m.py = hit.py GROUP BY m.px, m.py, m.row, m.col HAVING sum(mask) >= 1
""")
def patch_pipeline(spark, d):
    """Patches with data, extraction, valid-first merge of two tiles, pixel filter."""
    rows = table(spark, d, "lineitem")
    place = {"row": F.col("l_suppkey") - 1, "col": F.col("l_partkey") - 1}
    roi = rows.select(place["row"].alias("row"), place["col"].alias("col"), (F.col("l_quantity") > 48).cast("int").alias("v"))
    patches = grid.patches_with_data(grid.patch_grid(spark, *_raster(spark, d), CELL), roi, CELL).select("px", "py")
    seen = rows.select(
        place["row"].alias("row"), place["col"].alias("col"), F.dayofyear("l_shipdate").alias("doy"), (F.col("l_returnflag") == "N").cast("int").alias("mask"),
        (F.col("l_orderkey") % 2).alias("tile"), "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity",
    )
    seen = seen.withColumns({"px": F.expr(f"col div {CELL}").cast("int"), "py": F.expr(f"row div {CELL}").cast("int")}).join(patches, ["px", "py"], "left_semi")
    order = ["tile", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity"]
    merged = series.merge_valid_first(seen, ["px", "py", "row", "col", "doy"], "l_quantity", "mask", order)
    pixels = merged.groupBy("px", "py", "row", "col").agg(F.count(F.lit(1)).alias("days"), F.sum("mask").alias("valid"), F.round(F.sum("l_quantity"), 4).alias("total"))
    return pixels.filter("valid >= 1")


@query("""
    SELECT c_nationkey AS tile, count(*) AS files FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY c_nationkey HAVING count(DISTINCT c_mktsegment) = 2
""")
def required_files(spark, d):
    files = table(spark, d, "customer").select(F.col("c_nationkey").alias("tile"), F.col("c_mktsegment").alias("file"))
    wanted = ["BUILDING", "MACHINERY"]
    held = files.filter(F.col("file").isin(*wanted)).groupBy("tile").agg(F.count(F.lit(1)).alias("files"))
    return held.join(scenes.complete(files, wanted), "tile", "left_semi")
