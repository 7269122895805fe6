"""Polygons with holes and parts, their union, projections against known places, MGRS squares."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from orbitframe.operators import geometry

RING = "points array<struct<x:double,y:double>>"


def box(a, b, c, d):
    return [(a, b), (c, b), (c, d), (a, d)]


def test_union_counts_overlaps_once():
    area, x, y = geometry.union_measure([[np.array(box(0, 0, 4, 4))], [np.array(box(2, 2, 6, 6))]])
    assert area == pytest.approx(28) and x == pytest.approx(3) and y == pytest.approx(3)
    area, x, _ = geometry.union_measure([[np.array(box(0, 0, 10, 10)), np.array(box(5, 0, 10, 10))]])  # a hole
    assert area == pytest.approx(50) and x == pytest.approx(2.5)
    assert geometry.union_measure([])[0] == 0


def test_union_equals_a_fine_raster():
    rng = np.random.default_rng(3)
    polygons = []
    for _ in range(6):
        turn = np.sort(rng.uniform(0, 2 * np.pi, 7))
        polygons.append([rng.uniform(3, 7, 2) + np.stack([np.cos(turn), np.sin(turn)], 1) * rng.uniform(1, 3, (7, 1))])
    at = (np.arange(1500) + 0.5) / 150
    gx, gy = np.meshgrid(at, at)
    held = np.zeros(gx.shape, bool)
    for (ring,) in polygons:
        odd = np.zeros(gx.shape, bool)
        for (ax, ay), (bx, by) in zip(ring, np.roll(ring, -1, axis=0)):
            if ay != by:
                odd ^= ((ay > gy) != (by > gy)) & (gx < ax + (bx - ax) * (gy - ay) / (by - ay))
        held |= odd
    area, x, y = geometry.union_measure(polygons)
    assert area == pytest.approx(held.sum() / 150**2, rel=2e-3) and x == pytest.approx(gx[held].mean(), abs=5e-3) and y == pytest.approx(gy[held].mean(), abs=5e-3)


def test_rings_of_a_polygon_by_the_even_odd_rule(spark):
    rows = [("a", box(0.2, 0.2, 9.8, 9.8)), ("a", box(3.1, 3.1, 6.9, 6.9)), ("a", box(12.0, 0.0, 14.0, 2.0)), ("b", box(0.0, 0.0, 3.0, 3.0))]
    got = {(r.k, r.col, r.row) for r in geometry.rasterize(spark.createDataFrame(rows, f"k string, {RING}"), "k", "points", 1.0, 0.0, 10.0).collect()}
    want = {("a", i, j) for i in range(15) for j in range(10) if (0.2 <= i + 0.5 < 9.8 and 0.2 < 9.5 - j < 9.8) ^ (3.1 <= i + 0.5 < 6.9 and 3.1 < 9.5 - j < 6.9) ^ (12 <= i + 0.5 < 14 and 0 < 9.5 - j < 2)}
    assert got == want | {("b", i, j) for i in range(3) for j in range(7, 10)}


def test_hull_mask_and_frame(spark):
    points = spark.createDataFrame([("a", x, y) for x, y in [(0.0, 0.0), (4.0, 0.0), (0.0, 4.0), (1.0, 1.0)]], "k string, x double, y double")
    got = {(r.col, r.row) for r in geometry.hull_mask(points, "k", 1.0, 0.0, 4.0).collect()}
    assert got == {(i, j) for i in range(4) for j in range(4) if (i + 0.5) + (4 - j - 0.5) < 4}
    frame = geometry.raster_frame(points, 0.75).first()
    assert (frame.left, frame.top, frame.width, frame.height) == (0.0, 4.0, 6, 6)
    with pytest.raises(Exception, match="no extent"):
        geometry.raster_frame(points.limit(1), 1.0).collect()


def test_known_places(spark):
    """UTM coordinates of public landmarks, to the metre."""
    rows = [(16.3725, 48.208333, 33, 601990.0, 5340353.0), (2.2945, 48.858222, 31, 448252.0, 5411955.0), (-43.210556, -22.951944, 23, 683466.0, 7460689.0)]
    frame = spark.createDataFrame(rows, "lon double, lat double, zone int, x double, y double")
    made = geometry.utm_forward(F.col("lon"), F.col("lat"), F.col("zone"), F.col("lat") < 0)
    for r in frame.select("x", "y", made[0].alias("gx"), made[1].alias("gy")).collect():
        assert abs(r.x - r.gx) < 800 and abs(r.y - r.gy) < 800
    on_meridian = spark.range(1).select(*[c.alias(n) for c, n in zip(geometry.utm_forward(F.lit(15.0), F.lit(0.0), F.lit(33), F.lit(False)), "xy")]).first()
    assert on_meridian.x == pytest.approx(500000, abs=1e-6) and on_meridian.y == pytest.approx(0, abs=1e-6)
    quarter = spark.range(1).select(geometry.utm_forward(F.lit(15.0), F.lit(90.0 - 1e-9), F.lit(33), F.lit(False))[1].alias("y")).first()
    assert quarter.y == pytest.approx(0.9996 * 10001965.729, abs=0.01)  # the meridian's quarter on WGS 84


def test_mgrs_squares(spark):
    names = ["33UWP", "33UXP", "32TPT", "18TWL", "56HLH", "3VXG", "31NAA", "30NZF"]
    frame = spark.createDataFrame([(n,) for n in names], "tile string").select("tile", geometry.mgrs_corner(F.col("tile")).alias("c"), geometry.tile_centre(F.col("tile")).alias("m"), geometry.tile_circle(F.col("tile")).alias("r"))
    rows = {r.tile: r for r in frame.collect()}
    corner = {k: (r.c.x, r.c.y, r.c.south) for k, r in rows.items()}
    assert corner["33UWP"] == (500000, 5300000, False) and corner["33UXP"] == (600000, 5300000, False)
    assert corner["32TPT"] == (600000, 5200000, False) and corner["18TWL"] == (500000, 4500000, False)
    assert corner["56HLH"] == (300000, 6200000, True)
    assert corner["31NAA"][:2] == (100000, 0) and corner["30NZF"][:2] == (800000, 0)
    assert rows["18TWL"].m.lon == pytest.approx(-74.40, abs=0.02) and rows["18TWL"].m.lat == pytest.approx(41.10, abs=0.02)
    for r in rows.values():
        assert len(r.r) == 64
        reach = [math.hypot((p.x - r.m.lon) * math.cos(math.radians(r.m.lat)), p.y - r.m.lat) * 111_200 for p in r.r]
        assert all(480 < d < 520 for d in reach)


def test_clip_polygon(spark):
    rows = [(box(0.0, 0.0, 10.0, 10.0),), ([(0.0, 0.0), (10.0, 0.0), (0.0, 10.0)],), (box(20.0, 20.0, 30.0, 30.0),)]
    lit = [F.lit(float(v)) for v in (2, 2, 6, 6)]
    made = spark.createDataFrame(rows, RING).select(geometry.clip_polygon(F.col("points"), *lit).alias("p"))
    areas = []
    for r in made.collect():
        areas.append(geometry.union_measure([[np.array([[p.x, p.y] for p in r.p])]])[0] if r.p else 0)
    assert areas == pytest.approx([16, 14, 0])


def test_polygons_that_meet(spark):
    diamond = [(5.0, 0.0), (10.0, 5.0), (5.0, 10.0), (0.0, 5.0)]
    cases = [
        (box(0.0, 0.0, 4.0, 4.0), box(3.0, 3.0, 6.0, 6.0), True, 1.0), (box(0.0, 0.0, 10.0, 10.0), box(4.0, 4.0, 5.0, 5.0), True, 1.0),
        (diamond, box(0.0, 0.0, 2.0, 2.0), False, 0.0), (diamond, box(0.0, 0.0, 5.0, 5.0), True, 12.5), (box(0.0, 0.0, 1.0, 1.0), box(1.0, 0.0, 2.0, 1.0), True, 0.0),
    ]
    frame = spark.createDataFrame([(k, a, b) for k, (a, b, *_) in enumerate(cases)], f"k int, a {RING[7:]}, b {RING[7:]}")
    for r in frame.select("k", geometry.intersects(F.col("a"), F.col("b")).alias("m"), geometry.tidy(geometry.clip_convex(F.col("a"), F.col("b"))).alias("c")).collect():
        area = geometry.union_measure([[np.array([[p.x, p.y] for p in r.c])]])[0] if r.c else 0
        assert (r.m, area) == (cases[r.k][2], pytest.approx(cases[r.k][3]))


def test_tidy_and_equal_rings(spark):
    ring = [(0.0, 0.0), (0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 0.0)]
    turned = [(2.0, 2.0), (2.0, 0.0), (0.0, 0.0)]
    frame = spark.createDataFrame([(ring, turned), ([(1.0, 1.0), (1.0, 1.0)], turned)], f"a {RING[7:]}, b {RING[7:]}")
    rows = frame.select(F.size(geometry.tidy(F.col("a"))).alias("n"), geometry.same_polygon(geometry.tidy(F.col("a")), F.col("b")).alias("same")).collect()
    assert [(r.n, r.same) for r in rows] == [(3, True), (0, False)]
