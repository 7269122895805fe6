"""Clips by polygons, windows of bounds and affines of patches."""

import pytest
from pyspark.sql import functions as F

from orbitframe.functions import scalar
from orbitframe.operators import grid

#: A notched ring: the part x 40..60, y 50..100 is cut out.
RING = [(0, 0), (100, 0), (100, 100), (60, 100), (60, 50), (40, 50), (40, 100), (0, 100)]


def in_ring(x, y):
    return 0 <= x < 100 and 0 <= y < 100 and not (40 <= x < 60 and y >= 50)


def test_clip_by_polygon(spark):
    boxes = {1: (5, 5, 35, 35), 2: (30, 60, 70, 90), 3: (80, 80, 120, 120), 4: (200, 200, 210, 210), 5: (42, 60, 58, 90), 6: (0, 0, 40, 100), 7: (10, 10, 90, 60)}
    cells = [(t, x + 0.5, y + 0.5) for t, (a, b, c, d) in boxes.items() for x in range(a, c, 2) for y in range(b, d, 2)]
    frame = spark.createDataFrame(cells, "tile int, x double, y double")
    rows = spark.createDataFrame([(t, *map(float, b)) for t, b in boxes.items()], "tile int, x0 double, y0 double, x1 double, y1 double")
    got = {(r.tile, r.x, r.y, r.clipped) for r in grid.clip(frame, rows, (0, 0, 100, 100), "tile", RING).collect()}
    whole = {1, 6}
    assert got == {(t, x, y, t not in whole) for t, x, y in cells if t in whole or in_ring(x, y)}
    assert {t for t, *_ in got} == {1, 2, 3, 6, 7}


def test_bounds_window_rounds_half_to_even(spark):
    given = [(25.0, 45.0), (35.0, 55.0), (-30.0, 20.0), (80.0, 500.0), (-50.0, -10.0), (100.0, 120.0), (24.9, 26.0)]
    frame = spark.createDataFrame(given, "a double, b double")
    low = frame.select(scalar.bounds_window(F.col("a"), F.col("b"), 0.0, 10.0, F.lit(10)).alias("w")).collect()
    high = frame.select(scalar.bounds_window(700 - F.col("a"), 700 - F.col("b"), 700.0, -10.0, F.lit(10)).alias("w")).collect()
    want = []
    for a, b in given:
        start, end = max(0, round(a / 10)), min(10, round(a / 10 + (b - a) / 10))
        want.append((start, end) if start < 10 and end > 0 else None)
    assert want[:2] == [(2, 4), (4, 6)]
    assert [r.w and tuple(r.w) for r in low] == want and [r.w and tuple(r.w) for r in high] == want


def test_patch_affine_is_proportional(spark):
    frame = spark.createDataFrame([(0, 0), (1000, 500)], "x int, y int")
    got = [tuple(r.a) for r in frame.select(scalar.patch_affine(F.col("x"), F.col("y"), 500, 1200, 700, (10.0, 40.0, 22.0, 47.0)).alias("a")).collect()]
    assert got[0] == pytest.approx((0.01, 10.0, -0.01, 47.0))
    assert got[1] == pytest.approx((0.01, 20.0, -0.01, 42.0))


def test_frames_and_shifted_affines(spark):
    meta = spark.createDataFrame([(500000.0, 5300080.0, 10.0, -10.0, 1200, 700, None)], "c double, f double, a double, e double, width int, height int, epsg int")
    frame = grid.global_frame(meta).first()
    assert (frame.left, frame.top, frame.width, frame.epsg) == (500000.0, 5300080.0, 1200, 32633)
    row = spark.createDataFrame([(500, 100)], "x int, y int").select(grid.shifted_affine(F.col("x"), F.col("y"), frame.asDict()).alias("m")).first()
    assert row.m == [10.0, 0.0, 505000.0, 0.0, -10.0, 5299080.0]


def test_stitched_patches_without_vectors_leave_nothing(spark):
    schema = "patch_id string, left double, top double, a double, e double, width int, height int, rep_width int, rep_height int"
    patches = spark.createDataFrame([("p", 0.0, 40.0, 10.0, -10.0, 4, 4, 2, 2), ("q", 40.0, 40.0, 10.0, -10.0, 4, 4, 4, 4), ("far", 900.0, 40.0, 10.0, -10.0, 4, 4, 4, 4)], schema)
    vectors = spark.createDataFrame([("p", r, c, [float(10 * r + c)]) for r in range(2) for c in range(2)], "patch_id string, row int, col int, vec array<double>")
    target = {"left": 0.0, "top": 40.0, "a": 10.0, "e": -10.0, "width": 8, "height": 4}
    got = {(r.col, r.row): r.vec[0] for r in grid.stitch_crop(patches, vectors, target).collect()}
    at = lambda k: (min(int(k / 2), 1), min(int(k / 2) + 1, 1), k / 2 % 1)
    want = {}
    for x in range(4):
        for y in range(4):
            (x0, x1, fx), (y0, y1, fy) = at(x), at(y)
            v = lambda r, c: 10 * r + c
            want[x, y] = (1 - fy) * ((1 - fx) * v(y0, x0) + fx * v(y0, x1)) + fy * ((1 - fx) * v(y1, x0) + fx * v(y1, x1))
    assert got == pytest.approx(want)
