"""Queries on tables beyond the sizes their SQL was written for, against direct computation."""

import datetime

import pytest

from orbitframe.plans import grid_queries, registry


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    """Runs a query on tables given as (rows, schema)."""

    def go(query, **tables):
        folder = str(tmp_path_factory.mktemp("tables"))
        for name, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
        return registry.QUERIES[query](spark, folder).collect()

    return go


#: partkey, suppkey, quantity, returnflag, orderkey: places within and beyond 2000 x 100.
LINES = [(5, 7, 50, "N", 1), (2000, 100, 50, "N", 2), (2001, 101, 49, "N", 3), (2500, 40, 50, "N", 4), (2500, 40, 1, "R", 5), (30, 333, 2, "N", 6), (4321, 333, 50, "N", 8)]


@pytest.fixture(scope="module")
def lines():
    rows = [(p, s, float(q), f, o, 1, 10.0 * o, datetime.date(2020, 1, 1)) for p, s, q, f, o in LINES]
    return rows, "l_partkey long, l_suppkey long, l_quantity double, l_returnflag string, l_orderkey long, l_linenumber int, l_extendedprice double, l_shipdate date"


def test_rasters_hold_every_line(run, lines):
    width, height = max(r[0] for r in LINES), max(r[1] for r in LINES)
    v = {}
    for p, s, q, *_ in LINES:
        v[p - 1, s - 1] = max(v.get((p - 1, s - 1), 0), int(q > 48))
    hit = {(x // 20, y // 20) for (x, y), k in v.items() if k}
    want = {(f"{x * 20}_{y * 20}_{min(x * 20 + 20, width)}_{min(y * 20 + 20, height)}", x, y) for x, y in hit}
    assert {tuple(r) for r in run("patch_grid_nonzero", lineitem=lines)} == want
    blocks = {}
    for (x, y), k in v.items():
        if x < width // 7 * 7 and y < height // 7 * 7:
            blocks.setdefault((x // 7, y // 7), []).append(k)
    assert {(r.col, r.row): r.v for r in run("block_mean", lineitem=lines)} == {b: round(sum(k) / len(k), 6) for b, k in blocks.items()}
    stats = run("coverage_stats", lineitem=lines)[0]
    assert (stats.total, stats.roi_pixels) == (len(v), sum(v.values()))
    assert {(r.col, r.row) for r in run("affine_roundtrip", lineitem=lines)} == set(v)
    merged = {(r.col, r.row): (r.days, r.valid, r.total) for r in run("patch_pipeline", lineitem=lines)}
    assert merged == {(4, 6): (1, 1, 50.0), (1999, 99): (1, 1, 50.0), (2000, 100): (1, 1, 49.0), (2499, 39): (1, 1, 50.0), (4320, 332): (1, 1, 50.0)}


def test_boxes_hold_every_tile(run):
    customers = [(c, c % 3) for c in (1, 7, 30, 55)]
    suppliers = [(s,) for s in (3, 60, 61, 200, 777)]
    tables = {"customer": (customers, "c_custkey long, c_nationkey int"), "supplier": (suppliers, "s_suppkey long")}
    patches = {c: (c * 37 % 1000, c * 91 % 700, c * 37 % 1000 + 10, c * 91 % 700 + 10) for c, _ in customers}
    tiles = {s: (s * 53 % 900, s * 29 % 600, s * 53 % 900 + 40, s * 29 % 600 + 30) for (s,) in suppliers}
    near = lambda p, t, m: p[2] + m >= t[0] and p[0] - m <= t[2] and p[3] + m >= t[1] and p[1] - m <= t[3]
    assert {tuple(r) for r in run("patch_tile_overlap", **tables)} == {(p, t) for p in patches for t in tiles if near(patches[p], tiles[t], 0)}
    want = set()
    for p in patches:
        tiers = [[t for t in tiles if near(patches[p], tiles[t], 0)], [t for t in tiles if near(patches[p], tiles[t], 1)], list(tiles)]
        tier = next(k for k, found in enumerate(tiers, 1) if found)
        want |= {(p, t, tier) for t in tiers[tier - 1]}
    assert {tuple(r) for r in run("patch_tile_overlap_tiers", **tables)} == want
    ring = run("densified_boundary", **tables)
    assert {r.tile for r in ring} == set(tiles) and len(ring) == 80 * len(tiles)
    pixels = {(t, b[0] + 2 * k, b[1] + k): b[0] < 100 or b[1] < 100 or b[2] > 600 or b[3] > 400 for t, b in tiles.items() for k in range(20)}
    kept = {(t, x, y, c) for (t, x, y), c in pixels.items() if not c or (100 <= x <= 600 and 100 <= y <= 400)}
    assert {(r.tile, r.x, r.y, r.clipped) for r in run("bbox_clip", **tables)} == kept
    within = lambda x, y: sum(abs(x - dx) / w + abs(y - dy) / h < 1 for dx, dy, w, h in grid_queries.DIAMONDS) % 2
    held = {(t, i, j) for t, b in tiles.items() for i in range(-8, 330) for j in range(240) if within(i * 3 + 1.5 - b[0] - 20, 700 - j * 3 - 1.5 - b[1] - 15)}
    assert {(r.tile, r.col, r.row) for r in run("rasterize_polygons", **tables)} == held


@pytest.fixture(scope="module")
def many():
    rows = [(i, [float(i % 97 + j) / 64 for j in range(64)]) for i in range(3107)]
    return rows, "vec_id long, embedding array<float>"


def test_maps_and_pairs_hold_every_vector(run, many):
    v = {i: vec for i, vec in many[0]}
    n, rows = len(v), 156
    at = {(i % 20, i // 20): vec[0] for i, vec in v.items()}
    assert {r.vec_id: r.first_of_second for r in run("fusion_concat", embeddings=many)} == {i: round(v[(i + 1) % n][0], 6) for i in v}
    sums = {r.vec_id: r.norm for r in run("fusion_sum", embeddings=many)}
    assert sums == pytest.approx({i: sum((a + b) ** 2 for a, b in zip(v[i], v[(i + 1) % n])) for i in v}, abs=1e-4)
    assert {r.cell: r.first for r in run("dense_scatter", embeddings=many)} == {i: round(vec[0], 6) for i, vec in v.items()}
    over = at | {(x + 10, y + 5): -k for (x, y), k in at.items()}
    assert {(r.col, r.row): r.v for r in run("stitch_last_wins", embeddings=many)} == {p: round(k, 6) for p, k in over.items()}
    near = {(x, y): at.get((min(int((x + 0.5) * 20 / 30), 19), min(int((y + 0.5) * rows / 250), rows - 1))) for x in range(30) for y in range(250)}
    assert {(r.col, r.row): r.v for r in run("nearest_resample", embeddings=many)} == {p: round(k, 6) for p, k in near.items() if k is not None}
    smooth = {}
    for x in range(30):
        for y in range(250):
            fx, fy = x * (20 / 30), y * (rows / 250)
            a, b, fx, fy = int(fx), int(fy), fx % 1, fy % 1
            parts = [(at.get((min(a + i, 19), min(b + j, rows - 1))), (fx if i else 1 - fx) * (fy if j else 1 - fy)) for i in (0, 1) for j in (0, 1)]
            if all(k is not None for k, _ in parts):
                smooth[x, y] = sum(k * w for k, w in parts)
    assert {(r.col, r.row): r.v for r in run("bilinear_resample", embeddings=many)} == pytest.approx(smooth, abs=2e-5)
    blocks = {}
    for (x, y), k in at.items():
        blocks.setdefault((x // 2, y // 2), []).append(k)
    small = {(r.col, r.row): r.v for r in run("downsample_export", embeddings=many)}
    assert small == pytest.approx({b: sum(k) / len(k) for b, k in blocks.items()}, abs=1e-6)
