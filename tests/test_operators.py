"""Folds, grids and vectors against direct computation."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orbitframe.operators import geometry, grid, network, scenes, series


def fold_valid_first(steps):
    held = (0, 0)
    for mask, value in steps:
        if mask == 1 or held[0] == 0:
            held = (mask, value)
    return held


def test_valid_first_merge_is_the_fold(spark):
    rng = random.Random(1)
    groups = {g: [(rng.randint(0, 1), rng.randint(0, 9)) for _ in range(rng.randint(1, 6))] for g in range(200)}
    groups |= {1000: [(1, 5), (0, 9)], 1001: [(0, 5), (0, 9)], 1002: [(1, 5), (1, 9)], 1003: [(0, 5), (1, 9), (0, 7)]}
    rows = [(g, t, m, v) for g, steps in groups.items() for t, (m, v) in enumerate(steps)]
    got = series.merge_valid_first(spark.createDataFrame(rows, "g int, t int, mask int, v int"), ["g"], "v", "mask", ["t"]).collect()
    assert {r.g: (r.mask, r.v) for r in got} == {g: fold_valid_first(s) for g, s in groups.items()}


def test_last_wins_and_mosaic(spark):
    rows = spark.createDataFrame([(1, 0, 7), (1, 1, 0), (2, 0, 7), (2, 1, 0), (2, 2, 3), (2, 3, 0)], "g int, t int, v int")
    assert {r.g: r.v for r in series.merge_last(rows, ["g"], "v", ["t"]).collect()} == {1: 0, 2: 0}
    assert {r.g: r.v for r in series.mosaic(rows, ["g"], "v", ["t"]).collect()} == {1: 7, 2: 3}


def test_sampling(spark):
    rows = [(g, t, int(g != 3 and t % 2 == 0)) for g, n in ((1, 30), (2, 5), (3, 4)) for t in range(n)]
    frame = spark.createDataFrame(rows, "g int, t int, m int")
    draw = lambda: [tuple(r) for r in series.sample_steps(frame, ["g"], "t", 8, 3, valid=F.col("m") == 1).orderBy("g", "place").collect()]
    got = draw()
    assert got == draw()
    for g, allowed in ((1, set(range(0, 30, 2))), (2, {0, 2, 4}), (3, {0, 1, 2, 3})):
        steps = [t for gg, _, t in got if gg == g]
        assert len(steps) == 8 and steps == sorted(steps) and set(steps) <= allowed
        assert (len(set(steps)) == 8) == (len(allowed) >= 8)


def test_valid_pixels(spark):
    optical = spark.createDataFrame([(1, [1.0], 1), (1, [1.0], 1), (1, [0.0], 0), (2, [0.0], 1), (2, [0.0], 1), (3, [4.0], 1), (3, [1.0], 1)], "p int, bands array<double>, mask int")
    radar = spark.createDataFrame([(1, [0.0, 3.0]), (1, [1.0, 0.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0]), (3, [5.0, 5.0])], "p int, bands array<double>")
    assert [r.p for r in series.valid_pixels(optical, radar, ["p"], 2).collect()] == [1]


def test_attention_pool(spark):
    rows = spark.createDataFrame([(0, 1.0, 10.0), (0, 2.0, 20.0), (0, 3.0, 30.0)], "g int, s double, x double")
    assert series.attention_pool(rows, ["g"], "s", "x").first().pooled == pytest.approx(25.752104, abs=1e-6)


def test_patch_grid(spark):
    rows = grid.patch_grid(spark, 1200, 700, 500).collect()
    assert len(rows) == 6 and "1000_500_1200_700" in {r.patch_id for r in rows}


def test_overlap_is_closed_and_made_once(spark):
    boxes = spark.createDataFrame([(0, 0.0, 0.0, 10.0, 10.0)], "a int, x0 double, y0 double, x1 double, y1 double")
    others = spark.createDataFrame([(1, 10.0, 0.0, 20.0, 10.0), (2, 10.01, 0.0, 20.0, 10.0), (3, -50.0, -50.0, 50.0, 50.0)], "b int, x0 double, y0 double, x1 double, y1 double")
    assert sorted(r.b for r in grid.overlapping(boxes, others, 3.0, "a", "b").collect()) == [1, 3]


def test_bilinear_and_block_mean(spark):
    square = spark.createDataFrame([(0, 0, 0.0), (1, 0, 10.0), (0, 1, 20.0), (1, 1, 30.0)], "col int, row int, v double")
    got = {(r.row, r.col): r.v for r in grid.bilinear(spark, square, "v", (2, 2), (4, 4)).collect()}
    assert [[got[y, x] for x in range(4)] for y in range(4)] == [[0, 5, 10, 10], [10, 15, 20, 20], [20, 25, 30, 30], [20, 25, 30, 30]]
    cells = spark.createDataFrame([(k % 5, k // 5, float(k)) for k in range(15)], "col int, row int, v double")
    assert sorted((r.col, r.v) for r in grid.block_mean(cells, "v", 2, 5, 3).collect()) == [(0, 3.0), (1, 5.0)]


def test_tiling_then_stitching_is_identity(spark):
    cells = [(x, y, float(x * 31 + y)) for x in range(23) for y in range(17)]
    patches = [(x // 5 * 5, y // 5 * 5, x % 5, y % 5, v, 0) for x, y, v in cells]
    frame = spark.createDataFrame(patches, "ox int, oy int, col int, row int, v double, ord int")
    assert sorted((r.col, r.row, r.v) for r in grid.stitch(frame, "v", ["ord"]).collect()) == sorted(cells)


def test_coverage_of_empty_roi_is_null(spark):
    cells = spark.createDataFrame([(1, 0), (0, 0)], "seen int, roi int")
    row = grid.coverage(cells, "seen", "roi").first()
    assert row.pct_of_roi is None and row.pct_of_total == 50.0


def test_extract_placement(spark):
    pixels = spark.createDataFrame([(0, 0), (3, 2)], "col int, row int")
    world = grid.extract_window(pixels, -2, -1, 10, 10).collect()
    corner = grid.extract_window(pixels, -2, -1, 10, 10, placement="topleft").collect()
    assert sorted((r.wx, r.wy) for r in world) == [(2, 1), (5, 3)]
    assert sorted((r.wx, r.wy) for r in corner) == [(0, 0), (3, 2)]


def test_tile_status_and_split(spark):
    files = [("a", f) for f in (*scenes.OPTICAL_FILES, *scenes.RADAR_FILES)] + [("b", f) for f in scenes.OPTICAL_FILES] + [("c", f) for f in (*scenes.OPTICAL_FILES[1:], *scenes.RADAR_FILES)]
    got = {r.tile: r.status for r in scenes.tile_status(spark.createDataFrame(files, "tile string, file string")).collect()}
    assert got == {"a": "ALL_DONE", "b": "S2_DONE_ONLY", "c": "NOT_DONE"}
    work = spark.createDataFrame([(f"t{k}",) for k in range(5)], "t string")
    count = lambda c, g: sorted(r.device for r in scenes.split_work(work, "t", c, g, 2).collect())
    assert count(1, 1) == ["CPU"] * 2 + ["GPU"] * 3 and set(count(0, 1)) == {"GPU"} and set(count(1, 0)) == {"CPU"}


def test_utm_round_trip(spark):
    places = spark.createDataFrame([(16.37, 48.21, 33), (-70.6, -33.4, 19), (3.0, 0.0, 31)], "lon double, lat double, zone int")
    x, y = geometry.utm_forward(F.col("lon"), F.col("lat"), F.col("zone"), F.col("lat") < 0)
    both = places.withColumns({"x": x, "y": y})
    back = geometry.utm_inverse(F.col("x"), F.col("y"), F.col("zone"), F.col("lat") < 0)
    for r in both.withColumns({"a": back[0], "b": back[1]}).collect():
        assert r.a == pytest.approx(r.lon, abs=1e-8) and r.b == pytest.approx(r.lat, abs=1e-8)
    centre = both.filter("zone = 31").first()
    assert centre.x == pytest.approx(500000, abs=1e-3) and centre.y == pytest.approx(0, abs=1e-6)


def test_hull_and_centroid(spark):
    square = [(0, 0), (4, 0), (4, 4), (0, 4), (2, 2), (1, 3)]
    assert {tuple(p) for p in geometry.convex_hull(np.array(square))} == {(0, 0), (4, 0), (4, 4), (0, 4)}
    ring = [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]]
    frame = spark.createDataFrame([(r,) for r in ring], "p array<struct<x:double,y:double>>")
    got = geometry.union_centroid(frame, "p").first()
    assert (got.x, got.y) == (2.0, 2.0)


def gru_by_loop(x, w, d):
    h, out = np.zeros(d), []
    gate = lambda z: 1 / (1 + np.exp(-z))
    wx, bx, wh, bh = w["s2.gru_x.weight"], w["s2.gru_x.bias"], w["s2.gru_h.weight"], w["s2.gru_h.bias"]
    for step in x:
        r = gate(wx[:d] @ step + bx[:d] + wh[:d] @ h + bh[:d])
        z = gate(wx[d : 2 * d] @ step + bx[d : 2 * d] + wh[d : 2 * d] @ h + bh[d : 2 * d])
        n = np.tanh(wx[2 * d :] @ step + bx[2 * d :] + r * (wh[2 * d :] @ h + bh[2 * d :]))
        h = (1 - z) * n + z * h
        out.append(h)
    return np.array(out)


def test_network_parts():
    config = network.TINY
    w, rng, d = network.random_weights(config, 1), np.random.default_rng(2), config.width
    x = rng.normal(size=(2, 3, d))
    assert np.allclose(network.recurrent(x, w, "s2")[1], gru_by_loop(x[1], w, d))
    one = network.attend(x[:, :1], w, "s2.layer0", config.heads)  # a single step attends to itself alone
    v = network._linear(x[:, :1], w, "s2.layer0.in")[..., 2 * d :]
    assert np.allclose(one, network._linear(v, w, "s2.layer0.out"))
    steps = np.concatenate([rng.normal(size=(4, 5, 10)), rng.integers(1, 366, (4, 5, 1))], axis=-1)
    radar = np.concatenate([rng.normal(size=(4, 5, 2)), rng.integers(1, 366, (4, 5, 1))], axis=-1)
    whole = network.forward(steps, radar, w, config)
    assert whole.shape == (4, 128)
    assert np.allclose(whole[2:3], network.forward(steps[2:3], radar[2:3], w, config))


def test_represent_in_spark_equals_numpy(spark):
    config = network.Config(optical_bands=2, radar_bands=2, latent=4, heads=2, layers=1, hidden=16, steps=3)
    w, rng = network.random_weights(config, 4), np.random.default_rng(5)
    s2, s1 = rng.normal(size=(6, 3, 3)), rng.normal(size=(6, 3, 3))
    frame = spark.createDataFrame([(i, s2[i].tolist(), s1[i].tolist()) for i in range(6)], "id long, s2 array<array<double>>, s1 array<array<double>>")
    got = {r.id: r.vec for r in network.represent(frame, ["id"], w, config).collect()}
    want = network.forward(s2, s1, w, config)
    assert all(np.allclose(got[i], want[i], atol=1e-5) for i in range(6))


def test_checkpoints_are_strict():
    config = network.Config(optical_bands=2, radar_bands=2, latent=4, heads=2, layers=2, hidden=16, steps=3)
    w = network.random_weights(config, 4)
    names = network.saved_names(config)
    assert sorted(names.values()) == sorted(w)
    assert names["s2_backbone.transformer_encoder.layers.1.self_attn.in_proj_weight"] == "s2.layer1.in.weight"
    assert names["s1_backbone.attn_pool.temporal_context.bias_hh_l0"] == "s1.gru_h.bias"
    state = {f"_orig_mod.{theirs}": w[ours] for theirs, ours in names.items()} | {"projector.net.0.weight": np.zeros(3)}
    for alias in ("model_state", "model_state_dict"):
        made = network.from_checkpoint({"epoch": 3, alias: state}, config)
        assert made.keys() == w.keys() and all((made[k] == w[k]).all() for k in w)
    with pytest.raises(KeyError, match="no model state"):
        network.from_checkpoint({"state": state}, config)
    with pytest.raises(KeyError, match="missing weights"):
        network.from_checkpoint({"model_state": dict(list(state.items())[1:])}, config)
    with pytest.raises(KeyError, match="unknown weights"):
        network.from_checkpoint({"model_state": state | {"extra.weight": np.zeros(1)}}, config)
    with pytest.raises(ValueError, match="other shapes"):
        network.from_checkpoint({"model_state": state | {"_orig_mod.dim_reducer.0.bias": np.zeros(3)}}, config)


def test_sizes_from_files(tmp_path):
    (tmp_path / "a.json").write_text('{"latent": 16, "layers": 2}')
    (tmp_path / "b.json").write_text('{"layers": 3}')
    config = network.Config.load(str(tmp_path / "a.json"), str(tmp_path / "b.json"), hidden=64, heads=None)
    assert (config.latent, config.layers, config.hidden, config.heads) == (16, 3, 64, 8)
    with pytest.raises(TypeError):
        network.Config.load(str(tmp_path / "a.json"), unknown=1)


def test_reduction_at_full_size_equals_the_expression(spark):
    rng = np.random.default_rng(3)
    weights, bias = rng.normal(size=(5, 12)), rng.normal(size=5)
    rows = spark.createDataFrame([(i, rng.normal(size=12).tolist()) for i in range(20)], "id long, v array<double>")
    left = {r.id: r.vec for r in network.reduce_vectors(rows, ["id"], "v", weights, bias).collect()}
    right = {r.id: r.vec for r in rows.select("id", series.reduce_vector(F.col("v"), weights.tolist(), bias.tolist()).alias("vec")).collect()}
    assert all(np.allclose(left[i], right[i]) for i in range(20))


def test_unused_layers_of_the_model():
    rng = np.random.default_rng(8)
    x, w = rng.normal(size=(2, 4, 6)), rng.normal(size=6)
    scores = np.exp(x[0] @ w + 0.3)
    assert np.allclose(network.attention_pooling(x, w, 0.3)[0], (scores[:, None] * x[0]).sum(axis=0) / scores.sum())
    days, rate, phase, weight, bias = np.array([[73.0, 146.0]]), np.array([1.0, 2.0]), rng.normal(size=4), rng.normal(size=(3, 4)), rng.normal(size=3)
    turn = 2 * np.pi * 0.4
    features = [np.sin(turn + phase[0]), np.sin(2 * turn + phase[1]), np.cos(turn + phase[2]), np.cos(2 * turn + phase[3])]
    assert np.allclose(network.fourier_days(days, rate, phase, weight, bias)[0, 1], weight @ features + bias)
