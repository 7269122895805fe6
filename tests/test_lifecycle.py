"""End to end on a small synthetic scene: two overlapping tiles, six patches, two without data."""

import numpy as np
from pyspark.sql import functions as F

from orbitframe import __main__ as command
from orbitframe.operators import network
from orbitframe.plans import lifecycle

WIDTH, HEIGHT, SIZE = 12, 8, 5
TILES = {"33UWP": (0, 8, [10, 20, 30]), "33UXP": (5, 12, [20, 30, 40])}
CONFIG = network.Config(optical_bands=2, radar_bands=2, latent=4, heads=2, layers=1, hidden=16, steps=4)


def value(tile, doy, x, y):
    return float((1000 if tile == "33UXP" else 2000) + 10 * doy + x + y / 100)


def scene(spark):
    roi = [(y, x, int(x < 10)) for y in range(HEIGHT) for x in range(WIDTH)]
    optical, radar = [], []
    for tile, (a, b, doys) in TILES.items():
        for x in range(a, b):
            for y in range(HEIGHT):
                for t, doy in enumerate(doys):
                    mask = int(not (tile == "33UXP" and doy == 30) and doy != 10)
                    v = value(tile, doy, x, y)
                    optical.append((tile, t, doy, x, y, mask, [v, v + 1]))
                for doy in (12, 24):
                    radar.append((tile, "A", doy, x, y, [float(doy), 0.0 if tile == "33UXP" else 1.0]))
    tiles = [(t, float(a), 0.0, float(b), float(HEIGHT)) for t, (a, b, _) in TILES.items()]
    return (
        spark.createDataFrame(roi, "row int, col int, v int"),
        spark.createDataFrame(tiles, "tile string, x0 double, y0 double, x1 double, y1 double"),
        spark.createDataFrame(optical, "tile string, t int, doy int, gx int, gy int, mask int, bands array<double>"),
        spark.createDataFrame(radar, "tile string, orbit string, doy int, gx int, gy int, bands array<double>"),
    )


def test_scene_to_map(spark):
    roi, tiles, optical, radar = scene(spark)
    left, right = lifecycle.retile(spark, roi, tiles, optical, radar, WIDTH, HEIGHT, SIZE)
    assert {r.patch_id for r in left.select("patch_id").distinct().collect()} == {"0_0_5_5", "5_0_10_5", "0_5_5_8", "5_5_10_8"}
    got = {(r.patch_id, r.idx, r.doy): (r.mask, r.bands[0]) for r in left.collect()}
    assert got["5_0_10_5", 6, 20] == (1, value("33UXP", 20, 6, 1))  # both valid: the later tile
    assert got["5_0_10_5", 6, 30] == (1, value("33UWP", 30, 6, 1))  # only the first is valid
    assert got["0_0_5_5", 6, 10] == (0, value("33UWP", 10, 1, 1))
    assert {tuple(r.bands) for r in right.filter("patch_id = '5_0_10_5' and idx = 0").collect()} == {(12.0, 0.0), (24.0, 0.0)}
    vectors = lifecycle.embed(left, right, network.random_weights(CONFIG, 1), CONFIG, ([2000.0, 2000.0], [100.0, 100.0]), ([10.0, 1.0], [5.0, 1.0]), seed=3)
    cells = lifecycle.stitched(spark, vectors, WIDTH, HEIGHT).collect()
    assert len(cells) == WIDTH * HEIGHT
    assert all(any(r.vec) == (r.col < 10) for r in cells)
    again = lifecycle.stitched(spark, vectors, WIDTH, HEIGHT).collect()
    key = lambda r: (r.row, r.col)
    assert all(np.array_equal(a.vec, b.vec) for a, b in zip(sorted(cells, key=key), sorted(again, key=key)))


def test_resume_and_status(spark):
    roi, tiles, optical, radar = scene(spark)
    done = spark.createDataFrame([("0_0_5_5",)], "patch_id string")
    left, _ = lifecycle.retile(spark, roi, tiles, optical, radar, WIDTH, HEIGHT, SIZE, done=done)
    assert left.filter("patch_id = '0_0_5_5'").count() == 0
    wanted = spark.createDataFrame([("a",), ("b",), ("c",)], "patch_id string")
    failed = spark.createDataFrame([("b", "no radar")], "patch_id string, error string")
    rows = {r.patch_id: r.status for r in lifecycle.status(wanted, wanted.filter("patch_id = 'a'"), failed).collect()}
    assert rows == {"a": "done", "b": "failed", "c": "missing"}


def test_radar_stack(spark):
    rows = [("t", "S1_20220314T054500_descending", 0, 0, 1.0, 0.0), ("t", "S1_20220314T054510_descending", 0, 0, 0.0, 2.0), ("t", "S1_20220315T054510_x", 0, 0, 1e6, 0.0)]
    got = lifecycle.radar_stack(spark.createDataFrame(rows, "tile string, name string, gx int, gy int, vv double, vh double")).collect()
    assert {(r.orbit, r.doy, tuple(r.bands)) for r in got} == {("D", 73, (10000, 11204)), ("A", 74, (30000, 0))}


def test_command(spark, tmp_path):
    command.main(["query", "sar_db_scale", "/root/testdata/sf0.001", str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out")).filter(F.col("db").isNotNull()).count() == 1000


def test_stages_resume_and_keep_failures(spark, tmp_path):
    wanted = spark.createDataFrame([(k,) for k in "abcd"], "patch_id string")
    path, asked = str(tmp_path / "made"), []

    def make(todo, bad=("c",)):
        asked.append(sorted(r.patch_id for r in todo.collect()))
        error = F.when(F.col("patch_id").isin(*bad, "zz"), "no radar")
        return todo.filter("patch_id <> 'd'").select("patch_id", F.lit(1).alias("v"), error.alias("error"))

    first = {r.patch_id: (r.status, r.error) for r in lifecycle.run_stage(spark, wanted, make, path).collect()}
    assert first == {"a": ("done", None), "b": ("done", None), "c": ("failed", "no radar"), "d": ("missing", None)}
    states = lifecycle.run_stage(spark, wanted, lambda todo: make(todo, ()), path)
    assert {r.patch_id: r.status for r in states.collect()} == {"a": "done", "b": "done", "c": "done", "d": "missing"}
    assert asked == [["a", "b", "c", "d"], ["c", "d"]]
    row = lifecycle.progress(states, 1800.0).first()
    assert (row.total, row.done, row.failed, row.missing, row.per_hour, row.eta) == (4, 3, 0, 1, 6.0, "10m 0s")
    assert [r.patch_id for r in lifecycle.first_keys(wanted, "patch_id").collect()] == ["a", "b", "c"]


def test_a_damaged_pixel_is_a_row(spark):
    w = network.random_weights(CONFIG, 1)
    good, short = [[1.0, 2.0, 30.0]] * 4, [[1.0, 2.0, 30.0]] * 3
    frame = spark.createDataFrame([("a", good, good), ("b", short, good)], "patch_id string, s2 array<array<double>>, s1 array<array<double>>").coalesce(1)
    network_rows = {r.patch_id: (r.vec is None, r.error is None) for r in network.represent(frame.repartition(2, "patch_id"), ["patch_id"], w, CONFIG, failures=True).collect()}
    assert network_rows["b"][0] and not network_rows["b"][1]


def test_single_tile_patches_keep_their_days(spark):
    seen = spark.createDataFrame([("p", 0, "t1", 5), ("p", 0, "t1", 5), ("q", 0, "t1", 5)], "patch_id string, idx int, tile string, doy int")
    met = spark.createDataFrame([("p", "t1"), ("q", "t1"), ("q", "t2")], "patch_id string, tile string")
    assert [r.patch_id for r in lifecycle.single_tile(seen, met).collect()] == ["p", "p"]


def test_commands_run_the_lifecycles(spark, tmp_path):
    roi, tiles, optical, radar = scene(spark)
    at = lambda name: str(tmp_path / name)
    for name, frame in {"roi": roi, "tiles": tiles, "optical": optical, "radar": radar}.items():
        frame.write.parquet(at(name))
    size = ["--width", str(WIDTH), "--height", str(HEIGHT)]
    for _ in range(2):  # the second run has nothing left to do
        command.main(["retile", at("roi"), at("tiles"), at("optical"), at("radar"), at("patches"), *size, "--patch-size", str(SIZE)])
    assert spark.read.parquet(at("patches/optical")).select("patch_id").distinct().count() == 4
    (tmp_path / "c.json").write_text('{"optical_bands": 2, "radar_bands": 2, "latent": 4, "heads": 2, "layers": 1, "hidden": 16, "steps": 4}')
    saved = {f"model_state/_orig_mod.{theirs}": network.random_weights(CONFIG, 1)[ours] for theirs, ours in network.saved_names(CONFIG).items()}
    np.savez(at("w.npz"), **saved, **{"model_state/projector.net.0.weight": np.zeros((2, 2))})
    for _ in range(2):
        command.main(["embed", at("patches"), at("vectors"), "--weights", at("w.npz"), "--config", at("c.json"), "--saved-names"])
    vectors = spark.read.parquet(at("vectors"))
    assert vectors.count() == 80 and vectors.filter("vec is null").count() == 0
    rows = vectors.withColumns({"_c": F.split("patch_id", "_")}).select("patch_id", F.floor(F.col("idx") / (F.col("_c")[2].cast("int") - F.col("_c")[0].cast("int"))).cast("int").alias("row"), (F.col("idx") % (F.col("_c")[2].cast("int") - F.col("_c")[0].cast("int"))).cast("int").alias("col"), "vec")
    rows.write.parquet(at("cells"))
    corner = F.split("patch_id", "_")
    x0, y0, x1, y1 = (corner[k].cast("int") for k in range(4))
    patches = vectors.select("patch_id").distinct().select("patch_id", (x0 * 10.0).alias("left"), (80 - y0 * 10.0).alias("top"), F.lit(10.0).alias("a"), F.lit(-10.0).alias("e"), (x1 - x0).alias("width"), (y1 - y0).alias("height"), (x1 - x0).alias("rep_width"), (y1 - y0).alias("rep_height"))
    patches.write.parquet(at("meta"))
    command.main(["stitch", at("meta"), at("cells"), at("map"), "--left", "20", "--top", "60", "--step", "10", "--width", "6", "--height", "5"])
    got = {(r.col + 2, r.row + 2): r.vec for r in spark.read.parquet(at("map")).collect()}
    whole = {(r.col, r.row): r.vec for r in lifecycle.stitched(spark, vectors.select("patch_id", "idx", "vec"), WIDTH, HEIGHT).collect()}
    assert len(got) == 30 and all(np.allclose(v, whole[k]) for k, v in got.items())
