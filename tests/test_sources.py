"""Round trips of codecs, catalogues and the incremental ingest."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from orbitframe.sources import arrays, catalogues, files, rasters
from orbitframe.streaming import ingest


def test_arrays_round_trip(spark, tmp_path):
    made = np.arange(2 * 3 * 4 * 2, dtype=np.float32).reshape(2, 3, 4, 2)
    (tmp_path / "t1").mkdir()
    (tmp_path / "t1" / "bands.npy").write_bytes(arrays.encode_array(made))
    rows = arrays.pixels(arrays.read_arrays(spark, str(tmp_path))).collect()
    assert len(rows) == 24
    assert all(r.bands == made[r.t, r.row, r.col].tolist() for r in rows)
    assert [r.tile for r in arrays.tiles_complete(spark, str(tmp_path), ["bands.npy"]).collect()] == ["t1"]
    assert arrays.tiles_complete(spark, str(tmp_path), ["bands.npy", "doys.npy"]).count() == 0


def test_windows_read_only_their_bytes(spark, tmp_path):
    made = np.arange(3 * 50 * 40 * 2, dtype=np.int16).reshape(3, 50, 40, 2)
    (tmp_path / "t1").mkdir()
    (tmp_path / "t1" / "bands.npy").write_bytes(arrays.encode_array(made))
    (tmp_path / "t1" / "days.npy").write_bytes(arrays.encode_array(np.array([3, 9, 12], np.int32)))
    (tmp_path / "t1" / "broken.npy").write_bytes(arrays.encode_array(made)[:-5])
    (tmp_path / "t1" / "empty.npy").write_bytes(arrays.encode_array(np.zeros((0, 50, 40, 2), np.float32)))
    shapes = {r.file: r for r in arrays.read_shapes(spark, str(tmp_path)).collect()}
    assert shapes["bands.npy"]["shape"] == [3, 50, 40, 2] and shapes["broken.npy"].error and shapes["empty.npy"]["shape"] == [0, 50, 40, 2]
    read = arrays.read_arrays(spark, str(tmp_path / "t1" / "bands.npy"), rows=(10, 33), cols=(5, 9), steps=(1, 3), slab_bytes=40 * 2 * 2 * 7)
    chunks = read.collect()
    assert len(chunks) == 2 * 4 and {tuple(c["shape"]) for c in chunks} == {(7, 4, 2), (2, 4, 2)}
    for r in arrays.pixels(read).collect():
        assert r.bands == made[r.t, r.row, r.col].tolist()
    assert arrays.pixels(read).count() == 2 * 23 * 4
    assert [r.bands for r in arrays.pixels(arrays.read_arrays(spark, str(tmp_path / "t1" / "days.npy"))).orderBy("col").collect()] == [[3.0], [9.0], [12.0]]
    assert arrays.read_arrays(spark, str(tmp_path), damaged="skip").select("path").distinct().count() == 2
    with pytest.raises(Exception, match="shorter than its header"):
        arrays.read_arrays(spark, str(tmp_path)).count()


def test_open_tiles(spark, tmp_path):
    for tile, files in {"a": ("bands.npy", "masks.npy"), "b": ("bands.npy",)}.items():
        (tmp_path / tile).mkdir()
        for name in files:
            shape = (2, 6, 5, 3) if name == "bands.npy" else (2, 6, 5)
            (tmp_path / tile / name).write_bytes(arrays.encode_array(np.zeros(shape, np.float32)))
    references = spark.createDataFrame([("a", 0.0, 1.0, 2.0, 3.0, 32633)], "tile string, left double, bottom double, right double, top double, epsg int")
    row = arrays.open_tiles(spark, str(tmp_path), ["bands.npy", "masks.npy"], references).collect()
    assert [tuple(r) for r in row] == [("a", 2, 6, 5, 0.0, 1.0, 2.0, 3.0, 32633)]
    assert [r.left for r in arrays.open_tiles(spark, str(tmp_path), ["bands.npy"]).collect()] == [None, None]


def test_array_files_are_streamed(spark, tmp_path):
    rng = np.random.default_rng(1)
    made = {k: rng.normal(size=(2, 7, 5, 3)).astype(np.float32) for k in ("p1", "p2")}
    cells = [(k, t, i, j, v[t, i, j].tolist()) for k, v in made.items() for t in range(2) for i in range(7) for j in range(5) if (k, i) != ("p2", 4)]
    frame = spark.createDataFrame(cells, "patch_id string, t int, row int, col int, v array<float>")
    shapes = spark.createDataFrame([("p1", [2, 7, 5, 3]), ("p2", [2, 7, 5, 3]), ("p3", [0, 7, 5, 3]), ("p4", [2, 7])], "patch_id string, shape array<int>")
    lines = arrays.lines(frame, "patch_id", "v", 5, 3, "float32", F.col("t"))
    out = str(tmp_path / "out")
    manifest = {r.patch_id: r for r in arrays.write_arrays(lines.unionByName(lines.filter("patch_id = 'p1'").withColumn("patch_id", F.lit("p5"))), out, "bands", shapes, "patch_id", "float32").collect()}
    assert {k: r.status for k, r in manifest.items()} == {"p1": "done", "p2": "done", "p3": "done", "p4": "done", "p5": "failed"}
    made["p2"][:, 4] = 0
    for k in ("p1", "p2"):
        assert (np.load(f"{out}/{k}/bands.npy") == made[k]).all()
    assert np.load(f"{out}/p3/bands.npy").shape == (0, 7, 5, 3)
    again = arrays.write_arrays(lines, out, "bands", shapes, "patch_id", "float32", done="keep").collect()
    assert {r.status for r in again if r.patch_id in ("p1", "p2")} == {"kept"}
    back = {(r.t, r.row, r.col): r.bands for r in arrays.pixels(arrays.read_arrays(spark, f"{out}/p1")).collect()}
    assert all(back[t, i, j] == made["p1"][t, i, j].astype(float).tolist() for t in range(2) for i in range(7) for j in range(5))


def test_raster_files_are_streamed(spark, tmp_path):
    cells = [("m", i, j, [float(i * 6 + j), 1.0]) for i in range(4) for j in range(6)]
    lines = arrays.lines(spark.createDataFrame(cells, "patch_id string, row int, col int, v array<double>"), "patch_id", "v", 6, 2, "float32")
    shapes = spark.createDataFrame([("m", [4, 6, 2], [10.0, 0.0, 500000.0, 0.0, -10.0, 5300080.0], 32633)], "patch_id string, shape array<int>, affine array<double>, epsg int")
    assert [r.status for r in rasters.write_rasters(lines, str(tmp_path), "map", shapes, "patch_id", "float32").collect()] == ["done"]
    back = rasters.decode_raster((tmp_path / "m" / "map.tif").read_bytes())
    assert back.pixels[2, 3].tolist() == [15.0, 1.0] and back.affine[2] == 500000.0 and back.epsg == 32633
    part = rasters.read_rasters(spark, str(tmp_path), rows=(1, 3), cols=(2, 4)).collect()
    assert {(r.row, r.col): r.bands[0] for r in part} == {(i, j): float(i * 6 + j) for i in (1, 2) for j in (2, 3)}
    box = rasters.bounds(rasters.read_raster_meta(spark, str(tmp_path))).first()
    assert (box.left, box.right, box.top, box.bottom) == (500000.0, 500060.0, 5300080.0, 5300040.0)
    patches = spark.createDataFrame([("e", [10.0, 0.0, 0.0, 0.0, -10.0, 0.0], 32633), ("f", [10.0, 0.0, 50.0, 0.0, -10.0, 0.0], 4326)], "patch_id string, affine array<double>, epsg int")
    ones, shapes = rasters.patch_roi(patches, 50)
    made = rasters.write_rasters(ones, str(tmp_path / "roi"), "roi", shapes, "patch_id", "uint8").collect()
    assert all(r.status == "done" and r.bytes >= 2500 for r in made)
    roi = rasters.decode_raster((tmp_path / "roi" / "f" / "roi.tif").read_bytes())
    assert roi.pixels.shape == (50, 50, 1) and roi.pixels.min() == 1 and roi.epsg == 4326 and roi.affine[2] == 50.0


def test_heads_beyond_four_gigabytes():
    head = rasters.raster_head((40_000, 30_000, 1), np.float32, (10.0, 0.0, 1.0, 0.0, -10.0, 2.0), 32633)
    said = rasters.read_head(lambda n, at: head[at : at + n])
    assert (said.width, said.height, said.dtype, said.epsg) == (30_000, 40_000, np.dtype("<f4"), 32633)
    assert said.strips == (len(head),) and said.counts == (40_000 * 30_000 * 4,)


def test_listings(spark, tmp_path):
    for name, content in {"x/a.zip": b"a", "x/b.tiff": b"abc", "y/c.zip": b"abc", "y/empty.zip": b""}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(content)
    found = files.listing(spark, str(tmp_path))
    assert sorted((r.folder, r.file, r.bytes) for r in found.collect()) == [("x", "a.zip", 1), ("x", "b.tiff", 3), ("y", "c.zip", 3)]
    assert [r.folder for r in files.folders(files.listing(spark, str(tmp_path), "*.zip")).collect()] == ["x", "y"]
    assert sorted(r.file for r in files.usable(found, 2).collect()) == ["b.tiff", "c.zip"]
    assert files.older_than(found, 7200).count() == 0 and files.older_than(found, 7200, "2100-01-01 00:00:00").count() == 3


SQUARE = [[0.0, 0.0], [10.0, 0.0], [10.0, 10.0], [0.0, 10.0], [0.0, 0.0]]
HOLE = [[4.0, 4.0], [6.0, 4.0], [6.0, 6.0], [4.0, 6.0], [4.0, 4.0]]


def test_geojson_of_all_polygons(spark, tmp_path):
    far = [[[x + 20, y] for x, y in SQUARE]]
    features = [
        {"geometry": {"type": "Polygon", "coordinates": [SQUARE, HOLE]}},
        {"geometry": {"type": "MultiPolygon", "coordinates": [[SQUARE], far]}},
        {"geometry": {"type": "GeometryCollection", "geometries": [{"type": "Polygon", "coordinates": far}]}},
    ]
    (tmp_path / "a.json").write_text(json.dumps({"crs": {"properties": {"name": "EPSG:32633"}}, "features": features}))
    rows = catalogues.read_geojson(spark, str(tmp_path / "a.json")).collect()
    assert sorted((r.geometry, r.polygon, r.ring, len(r.points), r.points[0].x) for r in rows) == [(0, 0, 0, 4, 0.0), (0, 0, 1, 4, 4.0), (1, 0, 0, 4, 0.0), (1, 1, 0, 4, 20.0), (2, 0, 0, 4, 20.0)]
    (tmp_path / "b.json").write_text(json.dumps({"features": [{"geometry": {"type": "Point", "coordinates": [1.0, 2.0]}}]}))
    with pytest.raises(Exception, match="not a polygon"):
        catalogues.read_geojson(spark, str(tmp_path / "b.json")).count()


@pytest.mark.parametrize("dtype", ["uint8", "int16", "float32"])
def test_rasters_round_trip(spark, tmp_path, dtype):
    made = rasters.Raster((np.arange(24) % 7).reshape(3, 4, 2).astype(dtype), (10.0, 0.0, 500000.0, 0.0, -10.0, 5300080.0), 32633)
    back = rasters.decode_raster(rasters.encode_raster(made))
    assert (back.pixels == made.pixels).all() and back.affine == made.affine and back.epsg == 32633
    (tmp_path / "a.tiff").write_bytes(rasters.encode_raster(made))
    meta = rasters.read_raster_meta(spark, str(tmp_path)).first()
    assert (meta.width, meta.height, meta.bands, meta.epsg, meta.c) == (4, 3, 2, 32633, 500000.0)
    pixels = rasters.read_rasters(spark, str(tmp_path))
    assert pixels.count() == 12
    assert rasters.nonzero_mask(pixels).count() == int((made.pixels[..., 0] != 0).sum())


def test_damaged_files_fail(spark):
    with pytest.raises(ValueError):
        rasters.decode_raster(b"no raster")
    with pytest.raises(ValueError):
        arrays.decode_array(b"no array")


def test_items_and_lists(spark, tmp_path):
    ring = [[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 0.0]]]
    item = {"id": "S2A_33UWP_1", "geometry": {"type": "Polygon", "coordinates": ring}, "properties": {"datetime": "2022-03-01T10:00:00Z", "eo:cloud_cover": 3.5}, "assets": {"red": {"href": "u"}}}
    (tmp_path / "i").mkdir()
    (tmp_path / "i" / "a.json").write_text(json.dumps(item))
    items = catalogues.read_items(spark, str(tmp_path / "i"))
    row = items.first()
    assert row.cloud_cover == 3.5 and row.baseline is None and len(row.points) == 3
    assets = {r.asset: r.href for r in catalogues.wanted_assets(items).collect()}
    assert len(assets) == 11 and assets["red"] == "u" and assets["scl"] is None
    (tmp_path / "g.json").write_text(json.dumps({"features": [{"geometry": {"type": "Polygon", "coordinates": ring}}]}))
    assert catalogues.read_geojson(spark, str(tmp_path / "g.json")).first().crs == "EPSG:4326"
    (tmp_path / "l.txt").write_text("33UWP\n\n33UXP\n")
    (tmp_path / "l.json").write_text('["33UWP", "33UXP"]')
    for name in ("l.txt", "l.json"):
        assert sorted(r.tile for r in catalogues.read_list(spark, str(tmp_path / name)).collect()) == ["33UWP", "33UXP"]
    catalogues.write_list(spark.createDataFrame([("b",), ("a",), ("b",)], "tile string"), str(tmp_path / "out"))
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ["a", "b"]
    catalogues.write_list(spark.createDataFrame([("b",), ("a",), ("b",)], "tile string"), str(tmp_path / "json"), "json")
    assert sorted(r.tile for r in catalogues.read_list(spark, str(tmp_path / "json")).collect()) == ["a", "b"]


def test_incremental_ingest(spark, tmp_path):
    schema = "tile string, doy int, px int, t int, mask int, v int"
    write = lambda rows: spark.createDataFrame(rows, schema).write.mode("append").parquet(str(tmp_path / "in"))
    run = lambda: ingest.ingest(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, str(tmp_path / "store"), str(tmp_path / "merged"), str(tmp_path / "c"), ["tile", "doy", "px"], "v", "mask", ["t"], ["tile", "doy"]).awaitTermination()
    write([("a", 1, 0, 0, 1, 5), ("a", 2, 0, 0, 0, 7)])
    run()
    write([("a", 2, 0, 1, 1, 8)])
    run()
    rows = ingest.current(spark, str(tmp_path / "merged"), ["tile", "doy"]).select("doy", "v").orderBy("doy").collect()
    assert [tuple(r) for r in rows] == [(1, 5), (2, 8)]
    assert spark.read.parquet(str(tmp_path / "merged")).filter(F.col("batch") == 1).count() == 1
