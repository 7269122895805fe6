"""Minimal GeoTIFF codec (uncompressed strips, one or more bands) and raster tables.

Written from the public TIFF 6.0 and GeoTIFF specifications: enough for region masks,
reference rasters and exported maps.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.workers import ship
from .arrays import stream_files
from .files import listing, opened

#: TIFF field types by number, as struct codes, and the tags used here.
TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 5: "Q", 11: "f", 12: "d", 16: "Q"}
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIPS, SAMPLES, ROWS, COUNTS, PLANAR, FORMAT = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284, 339
PIXEL_SCALE, TIE_POINT, GEO_KEYS = 33550, 33922, 34735
PROJECTED, GEOGRAPHIC = 3072, 2048
FORMATS = {"u": 1, "i": 2, "f": 3}


@dataclass(frozen=True)
class Raster:
    """Pixels (height, width, bands), the affine map (a, b, c, d, e, f) and the EPSG code."""

    pixels: np.ndarray
    affine: tuple[float, float, float, float, float, float]
    epsg: int


def raster_head(shape: tuple[int, int, int], dtype: np.dtype, affine: tuple[float, ...], epsg: int) -> bytes:
    """The head of a little-endian TIFF, pixel-interleaved, its lines in one strip behind it; beyond 4 GB a BigTIFF."""
    h, w, n = shape
    dtype = np.dtype(dtype)
    a, _, c, _, e, f = affine
    model, key = (2, GEOGRAPHIC) if epsg in (4326, 4258) else (1, PROJECTED)
    size = h * w * n * dtype.itemsize
    big = size > 4_000_000_000
    wide, (number, place, cell_bytes) = (16, ("<Q", "<HHQ", 8)) if big else (4, ("<H", "<HHI", 4))
    fields: list[tuple[int, int, tuple]] = [
        (WIDTH, 4, (w,)), (HEIGHT, 4, (h,)), (BITS, 3, (dtype.itemsize * 8,) * n), (COMPRESSION, 3, (1,)), (PHOTOMETRIC, 3, (1,)),
        (STRIPS, wide, (0,)), (SAMPLES, 3, (n,)), (ROWS, 4, (h,)), (COUNTS, wide, (size,)), (PLANAR, 3, (1,)), (FORMAT, 3, (FORMATS[dtype.kind],) * n),
        (PIXEL_SCALE, 12, (a, -e, 0.0)), (TIE_POINT, 12, (0.0, 0.0, 0.0, c, f, 0.0)), (GEO_KEYS, 3, (1, 1, 0, 2, 1024, 0, 1, model, key, 0, 1, epsg)),
    ]
    start = 16 if big else 8
    entry = struct.calcsize(place) + cell_bytes
    base = start + struct.calcsize(number) + entry * len(fields) + cell_bytes
    far, entries, strip_at = b"", b"", 0
    for tag, kind, values in fields:
        body = struct.pack(f"<{len(values)}{TYPES[kind]}", *values)
        if tag == STRIPS:
            strip_at = start + struct.calcsize(number) + len(entries) + struct.calcsize(place)
        if len(body) <= cell_bytes:
            cell = body.ljust(cell_bytes, b"\0")
        else:
            cell = (base + len(far)).to_bytes(cell_bytes, "little")
            far += body + b"\0" * (len(body) % 2)
        entries += struct.pack(place, tag, kind, len(values)) + cell
    opening = b"II+\0" + struct.pack("<HHQ", 8, 0, 16) if big else b"II*\0" + struct.pack("<I", 8)
    out = bytearray(opening + struct.pack(number, len(fields)) + entries + bytes(cell_bytes) + far)
    out[strip_at : strip_at + cell_bytes] = len(out).to_bytes(cell_bytes, "little")
    return bytes(out)


def encode_raster(raster: Raster) -> bytes:
    """Bytes of a raster file."""
    data = raster.pixels if raster.pixels.ndim == 3 else raster.pixels[..., None]
    data = np.ascontiguousarray(data.astype(data.dtype.newbyteorder("<")))
    return raster_head(data.shape, data.dtype, raster.affine, raster.epsg) + data.tobytes()


@dataclass(frozen=True)
class Head:
    """What a raster file says of itself, and where its strips of lines lie."""

    width: int
    height: int
    bands: int
    dtype: np.dtype
    affine: tuple[float, float, float, float, float, float]
    epsg: int
    rows: int
    strips: tuple[int, ...]
    counts: tuple[int, ...]


def read_head(read) -> Head:
    """The head of an uncompressed, pixel-interleaved (Big)TIFF in either byte order; read gives (count, offset) bytes."""
    opening = read(16, 0)
    order = {b"II": "<", b"MM": ">"}.get(opening[:2])
    version = struct.unpack_from(f"{order}H", opening, 2)[0] if order and len(opening) >= 8 else 0
    if version not in (42, 43):
        raise ValueError("not a TIFF file")
    big = version == 43
    (at,) = struct.unpack_from(f"{order}Q", opening, 8) if big else struct.unpack_from(f"{order}I", opening, 4)
    number, place, cell = (f"{order}Q", f"{order}HHQ", 8) if big else (f"{order}H", f"{order}HHI", 4)
    (count,) = struct.unpack(number, read(struct.calcsize(number), at))
    entry = struct.calcsize(place) + cell
    table = read(entry * count, at + struct.calcsize(number))
    fields: dict[int, tuple] = {}
    for k in range(count):
        tag, kind, n = struct.unpack_from(place, table, entry * k)
        if kind not in TYPES:
            continue
        code = f"{order}{n}{TYPES[kind]}"
        inner = table[entry * k + struct.calcsize(place) : entry * (k + 1)]
        size = struct.calcsize(code)
        if size > cell:
            (far,) = struct.unpack(f"{order}{'Q' if big else 'I'}", inner)
            inner = read(size, far)
        fields[tag] = struct.unpack_from(code, inner)
    if fields.get(COMPRESSION, (1,))[0] != 1 or fields.get(PLANAR, (1,))[0] != 1:
        raise ValueError("compressed or band-separate rasters aren't supported")
    letter = {v: k for k, v in FORMATS.items()}[fields.get(FORMAT, (1,))[0]]
    scale, tie = fields.get(PIXEL_SCALE, (1.0, 1.0, 0.0)), fields.get(TIE_POINT, (0.0,) * 6)
    keys = fields.get(GEO_KEYS, ())
    codes = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i + 1] == 0}
    left, top = tie[3] - tie[0] * scale[0], tie[4] + tie[1] * scale[1]
    height = fields[HEIGHT][0]
    return Head(
        fields[WIDTH][0], height, fields.get(SAMPLES, (1,))[0], np.dtype(f"{order}{letter}{fields[BITS][0] // 8}"), (scale[0], 0.0, left, 0.0, -scale[1], top),
        codes.get(PROJECTED, codes.get(GEOGRAPHIC, 4326)), min(fields.get(ROWS, (height,))[0], height), fields[STRIPS], fields[COUNTS],
    )


def read_lines(read, head: Head, first: int, last: int) -> np.ndarray:
    """Lines first..last-1 of a raster, as (lines, width, bands): only their bytes are read."""
    line = head.width * head.bands * head.dtype.itemsize
    parts = []
    row = first
    while row < last:
        strip = row // head.rows
        n = min(last, (strip + 1) * head.rows) - row
        parts.append(read(n * line, head.strips[strip] + (row - strip * head.rows) * line))
        row += n
    return np.frombuffer(b"".join(parts), head.dtype).reshape(-1, head.width, head.bands).astype(head.dtype.newbyteorder("="))


def decode_raster(content: bytes) -> Raster:
    """The raster of a file's bytes."""
    read = lambda n, at: content[at : at + n]
    head = read_head(read)
    return Raster(read_lines(read, head, 0, head.height), head.affine, head.epsg)


def read_raster_meta(spark: SparkSession, path: str) -> DataFrame:
    """path, folder, width, height, bands, epsg, the affine map and error of the rasters below path: heads alone are read."""
    ship(spark)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rows = []
            for file, folder in zip(frame["path"], frame["folder"]):
                try:
                    with opened(file) as f:
                        head = read_head(f.read_at)
                    rows.append((file, folder, head.width, head.height, head.bands, head.epsg, *head.affine, None))
                except Exception as error:  # any damage is this file's, not the job's
                    rows.append((file, folder, *[None] * 10, f"{type(error).__name__}: {error}"))
            yield pd.DataFrame(rows, columns=["path", "folder", "width", "height", "bands", "epsg", *"abcdef", "error"]).astype({c: "Int64" for c in ("width", "height", "bands", "epsg")})

    meta = "path string, folder string, width int, height int, bands int, epsg int, " + ", ".join(f"{c} double" for c in "abcdef") + ", error string"
    return listing(spark, path, "*.tif*").select("path", "folder").mapInPandas(run, meta)


def bounds(meta: DataFrame) -> DataFrame:
    """meta with left, bottom, right, top of each raster."""
    far = {"right": F.col("c") + F.col("a") * F.col("width"), "bottom": F.col("f") + F.col("e") * F.col("height")}
    return meta.withColumns({"left": F.col("c"), "top": F.col("f"), **far})


def read_rasters(spark: SparkSession, path: str, rows: tuple[int, int] | None = None, cols: tuple[int, int] | None = None, slab_bytes: int = 32 << 20) -> DataFrame:
    """path, row, col, bands of the pixels of the rasters below path, within half-open windows of rows and columns.

    Rasters are read in slabs of lines, each a task's share; lines outside the window aren't read.
    A damaged file fails the job (read_raster_meta names it).
    """
    ship(spark)
    heads = read_raster_meta(spark, path)
    heads = heads.withColumn("height", F.when(F.col("error").isNull(), F.col("height")).otherwise(F.raise_error(F.concat_ws(": ", "path", "error")).cast("int")))
    low, high = (F.lit(rows[0]), F.least("height", F.lit(rows[1]))) if rows else (F.lit(0), F.col("height"))
    span = F.greatest(F.lit(1), F.floor(F.lit(slab_bytes) / (F.col("width") * F.col("bands") * 8))).cast("int")
    slabs = heads.select("path", low.alias("_low"), high.alias("_high"), span.alias("_span")).filter("_low < _high")
    slabs = slabs.withColumn("first", F.explode(F.sequence(F.col("_low"), F.col("_high") - 1, F.col("_span"))))
    slabs = slabs.select("path", "first", F.least(F.col("first") + F.col("_span"), F.col("_high")).alias("last"))
    slabs = slabs.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    left, right = cols or (0, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, first, last in zip(*(c.to_pylist() for c in batch.columns)):
                with opened(file) as f:
                    data = read_lines(f.read_at, read_head(f.read_at), first, last)[:, left:right].astype(float)
                for k, line in enumerate(data):
                    w, n = line.shape
                    found = pa.ListArray.from_arrays(pa.array(np.arange(0, w * n + 1, n, dtype=np.int32)), pa.array(line.ravel()))
                    yield pa.RecordBatch.from_arrays([pa.array([file] * w), pa.array([first + k] * w, pa.int32()), pa.array(np.arange(left, left + w, dtype=np.int32)), found], ["path", "row", "col", "bands"])

    return slabs.mapInArrow(run, "path string, row int, col int, bands array<double>")


def write_rasters(made: DataFrame, folder: str, name: str, shapes: DataFrame, key: str, dtype: str, done: str = "replace") -> DataFrame:
    """Writes folder/<key>/<name>.tif for every key of shapes (key, shape, affine: array of six, epsg) from lines (key, t, row, data).

    Lines, manifest and failures are those of arrays.write_arrays; shape is height, width, bands.
    """
    spark = made.sparkSession
    ship(spark)
    kind = dict(shapes.dtypes)[key]
    # the affine and the code ride in the bytes of the row with the shape
    facts = F.encode(F.to_json(F.struct("affine", "epsg")), "utf-8")
    heads = shapes.select(key, F.lit(-1).alias("t"), F.lit(-1).alias("row"), facts.alias("data"), "shape")
    rows = heads.unionByName(made.select(key, "t", "row", "data", F.lit(None).cast("array<int>").alias("shape")))
    rows = rows.repartition(key).sortWithinPartitions(key, "t", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        facts_of: dict = {}  # of the files whose shape was read but whose head isn't written yet
        current: list[dict] = [{}]

        def seen(batch: pa.RecordBatch) -> pa.RecordBatch:
            for name_, row, data in zip(*(batch.column(c).to_pylist() for c in (key, "row", "data"))):
                if row == -1:
                    facts_of[name_] = json.loads(data)
            return batch

        def named(k) -> str:
            current[0] = facts_of.pop(k, {})
            return f"{folder.rstrip('/')}/{k}/{name}.tif"

        head = lambda shape: raster_head(tuple(shape), np.dtype(dtype), tuple(current[0]["affine"]), current[0]["epsg"])
        yield from stream_files(map(seen, batches), key, kind, named, head, np.dtype(dtype).itemsize, done)

    return rows.mapInArrow(run, f"{key} {kind}, path string, bytes long, status string, error string")


def patch_roi(patches: DataFrame, patch: int) -> tuple[DataFrame, DataFrame]:
    """Lines and shapes of the region rasters of patches (patch_id, affine, epsg): `patch` by `patch` ones, for write_rasters."""
    ones = patches.select("patch_id", F.lit(0).alias("t"), F.explode(F.sequence(F.lit(0), F.lit(patch - 1))).alias("row"), F.lit(bytearray(b"\1" * patch)).alias("data"))
    return ones, patches.select("patch_id", F.array(F.lit(patch), F.lit(patch), F.lit(1)).alias("shape"), "affine", "epsg")


def nonzero_mask(raster: DataFrame) -> DataFrame:
    """row, col of a mask's pixels that aren't zero."""
    return raster.filter(F.col("bands")[0] != 0).select("row", "col")
