"""Array files (.npy) as tables of chunks, and back.

Only headers and the wanted ranges of bytes are read: a file is cut into slabs, which are
tasks of their own, so its size is bounded by neither a task's memory nor a cell's. Writers stream
lines of pixels to a file in order. A damaged file is a row with an error, or fails the job.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.workers import ship
from .files import listing, opened, written_whole

CHUNKS = "path string, t int, row0 int, col0 int, shape array<int>, dtype string, data binary"
#: Bytes of a slab, one line of pixels at least.
SLAB_BYTES = 32 << 20


def decode_array(content: bytes) -> np.ndarray:
    """The array of an .npy file's bytes; pickled objects are refused."""
    return np.load(io.BytesIO(content), allow_pickle=False)


def encode_array(array: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, array, allow_pickle=False)
    return out.getvalue()


def header(shape: tuple[int, ...], dtype: np.dtype) -> bytes:
    """The head of an .npy file in C order."""
    out = io.BytesIO()
    np.lib.format.write_array_header_1_0(out, {"descr": np.lib.format.dtype_to_descr(np.dtype(dtype)), "fortran_order": False, "shape": tuple(shape)})
    return out.getvalue()


def read_header(file) -> tuple[tuple[int, ...], np.dtype, int]:
    """Shape, dtype and place of the data of an open .npy file; its size must fit."""
    head = io.BytesIO(file.read_at(min(file.size(), 1 << 16), 0))
    version = np.lib.format.read_magic(head)
    read = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
    shape, fortran, dtype = read(head)
    if fortran or dtype.hasobject:
        raise ValueError("only plain arrays in C order are supported")
    if file.size() < head.tell() + dtype.itemsize * int(np.prod(shape, dtype=np.int64)):
        raise ValueError("the file is shorter than its header says")
    return shape, dtype, head.tell()


def read_shapes(spark: SparkSession, path: str) -> DataFrame:
    """path, folder, file, bytes, shape, dtype, offset, error of the .npy files below path: headers alone are read."""
    ship(spark)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            rows = []
            for file in frame["path"]:
                try:
                    with opened(file) as f:
                        shape, dtype, offset = read_header(f)
                    rows.append((list(shape), dtype.str, offset, None))
                except Exception as error:  # any damage is this file's, not the job's
                    rows.append((None, None, None, f"{type(error).__name__}: {error}"))
            yield frame.assign(**{name: [r[k] for r in rows] for k, name in enumerate(("shape", "dtype", "offset", "error"))})

    files = listing(spark, path, "*.npy").select("path", "folder", "file", "bytes").repartition(max(1, spark.sparkContext.defaultParallelism))
    return files.mapInPandas(run, "path string, folder string, file string, bytes long, shape array<int>, dtype string, offset long, error string")


def read_arrays(spark: SparkSession, path: str, rows: tuple[int, int] | None = None, cols: tuple[int, int] | None = None, steps: tuple[int, int] | None = None, slab_bytes: int = SLAB_BYTES, damaged: str = "fail") -> DataFrame:
    """path, t, row0, col0, shape, dtype, data: slabs of the .npy files below path.

    Files of four or three axes are series (t, rows, columns, ...), others a single step: of two
    axes (rows, columns), of one a line. rows, cols and steps are half-open windows: lines outside are
    not read, and columns outside not kept. damaged: "fail", or "skip" (read_shapes names them).
    """
    ship(spark)
    files = read_shapes(spark, path)
    if damaged == "skip":
        files = files.filter("error is null")
    else:
        files = files.withColumn("shape", F.when(F.col("error").isNull(), F.col("shape")).otherwise(F.raise_error(F.concat_ws(": ", "path", "error")).cast("array<int>")))
    axes = F.size("shape")
    one = F.lit(1)
    t = F.when(axes >= 3, F.col("shape")[0]).otherwise(one)
    h = F.when(axes >= 3, F.col("shape")[1]).when(axes == 2, F.col("shape")[0]).otherwise(one)
    w = F.when(axes >= 3, F.col("shape")[2]).otherwise(F.coalesce(F.element_at("shape", F.when(axes > 0, -1).otherwise(None)), one))
    files = files.withColumns({"_t": t, "_h": h, "_w": w, "_b": F.when(axes > 3, F.col("shape")[3])})
    item = F.regexp_extract("dtype", r"(\d+)$", 1).cast("long")
    line = item * F.col("_w") * F.coalesce("_b", one)
    low, high = (F.lit(rows[0]), F.least("_h", F.lit(rows[1]))) if rows else (F.lit(0), F.col("_h"))
    first, last = (F.lit(steps[0]), F.least("_t", F.lit(steps[1]))) if steps else (F.lit(0), F.col("_t"))
    span = F.greatest(one, F.floor(F.lit(slab_bytes) / F.greatest(line, one))).cast("int")
    files = files.withColumns({"_low": low, "_high": high, "_first": first, "_last": last, "_span": span}).filter("_low < _high and _first < _last and _w > 0")
    slabs = files.withColumn("t", F.explode(F.sequence("_first", F.col("_last") - 1)))
    slabs = slabs.withColumn("row0", F.explode(F.sequence(F.col("_low"), F.col("_high") - 1, F.col("_span"))))
    slabs = slabs.withColumn("rows", F.least(F.col("_span"), F.col("_high") - F.col("row0"))).select("path", "t", "row0", "rows", "_h", "_w", "_b", "dtype", "offset")
    slabs = slabs.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    left, right = cols or (0, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path_, t_, row0, n, h_, w_, b_, kind, offset in zip(*(c.to_pylist() for c in batch.columns)):
                dtype, bands = np.dtype(kind), b_ or 1
                size = dtype.itemsize * w_ * bands
                with opened(path_) as file:
                    data = file.read_at(size * n, offset + size * (t_ * h_ + row0))
                part = np.frombuffer(data, dtype).reshape((n, w_, bands) if b_ is not None else (n, w_))[:, left:right]
                made = {"path": path_, "t": t_, "row0": row0, "col0": left, "shape": list(part.shape), "dtype": dtype.str, "data": np.ascontiguousarray(part).tobytes()}
                yield pa.RecordBatch.from_pylist([made], _ARROW)

    return slabs.mapInArrow(run, CHUNKS)


_ARROW = pa.schema([("path", pa.string()), ("t", pa.int32()), ("row0", pa.int32()), ("col0", pa.int32()), ("shape", pa.list_(pa.int32())), ("dtype", pa.string()), ("data", pa.binary())])


def pixels(chunks: DataFrame) -> DataFrame:
    """path, t, row, col, bands (array<double>): chunks of (h, w, b), or of (h, w) as one band."""
    ship(chunks.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, t, row0, col0, shape, dtype, data in zip(*(c.to_pylist() for c in batch.columns)):
                part = np.frombuffer(data, dtype).reshape(shape).astype(float)
                part = part if part.ndim == 3 else part[..., None]
                for k, line in enumerate(part):  # a line at a time bounds the batch
                    w, b = line.shape
                    bands = pa.ListArray.from_arrays(pa.array(np.arange(0, w * b + 1, b, dtype=np.int32)), pa.array(line.ravel()))
                    at = [pa.array([v] * w, pa.int32()) for v in (t, row0 + k)]
                    yield pa.RecordBatch.from_arrays([pa.array([file] * w), *at, pa.array(np.arange(col0, col0 + w, dtype=np.int32)), bands], ["path", "t", "row", "col", "bands"])

    return chunks.select("path", "t", "row0", "col0", "shape", "dtype", "data").mapInArrow(run, "path string, t int, row int, col int, bands array<double>")


def tiles_complete(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """tile: folders below path that hold every required file, from the listing alone."""
    from ..operators.scenes import complete

    return complete(listing(spark, path).select(F.col("folder").alias("tile"), "file"), required)


def open_tiles(spark: SparkSession, path: str, required: list[str], references: DataFrame | None = None) -> DataFrame:
    """tile, steps, height, width, left, bottom, right, top, epsg of the folders that hold every required array, unharmed.

    Sizes come from the largest array's header. references: tile and the rest, of the tiles'
    reference rasters; a tile without one keeps its size and has no bounds.
    """
    arrays = read_shapes(spark, path).filter("error is null").withColumn("tile", F.col("folder"))
    from ..operators.scenes import complete

    held = arrays.join(complete(arrays.select("tile", "file"), required), "tile", "left_semi")
    sized = held.filter(F.size("shape") >= 3).groupBy("tile").agg(F.max_by("shape", F.struct("bytes", "file")).alias("s"))
    sized = sized.select("tile", F.col("s")[0].alias("steps"), F.col("s")[1].alias("height"), F.col("s")[2].alias("width"))
    bounds = ("left", "bottom", "right", "top", "epsg")
    if references is None:
        return sized.select("*", *[F.lit(None).cast("int" if c == "epsg" else "double").alias(c) for c in bounds])
    return sized.join(references.select("tile", *bounds), "tile", "left")


def write_chunks(cells: DataFrame, path: str, by: str, mode: str = "error") -> None:
    """Writes a table partitioned by a key; mode "ignore" keeps what is there, "overwrite" replaces it."""
    cells.write.mode(mode).partitionBy(by).parquet(path)


def lines(cells: DataFrame, key: str, value: str, width: Column | int, bands: int, dtype: str, step: Column | int = 0) -> DataFrame:
    """key, t, row, data: each line of pixels of rows (key, row, col, value: array or number) as bytes, zeros where none is.

    A line is the unit that meets in a task; width bounds it.
    """
    ship(cells.sparkSession)
    kind = dict(cells.dtypes)
    values = F.col(value) if kind[value].startswith("array") else F.array(value)
    cell = F.struct(F.col("col").cast("int").alias("col"), F.transform(values, lambda x: x.cast("double")).alias("v"))
    width, step = (F.lit(x) if isinstance(x, int) else x for x in (width, step))
    rows = cells.groupBy(key, step.cast("int").alias("t"), F.col("row").cast("int").alias("row"), width.cast("int").alias("_w")).agg(F.collect_list(cell).alias("cells"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                w = batch.column("_w")[k].as_py()
                held = batch.column("cells")[k].values
                at = np.asarray(held.field("col"))
                line = np.zeros((w, bands), dtype)
                inside = (at >= 0) & (at < w)
                line[at[inside]] = np.asarray(held.field("v").flatten()).reshape(-1, bands)[inside].astype(dtype)
                yield pa.RecordBatch.from_arrays([batch.column(key).slice(k, 1), batch.column("t").slice(k, 1), batch.column("row").slice(k, 1), pa.array([line.tobytes()], pa.binary())], [key, "t", "row", "data"])

    return rows.mapInArrow(run, f"{key} {kind[key]}, t int, row int, data binary")


def write_arrays(made: DataFrame, folder: str, name: str, shapes: DataFrame, key: str, dtype: str, done: str = "replace") -> DataFrame:
    """Writes folder/<key>/<name>.npy for every key of shapes (key, shape) from lines (key, t, row, data).

    Returns key, path, bytes, status (done, kept, failed), error. One task streams the lines
    of a file in order, so it holds one line; lines that are missing, or all where a series
    has no steps, are zeros. A file appears when it is complete; with done="keep" it isn't written again, and a
    failure is a row, not the end of the job. Nothing is written until the result is read.
    """
    spark = made.sparkSession
    ship(spark)
    kind = dict(shapes.dtypes)[key]
    heads = shapes.select(key, F.lit(-1).alias("t"), F.lit(-1).alias("row"), F.lit(None).cast("binary").alias("data"), "shape")
    rows = heads.unionByName(made.select(key, "t", "row", "data", F.lit(None).cast("array<int>").alias("shape")))
    rows = rows.repartition(key).sortWithinPartitions(key, "t", "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from stream_files(batches, key, kind, lambda k: f"{folder.rstrip('/')}/{k}/{name}.npy", lambda shape: header(shape, np.dtype(dtype)), np.dtype(dtype).itemsize, done)

    return rows.mapInArrow(run, f"{key} {kind}, path string, bytes long, status string, error string")


def stream_files(batches: Iterator[pa.RecordBatch], key: str, kind: str, path_of, head_of, itemsize: int, done: str) -> Iterator[pa.RecordBatch]:
    """Writes files from rows (key, t, row, data, shape) in order, the row with the shape first; yields the manifest."""
    rows = (r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in (key, "t", "row", "data", "shape"))))
    at = next(rows, None)
    while at is not None:
        name, shape, path = at[0], at[4], path_of(at[0])
        taken = {"next": next(rows, None)}

        def of_this() -> Iterator[tuple]:
            while taken["next"] is not None and taken["next"][0] == name:
                yield taken["next"]
                taken["next"] = next(rows, None)

        status, error, size = "done", None, 0
        try:
            if shape is None:
                raise ValueError("lines without a shape")
            if done == "keep" and _exists(path):
                status = "kept"
            else:
                size = _stream(path, head_of(shape), shape, itemsize, of_this())
        except Exception as problem:  # this file's failure; the others go on
            status, error = "failed", f"{type(problem).__name__}: {problem}"
        for _ in of_this():
            pass
        yield pa.RecordBatch.from_pylist([{key: name, "path": path, "bytes": size, "status": status, "error": error}], pa.schema([(key, _arrow_type(kind)), ("path", pa.string()), ("bytes", pa.int64()), ("status", pa.string()), ("error", pa.string())]))
        at = taken["next"]


def _arrow_type(kind: str) -> pa.DataType:
    return {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}[kind]


def _exists(path: str) -> bool:
    from .files import place

    system, inner = place(path)
    return system.get_file_info(inner).is_file


def _stream(path: str, head: bytes, shape: list[int], itemsize: int, rows: Iterator[tuple]) -> int:
    """One file: its head, then its lines in order, zeros for those that are missing."""
    steps, height, width, bands = ([1] * (4 - len(shape)) + list(shape)) if len(shape) != 3 else [1, *shape]
    line, total = itemsize * width * bands, steps * height
    with written_whole(path) as file:
        file.write(head)
        at = 0
        for _, t, row, data, _ in rows:
            place = t * height + row
            if not (0 <= t < steps and 0 <= row < height) or len(data) != line or place < at:
                raise ValueError(f"line {row} of step {t} doesn't fit the shape {shape}")
            _zeros(file, (place - at) * line)
            file.write(data)
            at = place + 1
        _zeros(file, (total - at) * line)
    return len(head) + total * line


def _zeros(file, count: int) -> None:
    block = bytes(min(count, 1 << 20))
    while count > 0:
        file.write(block[: min(count, len(block))])
        count -= len(block)
