"""The three lifecycles as plans: observations to patches, patches to vectors, vectors to a map.

Each returns a DataFrame that the caller writes; what is written is not computed again
(`pending`). Failures of single keys are rows of a status table, not lost work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import scalar
from ..operators import grid, network, scenes, series


def radar_stack(amplitudes: DataFrame) -> DataFrame:
    """tile, orbit, doy, gx, gy, bands: scaled mosaics of rows (tile, name, gx, gy, vv, vh).

    Scenes of one orbit and day are laid over each other in order of their names, the last
    non-zero amplitude of each band wins, and the winners are scaled.
    """
    name = F.col("name")
    rows = amplitudes.withColumns({"orbit": scalar.orbit_of_name(name), "doy": scalar.doy_of_name(name)})
    rank = lambda band: F.struct((F.col(band) != 0).alias("seen"), "name")
    best = rows.groupBy("tile", "orbit", "doy", "gx", "gy").agg(F.max_by("vv", rank("vv")).alias("vv"), F.max_by("vh", rank("vh")).alias("vh"))
    return best.select("tile", "orbit", "doy", "gx", "gy", F.array(scalar.sar_db(F.col("vv")), scalar.sar_db(F.col("vh"))).alias("bands"))


def retile(spark: SparkSession, roi: DataFrame, tiles: DataFrame, optical: DataFrame, radar: DataFrame, width: int, height: int, size: int, done: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Merged optical (patch_id, idx, doy, bands, mask) and radar (patch_id, idx, orbit, doy, bands) series.

    roi: row, col, v; tiles: tile, x0, y0, x1, y1 in pixels of the map; optical: tile, t,
    doy, gx, gy, mask, bands; radar: tile, orbit, doy, gx, gy, bands. Tiles that meet no
    wanted patch are pruned before their pixels are read; a pixel's patch follows from its
    place, so no join on pixels is needed. Tiles are laid over each other by their code.
    """
    patches = grid.patches_with_data(grid.patch_grid(spark, width, height, size), roi, size)
    if done is not None:
        patches = scenes.pending(patches, done, "patch_id")
    boxes = patches.select("patch_id", *[F.col(c).cast("double").alias(c) for c in ("x0", "y0", "x1", "y1")])
    met = grid.overlapping(boxes, tiles, float(size), "patch_id", "tile").select("tile").distinct()
    place = patches.select("patch_id", "px", "py", "x0", "y0", "x1")

    def placed(rows: DataFrame) -> DataFrame:
        rows = rows.join(met, "tile", "left_semi").filter((F.col("gx") >= 0) & (F.col("gy") >= 0) & (F.col("gx") < width) & (F.col("gy") < height))
        rows = rows.withColumns({"px": F.expr(f"gx div {size}").cast("int"), "py": F.expr(f"gy div {size}").cast("int")}).join(place, ["px", "py"])
        return rows.withColumn("idx", ((F.col("gy") - F.col("y0")) * (F.col("x1") - F.col("x0")) + F.col("gx") - F.col("x0")).cast("long"))

    left = series.merge_valid_first(placed(optical), ["patch_id", "idx", "doy"], "bands", "mask", ["tile", "t"])
    right = series.merge_last(placed(radar), ["patch_id", "idx", "orbit", "doy"], "bands", ["tile"])
    return left, right


def single_tile(observations: DataFrame, patches: DataFrame) -> DataFrame:
    """Observations (patch_id, idx, tile, ...) of patches that one tile alone covers: nothing to merge, days aren't made distinct."""
    alone = patches.groupBy("patch_id").agg(F.count_distinct("tile").alias("n")).filter("n = 1").select("patch_id")
    return observations.join(alone, "patch_id", "left_semi")


def embed(optical: DataFrame, radar: DataFrame, weights: dict, config: network.Config, optical_facts: tuple[list[float], list[float]], radar_facts: tuple[list[float], list[float]], least: int = 0, seed: int = 0, failures: bool = False) -> DataFrame:
    """patch_id, idx, vec of the valid pixels of both merged series.

    Steps are sampled with a seed; radar steps are ordered by orbit, then day. Pixels without
    any radar step get no vector; the map then holds zeros for them. With failures, pixels that can't be computed
    are rows with an error and no vector.
    """
    keys = ["patch_id", "idx"]
    valid = series.valid_pixels(optical, radar, keys, least).select(*keys)
    both = radar.withColumn("step", F.when(F.col("orbit") == "A", 0).otherwise(1000) + F.col("doy"))
    parts = []
    for name, rows, step, ok, facts in (
        ("s2", optical, "doy", F.col("mask") != 0, optical_facts),
        ("s1", both, "step", F.exists("bands", lambda x: x != 0), radar_facts),
    ):
        rows = rows.join(valid, keys, "left_semi")
        drawn = series.sample_steps(rows, keys, step, config.steps, seed, valid=ok)
        fields = list(dict.fromkeys([*keys, step, "bands", "doy"]))
        parts.append(network.model_input(drawn.join(rows.select(*fields), [*keys, step]), keys, *facts, name))
    return network.represent(parts[0].join(parts[1], keys), keys, weights, config, failures=failures)


def failed_patches(vectors: DataFrame) -> DataFrame:
    """patch_id, error: patches of which a pixel failed, with its least message, for status()."""
    return vectors.filter("error is not null").groupBy("patch_id").agg(F.min("error").alias("error"))


def stitched(spark: SparkSession, vectors: DataFrame, width: int, height: int, bands: int = 128) -> DataFrame:
    """row, col, vec of the whole map: patches at their place, zeros where no pixel has a vector."""
    corner = F.split("patch_id", "_")
    x0, y0, x1 = (corner[k].cast("int") for k in range(3))
    rows = vectors.withColumns({"ox": x0, "oy": y0, "_w": x1 - x0})
    rows = rows.withColumns({"col": (F.col("idx") % F.col("_w")).cast("int"), "row": F.floor(F.col("idx") / F.col("_w")).cast("int")})
    shifted = grid.stitch(rows, "vec", ["patch_id"]).withColumn("cell", (F.col("row") * width + F.col("col")).cast("long")).select("cell", "vec")
    cells = grid.dense(spark, shifted, "cell", width * height, {"vec": F.array_repeat(F.lit(0.0).cast("float"), bands)})
    return cells.select(F.floor(F.col("cell") / width).cast("int").alias("row"), (F.col("cell") % width).cast("int").alias("col"), "vec")


def status(wanted: DataFrame, made: DataFrame, failed: DataFrame | None = None, key: str = "patch_id") -> DataFrame:
    """key, status (done, failed, missing) and error of every wanted key."""
    rows = wanted.select(key).join(made.select(key).distinct().withColumn("_made", F.lit(True)), key, "left")
    if failed is not None:
        rows = rows.join(failed.select(key, "error"), key, "left")
    else:
        rows = rows.withColumn("error", F.lit(None).cast("string"))
    state = F.when(F.col("_made"), "done").when(F.col("error").isNotNull(), "failed").otherwise("missing")
    return rows.select(key, state.alias("status"), "error")


def progress(states: DataFrame, seconds: float) -> DataFrame:
    """total, done, failed, missing, keys an hour, and the time that the missing ones need at that rate (null without any done)."""
    n = lambda state: F.count_if(F.col("status") == state).alias(state)
    counts = states.agg(F.count(F.lit(1)).alias("total"), n("done"), n("failed"), n("missing"))
    rate = F.col("done") * F.lit(3600.0 / max(seconds, 1e-9))
    return counts.withColumns({"per_hour": rate, "eta": scalar.duration_text(F.floor(F.try_divide(F.col("missing") * F.lit(3600.0), rate)))})


def first_keys(work: DataFrame, key: str, n: int = 3) -> DataFrame:
    """The first keys of a work list, for display."""
    return work.select(key).distinct().orderBy(key).limit(n)


def run_stage(spark: SparkSession, wanted: DataFrame, make, path: str, key: str = "patch_id") -> DataFrame:
    """Makes the rows of the wanted keys that aren't in the table at path yet, appends them, and returns every key's status.

    make(pending) gives rows with the key and, of keys that failed, an error; their message goes to
    path_failed, and a later run tries them again. A run that stops midway loses nothing that was appended.
    """
    done = _table(spark, path)
    todo = wanted.select(key).distinct() if done is None else scenes.pending(wanted.select(key).distinct(), done, key)
    made = make(todo)
    bad = F.col("error").isNotNull() if "error" in made.columns else F.lit(False)
    if "error" in made.columns:
        made.write.mode("overwrite").parquet(f"{path}_last")  # decided once, then dealt out
        made = spark.read.parquet(f"{path}_last")
        made.filter(bad).groupBy(key).agg(F.min("error").alias("error")).write.mode("overwrite").parquet(f"{path}_failed")
        good = scenes.pending(made, spark.read.parquet(f"{path}_failed"), key).drop("error")
    else:
        good = made
    good.write.mode("append").parquet(path)
    failed = spark.read.parquet(f"{path}_failed") if "error" in made.columns else None
    return status(wanted.select(key).distinct(), spark.read.parquet(path), failed, key)


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at path, or None where nothing was written yet."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return None
    return spark.read.parquet(path)
