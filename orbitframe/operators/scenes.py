"""Scene catalogue operators: filters, listings, states of tiles, work lists, retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Files of a finished tile, optical and radar.
OPTICAL_FILES = ("band_mean.npy", "bands.npy", "band_std.npy", "doys.npy", "masks.npy")
RADAR_FILES = ("sar_ascending.npy", "sar_ascending_doy.npy", "sar_descending.npy", "sar_descending_doy.npy")


def filter_optical(scenes: DataFrame, tile: str, start: str, end: str, cloud: float = 90, baseline: str = "05.00") -> DataFrame:
    """Scenes (id, datetime, cloud_cover, baseline) of a tile within closed dates; a missing cloud cover passes."""
    prefix = tile.removeprefix("0") if tile.startswith("0") else tile
    return scenes.filter(
        (F.startswith("id", F.lit(f"S2A_{prefix}_")) | F.startswith("id", F.lit(f"S2B_{prefix}_")))
        & (F.col("baseline") == baseline)
        & F.col("datetime").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))
        & (F.coalesce(F.col("cloud_cover"), F.lit(0.0)) <= float(int(cloud)))
    )


def filter_radar(scenes: DataFrame, start: str, end: str, least_bytes: int = 10_000_000) -> DataFrame:
    """Scenes (platform, level, polarisation, datetime, bands, bytes) fit for stacking."""
    return scenes.filter(
        F.col("platform").isin("Sentinel-1A", "Sentinel-1B")
        & (F.col("level") == "GRD_HD")
        & (F.col("polarisation") == "VV+VH")
        & F.col("datetime").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))
        & holds_all("bands", ["Intensity_VV", "Intensity_VH"])
        & (F.col("bytes") >= least_bytes)
    )


def holds_all(column: str, wanted: list[str]) -> Column:
    """Whether an array column holds all wanted values."""
    return F.size(F.array_except(F.array(*map(F.lit, wanted)), F.col(column))) == 0


def complete(files: DataFrame, required: list[str], by: str = "tile") -> DataFrame:
    """Groups of rows (by, file) that hold every required file."""
    found = files.filter(F.col("file").isin(*required)).groupBy(by).agg(F.countDistinct("file").alias("n"))
    return found.filter(F.col("n") == len(required)).select(by)


def tile_status(files: DataFrame, by: str = "tile") -> DataFrame:
    """by, status: ALL_DONE, S2_DONE_ONLY or NOT_DONE by the files that exist."""
    held = lambda names: F.count_distinct(F.when(F.col("file").isin(*names), F.col("file"))) == len(names)
    states = files.groupBy(by).agg(held(OPTICAL_FILES).alias("optical"), held(RADAR_FILES).alias("radar"))
    status = F.when(F.col("optical") & F.col("radar"), "ALL_DONE").when(F.col("optical"), "S2_DONE_ONLY").otherwise("NOT_DONE")
    return states.select(by, status.alias("status"))


def first_source(rows: DataFrame, by: str, priority: str) -> DataFrame:
    """Of each group only the rows of its best (least) priority."""
    best = Window.partitionBy(by).orderBy(priority)
    return rows.withColumn("_rank", F.rank().over(best)).filter(F.col("_rank") == 1).drop("_rank")


def reference_lookup(keys: DataFrame, references: DataFrame, on: str, value: str, fallback: Column) -> DataFrame:
    """keys with the least reference value of each, or the fallback."""
    least = references.groupBy(on).agg(F.min(value).alias(value))
    return keys.join(least, on, "left").withColumn(value, F.coalesce(F.col(value), fallback))


def pending(work: DataFrame, done: DataFrame, on: str) -> DataFrame:
    """Work that isn't done."""
    return work.join(done.select(on), on, "left_anti")


def retention(files: DataFrame, by: str, order: list[str]) -> DataFrame:
    """files with keep: the first of each group in the given order."""
    return files.withColumn("keep", F.row_number().over(Window.partitionBy(by).orderBy(*order)) == 1)


def split_work(work: DataFrame, key: str, cpu: int, gpu: int, gpus: int = 1) -> DataFrame:
    """key, device (CPU or GPU by the ratio), part (GPU parts of nearly equal size, 0 for CPU).

    Ranks run over the list of pending tiles, which is small next to their pixels.
    """
    order = Window.orderBy(key)
    total = F.count(F.lit(1)).over(Window.partitionBy())
    ranked = work.select(key, (F.row_number().over(order) - 1).alias("_at"), total.alias("_n"))
    cut = F.floor(F.col("_n") * cpu / (cpu + gpu)) if cpu + gpu else F.col("_n")
    device = F.when(F.col("_at") < cut, "CPU").otherwise("GPU")
    ranked = ranked.withColumn("device", device)
    part = F.when(F.col("device") == "GPU", F.ntile(gpus).over(Window.partitionBy("device").orderBy(key))).otherwise(0)
    return ranked.select(key, "device", part.alias("part"))


def reconcile(before: DataFrame, after: DataFrame) -> DataFrame:
    """Values missing from after, and extra in it, each once: (value, kind)."""
    missing = before.subtract(after).withColumn("kind", F.lit("missing"))
    return missing.unionByName(after.subtract(before).withColumn("kind", F.lit("extra")))


def priority_value(*attempts: Column) -> Column:
    """The first attempt that isn't null."""
    return F.coalesce(*attempts)
