"""Pixel time series: mosaics, merges, validity, seeded sampling, pooling.

Folds whose result depends on order take an explicit order; none relies on input order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def mosaic(observations: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """keys, value: the last non-zero value of each group in the given order, else the last zero."""
    rank = F.struct((F.col(value) != 0).alias("seen"), *order)
    return observations.groupBy(*keys).agg(F.max_by(value, rank).alias(value))


def merge_valid_first(observations: DataFrame, keys: list[str], value: str, mask: str, order: list[str]) -> DataFrame:
    """keys, value, mask: the last valid observation of each group, else the last one."""
    rank = F.struct(mask, *order)
    return observations.groupBy(*keys).agg(F.max_by(value, rank).alias(value), F.max(mask).alias(mask))


def merge_last(observations: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """keys, value: the last observation of each group, zeros included."""
    return observations.groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias(value))


def valid_pixels(optical: DataFrame, radar: DataFrame, keys: list[str], least: int = 0, facts: tuple[Column, ...] = ()) -> DataFrame:
    """Pixels with a non-zero optical value and at least `least` valid steps of either sensor.

    optical: keys, bands, mask; radar: keys, bands. Both are aggregated before they meet; facts are
    further aggregates of the optical rows, taken along.
    """
    seen = F.exists("bands", lambda x: x != 0)
    left = optical.groupBy(*keys).agg(F.bool_or(seen).alias("_seen"), F.sum("mask").alias("optical_steps"), *facts)
    right = radar.groupBy(*keys).agg(F.count_if(seen).alias("radar_steps"))
    both = left.filter(F.col("_seen") & (F.col("optical_steps") >= least)).join(right, keys, "left").withColumn("radar_steps", F.coalesce("radar_steps", F.lit(0)))
    return both.filter(F.col("radar_steps") >= least).drop("_seen")


def pixel_series(observations: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """keys, series: the pixel's observations, sorted by their fields."""
    return observations.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("series"))


def seeded_order(seed: int, *keys: Column) -> Column:
    """A reproducible shuffle key."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(k.cast("string") for k in keys)))


def sample_steps(observations: DataFrame, keys: list[str], step: str, k: int, seed: int = 0, valid: Column | None = None) -> DataFrame:
    """k steps of each group, as rows (keys, place, step) with places 0..k-1 in order of step.

    Only valid steps are drawn from, or all steps where none is valid; without replacement
    where there are k, else every draw is made on its own. The same seed gives the same steps.
    """
    usable = F.coalesce(valid, F.lit(False)).cast("int") if valid is not None else F.lit(1)
    # one aggregation: a group's steps are the days of its series, some hundred at most
    row = F.struct(usable.alias("ok"), seeded_order(seed, *(F.col(c) for c in (*keys, step))).alias("order"), F.col(step).alias("step"))
    lists = observations.groupBy(*keys).agg(F.max(usable).alias("_best"), F.collect_list(row).alias("_all"))
    pool = F.slice(F.array_sort(F.filter("_all", lambda r: r["ok"] == F.col("_best"))), 1, k)
    lists = lists.select(*keys, F.array_sort(F.transform(pool, lambda r: r["step"])).alias("_pool"))
    size = F.size("_pool")
    digits = lambda i: F.conv(F.substring(seeded_order(seed, *map(F.col, keys), i), 1, 8), 16, 10).cast("long")
    draw = lambda i: F.element_at("_pool", (digits(i) % size + 1).cast("int"))
    replaced = F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), draw))
    chosen = lists.withColumn("_steps", F.when(size >= k, F.col("_pool")).otherwise(replaced))
    return chosen.select(*keys, F.posexplode("_steps").alias("place", step))


def attention_pool(scored: DataFrame, keys: list[str], score: str, value: str) -> DataFrame:
    """keys, pooled: values weighted by the softmax of their scores within the group."""
    top = F.max(score).over(Window.partitionBy(*keys))
    weighted = scored.withColumn("_e", F.exp(F.col(score) - top))
    return weighted.groupBy(*keys).agg((F.sum(F.col("_e") * F.col(value)) / F.sum("_e")).alias("pooled"))


def union_orbits(ascending: DataFrame, descending: DataFrame) -> DataFrame:
    """Both series, ascending steps before descending ones by their orbit column."""
    return ascending.withColumn("orbit", F.lit("A")).unionByName(descending.withColumn("orbit", F.lit("D")))


def band_statistics(observations: DataFrame, by: str, value: str) -> DataFrame:
    """by, mean, deviation (of the population)."""
    return observations.groupBy(by).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("deviation"))


def optical_stack(bands: DataFrame, keys: list[str], band: str, value: str, names: list[str], mask: Column) -> DataFrame:
    """keys, bands (one value per name, 0 where missing), mask over the named columns."""
    columns = [F.max(F.when(F.col(band) == n, F.col(value))).alias(n) for n in names]
    wide = bands.groupBy(*keys).agg(*columns)
    wide = wide.withColumn("mask", mask.cast("tinyint"))
    return wide.select(*keys, F.array(*[F.coalesce(F.col(n), F.lit(0.0)) for n in names]).alias("bands"), "mask")


def mean_vectors(vectors: DataFrame, by: str, vector: str) -> DataFrame:
    """by, place, mean: the element-wise mean of a group's vectors."""
    parts = vectors.select(by, F.posexplode(vector).alias("place", "x"))
    return parts.groupBy(by, "place").agg(F.avg(F.col("x").cast("double")).alias("mean"))


def fuse(left: Column, right: Column, method: str = "concat") -> Column:
    """Two vectors as one: concatenated, or added."""
    if method == "concat":
        return F.concat(left, right)
    if method == "sum":
        return F.zip_with(left, right, lambda x, y: x + y)
    raise ValueError(f"unknown fusion method: {method}")


def reduce_vector(vector: Column, weights: list[list[float]], bias: list[float] | None = None) -> Column:
    """A linear map of a vector, one row of weights per output."""
    rows = F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in weights])
    dot = lambda row: F.aggregate(F.zip_with(row, vector, lambda w, x: w * x.cast("double")), F.lit(0.0), lambda s, x: s + x)
    out = F.transform(rows, dot)
    if bias is not None:
        out = F.zip_with(out, F.array(*[F.lit(float(b)) for b in bias]), lambda x, b: x + b)
    return out
