"""Scalar column expressions: radar scaling, dates, names, affine maps, zones, encodings."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def sar_db(amplitude: Column) -> Column:
    """Radar amplitude as decibels times 200 from -50 dB, within 0..30000, truncated to a smallint."""
    decibel = F.log10(F.greatest(amplitude, F.lit(1e-6))) * 20.0
    return F.least(F.greatest((decibel + 50.0) * 200.0, F.lit(0.0)), F.lit(30000.0)).cast("smallint")


def acquisition_date(name: Column) -> Column:
    """Date of the first 8 digits before T and 6 digits; null where there is none."""
    digits = F.regexp_extract(name, r"(\d{8})T\d{6}", 1)
    return F.try_to_date(F.nullif(digits, F.lit("")), "yyyyMMdd")


def doy_of_name(name: Column) -> Column:
    """Day of the year of the acquisition; 1 where the name holds none."""
    return F.coalesce(F.dayofyear(acquisition_date(name)), F.lit(1))


def orbit_of_name(name: Column) -> Column:
    """D for descending, A for ascending; names without either are A."""
    upper = F.upper(name)
    return (
        F.when(F.contains(upper, F.lit("_DESCENDING")), "D")
        .when(F.contains(upper, F.lit("_ASCENDING")), "A")
        .when(F.contains(upper, F.lit("DES")), "D")
        .otherwise("A")
    )


def tile_code(item: Column) -> Column:
    """Second token of an item id; null where there is none."""
    parts = F.split(item, "_", -1)
    return F.when(F.size(parts) >= 2, parts[1])


def strip_zero(tile: Column) -> Column:
    """Tile id without one leading zero."""
    return F.regexp_replace(tile, "^0", "")


def pass_name(direction: Column) -> Column:
    """Orbit pass of a scene's metadata, ascending by default."""
    return F.coalesce(F.upper(direction), F.lit("ASCENDING"))


def epsg_of_wkt(wkt: Column) -> Column:
    """EPSG code of the last authority in a WKT; 4326 where there is none."""
    code = F.regexp_extract(wkt, r'AUTHORITY\["EPSG","(\d+)"\]\]$', 1)
    return F.coalesce(F.nullif(code, F.lit("")).try_cast("int"), F.lit(4326))


def utm_zone(lon: Column) -> Column:
    """Zone of a longitude, without exceptions."""
    return ((lon + 180.0) / 6.0).cast("int") + 1


def utm_epsg(lon: Column, lat: Column) -> Column:
    """EPSG code of the UTM zone, with the exceptions of Norway and Svalbard."""
    svalbard = (lat >= 72) & (lat < 84)
    zone = (
        F.when((lat >= 56) & (lat < 64) & (lon >= 3) & (lon < 12), 32)
        .when(svalbard & (lon >= 0) & (lon < 9), 31)
        .when(svalbard & (lon >= 9) & (lon < 21), 33)
        .when(svalbard & (lon >= 21) & (lon < 33), 35)
        .when(svalbard & (lon >= 33) & (lon < 42), 37)
        .otherwise(utm_zone(lon))
    )
    return F.when(lat >= 0, zone + 32600).otherwise(zone + 32700)


def to_world(index: Column, origin: float | Column, step: float | Column) -> Column:
    """World coordinate of a pixel's edge."""
    return index * step + origin


def to_pixel(world: Column, origin: float | Column, step: float | Column) -> Column:
    """Pixel of a world coordinate, truncated toward zero."""
    return ((world - origin) / step).cast("int")


def window_low(first: Column, size: Column) -> Column:
    """Low edge of a window held inside 0..size-1."""
    return F.greatest(F.lit(0), F.least(first, size - 1))


def window_high(low: Column, last: Column, size: Column) -> Column:
    """High edge of a window: at least one pixel, at most the raster."""
    return F.greatest(low + 1, F.least(last, size))


def bounds_window(first: Column, last: Column, origin: float | Column, step: float | Column, size: Column) -> Column:
    """Struct (start, end) of the pixels between two bounds along an axis of size pixels.

    Offsets are rounded half to even and held inside the raster; null where the window lies outside.
    first comes before last in the direction of step (for rows: top, bottom, a negative step).
    """
    offset = (first - origin) / step
    start = F.greatest(F.lit(0), F.bround(offset).cast("int"))
    end = F.least(size, F.bround(offset + (last - first) / step).cast("int"))
    return F.when((start < size) & (end > 0), F.struct(start.alias("start"), end.alias("end")))


def patch_affine(x0: Column, y0: Column, patch: int, width: int, height: int, bounds: tuple[float, float, float, float]) -> Column:
    """Struct (dx, left, dy, top) of the affine of a patch in a raster of geographic bounds (left, bottom, right, top).

    The patch's bounds are its share of the raster's; dx and dy (negative) follow from its clipped size.
    """
    left, bottom, right, top = map(float, bounds)
    wide, tall = F.least(F.lit(patch), width - x0), F.least(F.lit(patch), height - y0)
    at = lambda k, n: F.least(k / n, F.lit(1.0))
    west, east = left + at(x0, width) * (right - left), left + at(x0 + wide, width) * (right - left)
    north, south = top - at(y0, height) * (top - bottom), top - at(y0 + tall, height) * (top - bottom)
    return F.struct(((east - west) / wide).alias("dx"), west.alias("left"), (-(north - south) / tall).alias("dy"), north.alias("top"))


def patch_key(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """xmin_ymin_xmax_ymax."""
    return F.concat_ws("_", *(c.cast("string") for c in (x0, y0, x1, y1)))


def duration_text(seconds: Column) -> Column:
    """Whole seconds as hours, minutes and seconds."""
    hours, minutes, rest = F.floor(seconds / 3600), F.floor(seconds % 3600 / 60), seconds % 60
    return (
        F.when(hours > 0, F.format_string("%dh %dm %ds", hours, minutes, rest))
        .when(minutes > 0, F.format_string("%dm %ds", minutes, rest))
        .otherwise(F.format_string("%ds", rest))
    )


def standardise(value: Column, mean: float | Column, deviation: float | Column) -> Column:
    """(value - mean) / (deviation + 1e-9), in double precision."""
    return (value.cast("double") - mean) / (deviation + F.lit(1e-9))


def standardise_bands(bands: Column, means: list[float], deviations: list[float], doy: Column) -> Column:
    """Bands standardised one by one, with the day of the year, as it is, behind them."""
    facts = F.array(*[F.struct(F.lit(float(m)).alias("m"), F.lit(float(s)).alias("s")) for m, s in zip(means, deviations)])
    scaled = F.zip_with(bands, facts, lambda x, f: (x.cast("double") - f["m"]) / (f["s"] + F.lit(1e-9)))
    return F.concat(scaled, F.array(doy.cast("double")))


def doy_encoding(doy: Column, width: int) -> Column:
    """Sines and cosines of the day of the year by falling frequencies, in turn."""
    rate = lambda k: F.exp(k.cast("double") * F.lit(-2.0 * math.log(10000.0) / width))
    pair = lambda k: F.array(F.sin(doy * rate(k)), F.cos(doy * rate(k)))
    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(width // 2 - 1)), pair))


def polygon_box(points: Column) -> Column:
    """Envelope struct (x0, y0, x1, y1) of an array of structs (x, y)."""
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))


def boundary(x0: Column, y0: Column, x1: Column, y1: Column, steps: int = 20) -> Column:
    """Boundary of a box: every edge cut into `steps`, corners once, as array of structs (x, y)."""
    at = F.sequence(F.lit(0), F.lit(steps - 1))
    part = lambda a, b, k: a + (b - a) * (k.cast("double") / steps)
    point = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.concat(
        F.transform(at, lambda k: point(part(x0, x1, k), y0 + F.lit(0.0))),
        F.transform(at, lambda k: point(x1 + F.lit(0.0), part(y0, y1, k))),
        F.transform(at, lambda k: point(part(x1, x0, k), y1 + F.lit(0.0))),
        F.transform(at, lambda k: point(x0 + F.lit(0.0), part(y1, y0, k))),
    )


def swapped(points: Column) -> Column:
    """Points with their axes exchanged."""
    return F.transform(points, lambda p: F.struct(p["y"].alias("x"), p["x"].alias("y")))
