"""Scene items, GeoJSON and lists as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

ITEM = (
    "id string, geometry struct<type:string,coordinates:array<array<array<double>>>>, "
    "properties struct<datetime:timestamp,`eo:cloud_cover`:double,`s2:processing_baseline`:string>, "
    "assets map<string,struct<href:string>>"
)
#: Coordinates are read as text, as their depth differs by type.
FEATURES = "crs struct<properties:struct<name:string>>, features array<struct<geometry:struct<type:string,coordinates:string,geometries:array<struct<type:string,coordinates:string>>>>>"
#: Assets of an optical scene, bands first, then the classification.
ASSETS = ("red", "blue", "green", "nir", "nir08", "rededge1", "rededge2", "rededge3", "swir16", "swir22", "scl")


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """id, datetime, cloud_cover, baseline, assets, points of scene items (one JSON document a file)."""
    items = spark.read.schema(ITEM).option("multiLine", "true").json(path)
    return items.select(
        "id",
        F.col("properties.datetime").alias("datetime"),
        F.col("properties.`eo:cloud_cover`").alias("cloud_cover"),
        F.col("properties.`s2:processing_baseline`").alias("baseline"),
        F.transform_values("assets", lambda _, v: v["href"]).alias("assets"),
        _ring(F.col("geometry.coordinates")).alias("points"),
    )


def wanted_assets(items: DataFrame) -> DataFrame:
    """id, asset, href of the eleven assets of each item; href is null where one is missing."""
    wanted = items.select("id", "assets", F.explode(F.array(*map(F.lit, ASSETS))).alias("asset"))
    return wanted.select("id", "asset", F.try_element_at("assets", F.col("asset")).alias("href"))


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """geometry, polygon, ring, points, crs: every ring of the polygons of GeoJSON files; EPSG:4326 where no crs is named.

    Ring 0 is a polygon's outline, the others its holes. Multi-polygons and collections give one
    number for each of their polygons. Features without any polygon (points, lines, null) fail the read.
    """
    files = spark.read.schema(FEATURES).option("multiLine", "true").json(path)
    rows = files.select(F.coalesce("crs.properties.name", F.lit("EPSG:4326")).alias("crs"), F.posexplode("features").alias("geometry", "f"))
    rows = rows.withColumn("g", F.explode_outer(F.when(F.col("f.geometry.type") == "GeometryCollection", F.col("f.geometry.geometries")).otherwise(F.array(F.struct("f.geometry.type", "f.geometry.coordinates")))))
    one = F.from_json("g.coordinates", "array<array<array<double>>>")
    many = F.from_json("g.coordinates", "array<array<array<array<double>>>>")
    unfit = F.raise_error(F.concat(F.lit("not a polygon: "), F.coalesce("g.type", F.lit("null")))).cast("array<array<array<array<double>>>>")
    polygons = F.when(F.col("g.type") == "Polygon", F.array(one)).when(F.col("g.type") == "MultiPolygon", many).otherwise(unfit)
    rows = rows.select("geometry", "crs", F.explode(polygons).alias("p"))
    rows = rows.groupBy("geometry", "crs").agg(F.collect_list("p").alias("ps")).select("geometry", "crs", F.posexplode("ps").alias("polygon", "p"))
    return rows.select("geometry", "polygon", F.posexplode("p").alias("ring", "c"), "crs").select("geometry", "polygon", "ring", _points(F.col("c")).alias("points"), "crs")


def _points(ring):
    """A ring without its closing point, as array of struct (x, y)."""
    points = F.transform(ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    return F.slice(points, 1, F.greatest(F.size(points) - 1, F.lit(0)))


def _ring(coordinates):
    """The outer ring."""
    return _points(coordinates[0])


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """tile of a list: text lines, or a JSON array of strings in one file."""
    text = spark.read.text(path, wholetext=True)
    array = F.from_json(F.col("value"), "array<string>")
    lines = F.filter(F.split("value", "\r?\n"), lambda x: F.trim(x) != "")
    values = F.when(F.startswith(F.ltrim("value"), F.lit("[")), array).otherwise(F.transform(lines, F.trim))
    return text.select(F.explode(values).alias("tile"))


def write_list(tiles: DataFrame, path: str, form: str = "text") -> None:
    """Distinct tiles, sorted: as text lines, or as one JSON array of strings."""
    tiles = tiles.select("tile").distinct()
    if form == "text":
        tiles.orderBy("tile").write.text(path)
    else:
        tiles.agg(F.to_json(F.array_sort(F.collect_list("tile"))).alias("value")).write.text(path)
