"""Golden values of scalar expressions."""

import pytest
from pyspark.sql import functions as F

from orbitframe.functions import scalar


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_sar_scaling_truncates(spark):
    given = [0.0, 0.001, 0.0031, 0.01, 0.5, 1.0, 2.0, 55.5, 1e5, 1e6]
    got = values(spark, [(x,) for x in given], "a double", scalar.sar_db(F.col("a")))
    assert [g[0] for g in got] == [0, 0, 0, 2000, 8795, 10000, 11204, 16977, 30000, 30000]


@pytest.mark.parametrize(
    ("name", "doy"),
    [("a_20220314T054500_b", 73), ("20240229T000000", 60), ("20221231T235959", 365), ("20201231T000000", 366), ("20230101T000000", 1), ("plain", 1), ("99999999T000000", 1)],
)
def test_doy_of_name(spark, name, doy):
    assert values(spark, [(name,)], "n string", scalar.doy_of_name(F.col("n"))) == [(doy,)]


def test_orbit_of_name(spark):
    names = ["a_descending.tif", "a_ASCENDING.tif", "xDESy.tif", "plain.tif"]
    got = values(spark, [(n,) for n in names], "n string", scalar.orbit_of_name(F.col("n")))
    assert [g[0] for g in got] == ["D", "A", "D", "A"]


def test_utm_epsg(spark):
    places = [(16.37, 48.21, 32633), (5.0, 60.0, 32632), (2.9, 60.0, 32631), (10.0, 78.0, 32633), (9.0, 72.0, 32633), (-70.6, -33.4, 32719), (0.0, 0.0, 32631), (179.99, -1.0, 32760), (180.0, 10.0, 32661)]
    got = values(spark, [p[:2] for p in places], "x double, y double", scalar.utm_epsg(F.col("x"), F.col("y")))
    assert [g[0] for g in got] == [p[2] for p in places]


def test_tile_code_and_zero(spark):
    got = values(spark, [("S2A_33UWP_20220101_0_L2A",), ("nounderscore",)], "i string", scalar.tile_code(F.col("i")))
    assert got == [("33UWP",), (None,)]
    assert values(spark, [("03VXG",), ("33UWP",)], "i string", scalar.strip_zero(F.col("i"))) == [("3VXG",), ("33UWP",)]


def test_standardise(spark):
    got = values(spark, [(10000.0,)], "v double", F.round(scalar.standardise(F.col("v"), 5871.0, 1710.5), 4))
    assert got == [(round((10000 - 5871) / (1710.5 + 1e-9), 4),)]


def test_doy_encoding(spark):
    got = values(spark, [(73,)], "d int", scalar.doy_encoding(F.col("d"), 8))[0][0]
    assert [round(x, 6) for x in got] == [-0.676772, -0.736193, 0.850437, 0.526078, 0.666870, 0.745174, 0.072935, 0.997337]


def test_pixel_truncates_toward_zero(spark):
    got = values(spark, [(-0.5,), (0.5,), (1.9,)], "w double", scalar.to_pixel(F.col("w"), 0.0, 1.0))
    assert [g[0] for g in got] == [0, 0, 1]


def test_durations_and_epsg(spark):
    got = values(spark, [(59,), (61,), (3661,)], "s int", scalar.duration_text(F.col("s")))
    assert [g[0] for g in got] == ["59s", "1m 1s", "1h 1m 1s"]
    got = values(spark, [('PROJCS["a",AUTHORITY["EPSG","32633"]]',), ("x",), (None,)], "w string", scalar.epsg_of_wkt(F.col("w")))
    assert [g[0] for g in got] == [32633, 4326, 4326]


def test_boundary_has_eighty_points(spark):
    got = values(spark, [(0.0, 0.0, 4.0, 2.0)], "a double, b double, c double, d double", scalar.boundary(*map(F.col, "abcd")))[0][0]
    assert len({(p.x, p.y) for p in got}) == 80
