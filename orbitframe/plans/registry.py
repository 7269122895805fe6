"""Queries over the driver tables, one per operator, with their DuckDB oracles.

The driver tables hold no rasters, so each operator runs on a table of the same shape:
events are observations of pixels (user_id), lineitem's part and supplier keys are pixel
places, orders are scenes, customers and suppliers are boxes, embeddings are vectors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    """Registers a query under its function's name, with its oracle where SQL has one."""

    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vectors(spark: SparkSession, sf_dir: str) -> int:
    """Number of vectors, which are numbered from 0."""
    return (table(spark, sf_dir, "embeddings").agg(F.max("vec_id")).first()[0] or 0) + 1


from . import grid_queries, scene_queries, series_queries  # noqa: E402, F401  they register themselves
