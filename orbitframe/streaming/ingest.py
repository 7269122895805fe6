"""Incremental resume by Structured Streaming.

New scene files are taken once each (the checkpoint remembers them); each micro-batch of
observations is appended to a store, and only the (tile, doy) groups that it touches are
merged anew and written, under the batch's number, so a repeated batch replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import series


def ingest(spark: SparkSession, source: str, schema: StructType, store: str, merged: str, checkpoint: str, keys: list[str], value: str, mask: str, order: list[str], touched: list[str]) -> StreamingQuery:
    """Starts a query over the Parquet files in source that ends when all present files are taken.

    store keeps observations, merged the valid-first merge of each key, one folder per batch.
    `touched` are the columns of keys by which groups are recomputed, such as tile and doy; the store
    is partitioned by them, so a batch reads the folders of the values it holds, not the whole store.
    """
    kept = StructType([f for f in schema if f.name not in touched] + [f for f in schema if f.name in touched]).add("batch", "long")

    def batch(new: DataFrame, number: int) -> None:
        rows = new.withColumn("batch", F.lit(number).cast("long"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*touched, "batch").parquet(store)
        groups = new.select(*touched).distinct()
        # one row per group of this batch
        held = groups.agg(*[F.collect_set(c).alias(c) for c in touched]).first()
        every = spark.read.schema(kept).parquet(store).filter(F.col("batch") <= number)
        for c in touched:
            every = every.filter(F.col(c).isin(held[c]))
        again = every.join(F.broadcast(groups), touched, "left_semi")
        series.merge_valid_first(again, keys, value, mask, order).write.mode("overwrite").parquet(f"{merged}/batch={number}")

    rows = spark.readStream.schema(schema).parquet(source)
    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, merged: str, touched: list[str]) -> DataFrame:
    """The latest merge of each group."""
    rows = spark.read.parquet(merged)
    newest = F.max("batch").over(Window.partitionBy(*touched))
    return rows.withColumn("_newest", newest).filter(F.col("batch") == F.col("_newest")).drop("_newest", "batch")
