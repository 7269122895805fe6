"""Shared helpers: checkpoint tables, bounded bitmap filters, skew-safe joins.

Every operator reads only the columns it needs, so extra columns of any name are
ignored; working columns carry the prefix ``_of_``.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.storage import new_path, settled, written  # noqa: F401  for the operators
from ..functions.workers import ship

#: A bitmap filter of up to 2**MAX_FILTER_BITS bits (16 MB) is broadcast. A larger one stays a
#: table, and the hashes to be checked are joined to its blocks by a shuffle of their own.
MAX_FILTER_BITS = 27
#: Bits of a filter's block: the positions of one of Spark's bitmap buckets.
BLOCK_BITS = 15
#: Groups resolved through a broadcast table; every other group then holds at most
#: 1 / HOT_GROUPS of all rows.
HOT_GROUPS = 10_000

#: Rows of an Arrow batch of texts.
BATCH_ROWS = 1000


def ship_texts(spark: SparkSession) -> None:
    """Sends the package to the executors, and bounds the Arrow batches of a session that leaves them at Spark's 10,000 rows.

    A batch of that many texts would take tens of megabytes, several times over, in each of an
    executor's tasks. The setting stays, as plans are lazy and read it when they run; a session's own choice holds.
    """
    ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) in (0, 10_000):
        spark.conf.set(key, BATCH_ROWS)


def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches; when they are through, the worker gives its free memory back to the system."""
    yield from batches
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        return


def small(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in parts, which bound what becomes Python objects at a time."""
    for batch in batches:
        for start in range(0, len(batch), rows):
            yield batch.slice(start, rows)


def clean_text(column: str = "text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def filter_bits(rows: int) -> int:
    """log2 of a filter's bits: 8 to 16 bits a row."""
    return max(10, (8 * max(rows, 1)).bit_length())


def _cells(hashed: Column, bits: int) -> tuple[Column, Column]:
    """Two cells of a 64-bit hash, numbered from 1, in one block of the filter."""
    block = hashed.bitwiseAND(F.lit((1 << max(bits - BLOCK_BITS, 0)) - 1)) * F.lit(1 << BLOCK_BITS)
    inner = F.lit((1 << min(bits, BLOCK_BITS)) - 1)
    return tuple(block + F.shiftrightunsigned(hashed, by).bitwiseAND(inner) + F.lit(1) for by in (34, 49))


def bitmap_filter(hashes: DataFrame, hashed: str, bits: int, at_least: int = 1) -> DataFrame:
    """A blocked Bloom filter as rows (block, bitmap of 4 KB): a cell is set if at_least rows hit it.

    Only 8-byte cells are counted, after partial aggregation.
    """
    cells = hashes.select(F.explode(F.array(*_cells(F.col(hashed), bits))).alias("_of_cell"))
    cells = cells.groupBy("_of_cell").agg(F.count(F.lit(1)).alias("_of_n")).filter(F.col("_of_n") >= at_least)
    return cells.groupBy(F.bitmap_bucket_number("_of_cell").alias("_of_block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_of_cell")).alias("_of_map")
    )


def with_maybe(df: DataFrame, hashed: str, bits: int, bitmaps: DataFrame, out: str = "_of_maybe") -> DataFrame:
    """Adds out: whether both cells of the hash are set, by one join on the hash's block.

    A filter of up to MAX_FILTER_BITS is broadcast, so no row moves.
    """
    first, second = _cells(F.col(hashed), bits)
    side = F.broadcast(bitmaps) if bits <= MAX_FILTER_BITS else bitmaps
    joined = df.join(side, F.bitmap_bucket_number(first) == F.col("_of_block"), "left")

    def held(cell: Column) -> Column:
        at = F.bitmap_bit_position(cell)
        byte = F.conv(F.hex(F.substring(F.col("_of_map"), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        bit = F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), (at % 8 + 1).cast("int"))
        return F.coalesce(byte.bitwiseAND(bit) > 0, F.lit(False))

    return joined.withColumn(out, held(first) & held(second)).drop("_of_block", "_of_map")


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """rows inner join groups (unique by keys) where one group may hold most rows.

    The HOT_GROUPS largest groups go through a broadcast of at most HOT_GROUPS rows;
    each of the others has at most 1 / HOT_GROUPS of the rows and is joined by a shuffle.
    """
    hot = groups.orderBy(F.col(size).desc(), *keys).limit(HOT_GROUPS)
    mark = hot.select(*keys, F.lit(True).alias("_of_hot"))
    rest = rows.join(F.broadcast(mark), keys, "left_anti").join(groups.hint("shuffle_hash"), keys)
    return rows.join(F.broadcast(hot), keys).select(rest.columns).unionByName(rest)


def packed(docs: DataFrame, *columns: str) -> DataFrame:
    """docs as one struct column _of_doc, so no extra column can clash, beside copies of columns as _of_<name>."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_of_doc"), *[F.col(c).alias(f"_of_{c}") for c in columns])


def drop_ids(spark: SparkSession, docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """docs without the rows whose doc_id is in dropped (doc_id).

    A bitmap filter lets nearly all other rows pass where they are; only rows that it may
    hold are shuffled and compared exactly. Rows of null doc_id stay; an empty table of
    either kind drops nothing.
    """
    dropped = written(spark, dropped.select(F.col("doc_id").alias("_of_gone")).filter("_of_gone is not null").distinct(), "dropped")
    bits = filter_bits(dropped.count())
    bitmaps = written(spark, bitmap_filter(dropped.select(F.xxhash64("_of_gone").alias("_of_h")), "_of_h", bits), "filter")
    marked = with_maybe(packed(docs, "doc_id").withColumn("_of_h", F.xxhash64("_of_doc_id")), "_of_h", bits, bitmaps)
    sure = marked.filter(~F.col("_of_maybe")).select("_of_doc.*")
    rest = marked.filter("_of_maybe").join(dropped, F.col("_of_doc_id") == F.col("_of_gone"), "left_anti").select("_of_doc.*")
    return sure.unionByName(rest)
