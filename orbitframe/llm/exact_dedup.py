"""Exact deduplication by two passes of Bloom filtering; DataFrame functions only.

Pass 1 hashes every normalised text and counts the cells of a blocked Bloom filter: a
cell hit twice marks its hashes as possibly repeated. The filter has 8 to 16 bits a row
at any size. Pass 2 checks each row against it: rows it clears are unique for certain
and pass straight through; only the others are shuffled, on the SHA-256 of the whole
text. A filter of up to 2**MAX_FILTER_BITS bits is broadcast; a larger one is a table
of blocks to which the hashes are joined, so then each row's fingerprint moves once,
but never its text.

Texts are equal when identical after deleting every character of [\\x20\\x09-\\x0D];
null counts as empty. Of equal texts the row with the most code points stays, then the
smallest doc_id (null last); of fully identical rows exactly one stays. A group may
hold most rows: its winner comes from partial aggregates and is joined back through
a broadcast of the largest groups. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import bitmap_filter, clean_text, filter_bits, join_groups, packed, with_maybe, written


def normalised(column: Column) -> Column:
    """The text without blanks and line ends."""
    return F.translate(column, " \t\n\x0b\x0c\r", "")


def exact_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of docs."""
    text = clean_text()
    prints = docs.select("doc_id", F.sha2(normalised(text).cast("binary"), 256).alias("text_sha256"), F.char_length(text).alias("_of_len"))
    # the row number is fixed by the write, so later reads of the table agree on it
    prints = prints.withColumns({"_of_row": F.monotonically_increasing_id(), "_of_h": F.xxhash64("text_sha256")})
    prints = written(spark, prints, "prints")
    bits = filter_bits(prints.count())
    repeated = written(spark, bitmap_filter(prints.select("_of_h"), "_of_h", bits, at_least=2), "filter")
    marked = with_maybe(prints, "_of_h", bits, repeated)

    sure = marked.filter(~F.col("_of_maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    maybe = written(spark, marked.filter("_of_maybe").select("doc_id", "text_sha256", "_of_len", "_of_row"), "maybe")
    # most code points first, then the smallest doc_id with nulls last, then the first row
    best = F.min(F.struct((-F.col("_of_len")).alias("less"), F.col("doc_id").isNull().alias("null"), F.col("doc_id").alias("id"), F.col("_of_row").alias("row")))
    groups = written(spark, maybe.groupBy("text_sha256").agg(best.alias("_of_best"), F.count(F.lit(1)).alias("group_size")), "groups")
    rest = join_groups(maybe, groups, ["text_sha256"], "group_size").select(
        "doc_id", F.col("_of_best.id").alias("keep_id"), "group_size", (F.col("_of_row") == F.col("_of_best.row")).alias("kept"), "text_sha256"
    )
    return sure.unionByName(rest)


def without_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of docs that exact_dedup keeps, with all their columns.

    Rows outside every repeated group stay where they are. Rows that share doc_id and
    text count as one row even if their other columns differ. Null and empty texts are
    equal texts; a null doc_id is a doc_id of its own; an empty table stays empty.
    """
    decided = exact_dedup(spark, docs).filter("group_size > 1")
    decided = decided.groupBy(F.col("doc_id").alias("_of_id"), F.col("text_sha256").alias("_of_sha")).agg(F.max("kept").alias("_of_kept"), F.count(F.lit(1)).alias("_of_n"))
    decided = written(spark, decided, "decided")
    bits = filter_bits(decided.count())
    bitmaps = written(spark, bitmap_filter(decided.select(F.xxhash64("_of_id").alias("_of_h")), "_of_h", bits), "filter")
    marked = with_maybe(packed(docs, "doc_id", "text").withColumn("_of_h", F.xxhash64("_of_doc_id")), "_of_h", bits, bitmaps)
    sure = marked.filter(~F.col("_of_maybe")).select("_of_doc.*")
    rest = marked.filter("_of_maybe").withColumn("_of_doc_sha", F.sha2(normalised(clean_text("_of_text")).cast("binary"), 256))
    same = F.col("_of_doc_id").eqNullSafe(F.col("_of_id")) & (F.col("_of_doc_sha") == F.col("_of_sha"))
    rest = rest.join(decided, same, "left").filter(F.coalesce(F.col("_of_kept"), F.lit(True)))
    once = rest.filter(F.coalesce(F.col("_of_n"), F.lit(1)) == 1).select("_of_doc.*")
    several = rest.filter(F.col("_of_n") > 1).groupBy("_of_id", "_of_sha").agg(F.first("_of_doc").alias("_of_doc")).select("_of_doc.*")
    return sure.unionByName(once).unionByName(several)
