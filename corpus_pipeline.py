"""Corpus pipeline: toxicity, exact dedup, near dedup, source mixing, byte-pair encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read
again as the next one's docs. All but the last return the columns of documents, whatever
further ones there are, under any names.

In every stage a null text counts as empty, a text of any length is taken whole, and an empty
table gives an empty one. Rows of a null doc_id go through all stages but take part in no group of near
copies; rows that repeat doc_id and text are one document after the second stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from orbitframe.llm import bpe, common, exact_dedup, mixing, near_join, toxicity


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine doesn't call toxic; empty texts score the bias and stay, and without labels all stay."""
    return toxicity.clean_rows(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest, of ties the smallest doc_id; all empty texts are one group."""
    return exact_dedup.without_copies(spark, docs)


def apart(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the smallest doc_id; texts without words are classes of their own."""
    return near_join.one_of_each(spark, docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them, in its order; those without words have nothing to take and go."""
    return mixing.mixed_rows(spark, docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every row of the mix, with digests of its ids and of their decoded text; empty texts have none."""
    return bpe.encode(spark, docs, public_tokenizers.path("word_bpe_49k.json"), digest=True)


STAGES = [("toxicity", clean), ("exact_dedup", distinct), ("near_join", apart), ("mixing", mixed), ("bpe", encoded)]

#: Hash functions, a trained model and tokenizers: not to be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every stage's result is a table in the shared folder, where its own intermediate tables are removed."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.settled(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
