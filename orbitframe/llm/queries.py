"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, exact_dedup, licences, mixing, near_join, nearest, secrets, token_counts, token_files, toxicity


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every whole text."""
    return token_counts.token_counts(_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes and decodes every whole text; digests of both."""
    return bpe.encode(spark, _documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), digest=True)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, and the slot that takes the first."""
    rows = mixing.mix(spark, _documents(spark, sf_dir))
    return rows.select("doc_id", "size", "source_size", "target", "taken", F.array_min("first_slots").alias("first_slot"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole text."""
    return toxicity.toxicity(spark, _documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes every text's ids as files and reads them back."""
    return token_files.token_files(spark, _documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op6_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document."""
    return near_join.jaccard_join(spark, _documents(spark, sf_dir))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of each query vector."""
    return nearest.nearest(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every whole text."""
    return secrets.digest(secrets.scan(spark, _documents(spark, sf_dir)))


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every whole text."""
    return licences.licences(spark, _documents(spark, sf_dir))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that stays for every document."""
    return exact_dedup.exact_dedup(spark, _documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_bpe, op3_mixing, op4_toxicity, op5_token_files,
        op6_near_join, op7_exact_dedup, op8_nearest, op9_secrets, op10_licences,
    )
}

ORACLES: dict[str, str] = {
    "op3_mixing": mixing.SQL,
    "op7_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256, length(coalesce(text, '')) AS n
            FROM documents
        ), g AS (
            SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM d
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
    """,
}
