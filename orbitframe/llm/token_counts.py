"""Token counts of a piece model without running the merges on most of the text.

A piece model's merges never join a character to a following space mark when no
piece holds a space mark after another character. Texts then fall into pre-tokens,
runs of space marks with the characters up to the next one, that are merged apart.
The whole-token shortcut: every vocabulary string that the library itself encodes
alone as one token (proved once, offline, by running it) is counted by a dictionary
lookup; only the other pre-tokens are merged, each distinct one once per cache.

The operator is narrow: no shuffle, memory bounded by an Arrow batch and the cache.
Null texts count as empty (0 bytes, 0 tokens); rows of a repeated or null doc_id are
each counted; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import clean_text, ship_texts, small

#: Entries of a worker's cache of merged pre-tokens; when full it starts anew.
CACHE_ENTRIES = 400_000
MARK = "▁"
_PRE_TOKENS = re.compile(" +[^ ]*")
_counters: dict[bytes, "PieceCounter"] = {}


def whole_tokens(processor) -> dict[str, int]:
    """Pre-tokens, without their first space mark, that encode alone as exactly one token."""
    pieces = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
    if any(MARK in p.lstrip(MARK) for p in pieces):
        raise ValueError("pieces with an inner space mark: pre-tokens can't be merged apart")
    words = [p[1:].replace(MARK, " ") for p in pieces if p.startswith(MARK) and len(p) > 1]
    return {"": 1} | {w: 1 for w, ids in zip(words, processor.encode(words, num_threads=1)) if len(ids) == 1}


class PieceCounter:
    """Counts the tokens of texts as the piece model's library does."""

    def __init__(self, model: bytes, whole: dict[str, int] | None = None, cache_entries: int = CACHE_ENTRIES):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.whole = whole_tokens(self.processor) if whole is None else whole
        self.known = dict(self.whole)
        self.room = cache_entries

    @staticmethod
    def pre_tokens(text: str) -> list[str]:
        """Pre-tokens without their first mark; the library puts one before the text."""
        if not text:
            return []
        words = text.replace(MARK, " ").split(" ")
        if "" in words:
            words = [w[1:] for w in _PRE_TOKENS.findall(" " + text.replace(MARK, " "))]
        return words

    def count(self, texts: list[str]) -> list[int]:
        counts, known = [], self.known
        for text in texts:
            words = self.pre_tokens(text)
            fresh = [w for w in set(words) if w not in known]
            if fresh:
                if len(known) + len(fresh) > self.room + len(self.whole):
                    known = self.known = dict(self.whole)
                    fresh = [w for w in set(words) if w not in known]
                known.update(zip(fresh, map(len, self.processor.encode(fresh, num_threads=1))))
            counts.append(sum(map(known.__getitem__, words)))
        return counts


def counter(model: bytes, whole: dict[str, int]) -> PieceCounter:
    """One counter for each worker process and model."""
    if model not in _counters:
        _counters[model] = PieceCounter(model, whole)
    return _counters[model]


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) of every whole text."""
    ship_texts(docs.sparkSession)
    with open(model_path, "rb") as file:  # a vocabulary file, small and fixed
        model = file.read()
    # the proof is made here, once; workers get its table, as large as the vocabulary
    shared = docs.sparkSession.sparkContext.broadcast((model, PieceCounter(model).whole))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = counter(*shared.value)
        for batch in small(batches):
            texts = batch.column("_of_text")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pc.binary_length(texts).cast(pa.int64()), pa.array(tool.count(texts.to_pylist()), pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    narrow = docs.select("doc_id", clean_text().alias("_of_text"))
    counted = narrow.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
