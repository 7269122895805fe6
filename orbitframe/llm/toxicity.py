"""Toxicity by a factorization machine over hashed terms: words and beginnings of words.

The score of a text is a logistic of a bias, a weight for each hashed term it holds and,
for each pair of its terms, the product of their factor vectors: pairs such as an insult
with the mention of a group count beyond the sum of their weights.

The machine is fitted on at most TRAIN_ROWS labelled rows (those of smallest hash of
doc_id, so a rerun takes the same), as rows of term buckets, by AdaGrad with a shrinkage of
weights that few rows support. Terms are counted and chosen in Spark, and the fit runs in one
executor task, whose memory the bound of rows and terms limits. Scoring is one narrow pass
over all whole texts.

Null texts count as empty; an empty text scores the bias. Labels that are null are left
out; of several labels for one doc_id the largest counts, of several texts one. Without
any label every score is 0. Rows of a repeated or null doc_id are each scored; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import clean_text, ship_texts, small, trimmed, written

#: Bound of the rows the machine is fitted on.
TRAIN_ROWS = 16_000
BUCKETS = 1 << 18
#: Characters of a word's beginnings that are terms beside the word, as insults are inflected.
STEMS = (4, 5)
#: A term bucket takes part if MIN_ROWS training rows hold it and either its share of label 1
#: differs (a chi-squared of MIN_CHI) or COMMON of all rows hold it: the partners of pairs.
MIN_ROWS, MIN_CHI, COMMON = 5, 8.0, 0.01
FACTORS, EPOCHS, BATCH, RATE, SHRINK = 4, 12, 256, 0.2, 2e-4
#: Entries of a worker's cache of terms; a full cache starts anew.
CACHE_ENTRIES = 400_000
_TERM = re.compile(r"\w+").findall


def bucket(term: str) -> int:
    return zlib.crc32(term.encode("utf-8", "surrogatepass")) & (BUCKETS - 1)


def words(text: str) -> set[str]:
    """Distinct lower-case words of a whole text."""
    return set(_TERM(text.lower()))


def buckets(word: str) -> list[int]:
    """Buckets of a word and of its beginnings."""
    return [bucket(word), *(bucket(f"{word[:n]}*") for n in STEMS if len(word) > n)]


@dataclass
class Machine:
    """bias, and for each term bucket in `index` (else -1) a row of weights and factors."""

    bias: float
    index: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        """Probabilities for rows of places in the weights."""
        if not len(self.weights):
            return np.full(len(rows), sigmoid(self.bias) if np.isfinite(self.bias) else 0.0)
        flat = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
        ends = np.cumsum([0, *map(len, rows)])
        linear, pairs = self._sums(flat, ends)
        return sigmoid(self.bias + linear + pairs)

    def _sums(self, flat: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        part = self.factors[flat]
        linear = segment_sums(self.weights[flat], ends)
        total, squares = segment_sums(part, ends), segment_sums(part * part, ends)
        return linear, 0.5 * (total * total - squares).sum(axis=1)


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def segment_sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of values between consecutive ends; 0 for empty stretches."""
    sums = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return sums[ends[1:]] - sums[ends[:-1]]


def chosen(support: np.ndarray, ones: np.ndarray, n: int, positive: int) -> np.ndarray:
    """Whether a term takes part, from its rows (all, of label 1) and the rows in all."""
    share = (positive + 0.5) / (n + 1)
    apart = (ones - support * share) ** 2 / np.maximum(support * share * (1 - share), 1e-9)
    return (support >= MIN_ROWS) & ((apart >= MIN_CHI) | (support >= COMMON * n))


def fit(rows: list[np.ndarray], labels: np.ndarray, seed: int = 5) -> Machine:
    """Fits the machine to rows of distinct term buckets and 0/1 labels."""
    support, ones = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for row, label in zip(rows, labels):  # a row's buckets are distinct
        support[row] += 1
        ones[row] += int(label > 0)
    index = np.full(BUCKETS, -1, np.int32)
    used = np.flatnonzero(chosen(support, ones, len(rows), int(np.sum(labels))))
    index[used] = np.arange(len(used))
    return fit_places([index[r][index[r] >= 0] for r in rows], np.asarray(labels, float), index, len(used), seed)


def fit_places(rows: list[np.ndarray], labels: np.ndarray, index: np.ndarray, used: int, seed: int = 5) -> Machine:
    """Fits the machine to rows of distinct places of the chosen terms; one batch's sums are held at a time."""
    if not len(rows):
        return Machine(-np.inf, np.full(BUCKETS, -1, np.int32), np.zeros(0), np.zeros((0, FACTORS)))
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    rng = np.random.default_rng(seed)
    model = Machine(float(np.log(share / (1 - share))), index, np.zeros(used), rng.normal(0, 0.01, (used, FACTORS)))
    if not used or labels.min() == labels.max():
        return model
    order = rng.permutation(len(rows))
    grown_b, grown_w, grown_v = 1e-6, np.full(used, 1e-6), np.full((used, FACTORS), 1e-6)
    for _ in range(EPOCHS):
        for k in range(0, len(order), BATCH):
            batch = order[k : k + BATCH]
            flat, y = np.concatenate([rows[i] for i in batch]), labels[batch]
            if not len(flat):
                continue
            sizes = [len(rows[i]) for i in batch]
            ends, owner = np.cumsum([0, *sizes]), np.repeat(np.arange(len(batch)), sizes)
            sort = np.argsort(flat, kind="stable")
            unique, starts = np.unique(flat[sort], return_index=True)
            part = model.factors[flat]
            total = segment_sums(part, ends)
            pairs = 0.5 * (total * total - segment_sums(part * part, ends)).sum(axis=1)
            error = (sigmoid(model.bias + segment_sums(model.weights[flat], ends) + pairs) - y) / len(y)
            each = error[owner]
            slope_w = np.add.reduceat(each[sort], starts) + SHRINK / 10 * model.weights[unique]
            slope_v = np.add.reduceat((each[:, None] * (total[owner] - part))[sort], starts, axis=0) + SHRINK * model.factors[unique]
            grown_w[unique] += slope_w * slope_w
            grown_v[unique] += slope_v * slope_v
            step = RATE / np.sqrt(grown_w[unique])
            moved = model.weights[unique] - step * slope_w
            model.weights[unique] = np.sign(moved) * np.maximum(np.abs(moved) - step * SHRINK, 0)
            model.factors[unique] -= RATE / 4 / np.sqrt(grown_v[unique]) * slope_v
            grown_b += error.sum() ** 2
            model.bias -= RATE / np.sqrt(grown_b) * error.sum()
    return model


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Machine:
    """Fits on at most `rows` labelled documents outside the held-out fold.

    Spark counts the terms and chooses those that take part; the machine is fitted in one
    executor task over the rows' chosen terms, and only it comes to the driver.
    """
    ship_texts(spark)
    known = labels.select("doc_id", "toxic").filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("double").alias("_of_y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 64):
            found = [sorted({b for w in words(x) for b in buckets(w)}) for x in batch.column("_of_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("_of_y"), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "_of_y", "found"])

    texts = docs.select("doc_id", clean_text().alias("_of_text")).join(F.broadcast(known), "doc_id")
    found = texts.mapInArrow(terms, "doc_id long, _of_y double, found array<int>")
    found = found.groupBy("doc_id").agg(F.min(F.struct("found", "_of_y")).alias("row")).select("doc_id", "row.*")
    found = written(spark, found, "terms")
    facts = found.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_of_y"), F.lit(0.0)).alias("ones")).first()
    # One row for each bucket of terms, BUCKETS at most.
    counts = found.select(F.explode("found").alias("term"), "_of_y").groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.sum("_of_y").alias("ones")).filter(F.col("n") >= MIN_ROWS).toArrow()
    term, support, ones = (counts.column(k).to_numpy() for k in range(3))
    used = np.sort(term[chosen(support, ones, facts["n"], int(facts["ones"]))])
    index = np.full(BUCKETS, -1, np.int32)
    index[used] = np.arange(len(used))
    shared = spark.sparkContext.broadcast(index)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [(at[at >= 0]).tobytes() for at in (shared.value[np.asarray(x.values, np.int32)] for x in batch.column("found"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("_of_y"), pa.array(kept, pa.binary())], ["doc_id", "_of_y", "at"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = sorted((i, y, at) for batch in batches for i, y, at in zip(*(c.to_pylist() for c in batch.columns)))
        model = fit_places([np.frombuffer(at, np.int32) for _, _, at in kept], np.array([y for _, y, _ in kept]), shared.value, len(used))
        model.index = np.zeros(0, np.int32)  # the driver has it
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    model = pickle.loads(found.mapInArrow(places, "doc_id long, _of_y double, at binary").repartition(1).mapInArrow(lambda batches: trimmed(learn(batches)), "model binary").first()["model"])
    model.index = index if facts["n"] else np.full(BUCKETS, -1, np.int32)
    return model


class Scorer:
    """Scores texts with a machine; looks up the place of each term once per cache."""

    def __init__(self, machine: Machine):
        self.machine, self.places = machine, {}

    def scores(self, texts: list[str]) -> np.ndarray:
        rows, places = [], self.places
        for text in texts:
            held = words(text)
            if len(places) > CACHE_ENTRIES:
                places.clear()
            for word in held:
                if word not in places:
                    at = self.machine.index[buckets(word)]
                    places[word] = tuple(at[at >= 0].tolist())
            row = set().union(*map(places.__getitem__, held))
            rows.append(np.fromiter(sorted(row), np.int64, len(row)))
        return self.machine.scores(rows)


def score(spark: SparkSession, docs: DataFrame, model: Machine) -> DataFrame:
    """doc_id, held_out, score, predicted of every whole text."""
    ship_texts(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Scorer(shared.value)
        for batch in small(batches):
            found = tool.scores(batch.column("_of_text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

    scored = docs.select("doc_id", clean_text().alias("_of_text")).mapInArrow(lambda batches: trimmed(run(batches)), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fits on the labelled rows of docs and scores all of docs."""
    return score(spark, docs, train(spark, docs, labels))


def clean_rows(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that score below 0.5, with all their columns; no row moves.

    Null and empty texts score the bias; rows of a null or repeated doc_id are judged one by
    one; without labels every row stays; an empty table stays empty.
    """
    shared = spark.sparkContext.broadcast(train(spark, docs, labels))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Scorer(shared.value)
        for batch in small(batches):
            found = tool.scores([t or "" for t in batch.column(at).to_pylist()])
            yield batch.filter(pa.array(found < 0.5))

    return docs.mapInArrow(lambda batches: trimmed(run(batches)), docs.schema)
