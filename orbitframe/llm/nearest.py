"""Approximate nearest neighbours by a hierarchical k-means tree, searched best bin first.

Index: a tree of k-means splits is fitted on at most SAMPLE_ROWS distinct unit vectors;
every vector of the table then descends to its leaf. A leaf that holds more than SPLIT_ROWS gets
a tree of its own, fitted by an executor on at most SUB_ROWS of its vectors, and so on until
the leaves are small or there are MAX_LEAVES, so leaves keep their size as the table
grows. Copies of one vector are one entry with its smallest ids (no more can be among the nearest),
so a vector that holds a large share of all rows is stored once. Neighbouring leaves form cells of
at most CELL_ROWS entries, the unit of the join; a larger leaf is cut into blocks.

Search: a query walks the tree with a priority queue of branches by distance of their
centres, opening leaves best first. How many leaves it opens is calibrated: the true neighbours
of PROBES queries are found by brute force over the whole table, and the number is widened
until the recall's lower confidence bound reaches the target; a query also goes on until its
leaves hold enough entries. Queries meet the cells of their leaves in a join, in tiles of bounded
size, and are compared with the entries of the leaves they opened; each tile gives the k best of
each query, exactly scored in double precision.

Vectors that are null, of zero length, of another length than most, or that hold null or
non-finite components take no part, neither as queries nor as candidates. Fully repeated
rows count once; a query leaves out the candidates of its own id, and different vectors of one id
that is a query share one ranking. Null ids take no part. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.workers import ship
from .common import written

#: Bounds of the vectors that the tree, and the tree of a large leaf, are fitted on.
SAMPLE_ROWS, SUB_ROWS = 20_000, 8192
BRANCHES, LEAF_ROWS, ROUNDS = 16, 64, 8
#: A leaf of more entries is split again, while there are fewer leaves than MAX_LEAVES.
SPLIT_ROWS, MAX_LEAVES = 8192, 100_000
#: Calibration: queries, and the recall that its lower confidence bound has to reach.
PROBES, RECALL = 256, 0.97
#: Entries of a cell or block, and queries of a tile, at most about.
CELL_ROWS, TILE = 4096, 1024


@dataclass
class Tree:
    """Node i has the children children[i], (first, last) rows of centres, or is leaf number leaf[i]."""

    centres: np.ndarray
    children: list[tuple[int, int]]
    leaf: list[int]
    leaves: int
    visits: int = 1

    def descend(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf of each unit vector."""
        out = np.zeros(len(vectors), np.int64)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            first, last = self.children[node]
            near = np.argmax(vectors[rows] @ self.centres[first:last].T - self._half(first, last), axis=1)
            todo += [(first + k, rows[near == k]) for k in range(last - first) if (near == k).any()]
        return out

    def _half(self, first: int, last: int) -> np.ndarray:
        part = self.centres[first:last]
        return 0.5 * (part * part).sum(axis=1)

    def best_bins(self, vector: np.ndarray) -> Iterator[int]:
        """Leaves, best bin first: always the branch whose centre is nearest of all seen."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                yield self.leaf[node]
                continue
            first, last = self.children[node]
            away = ((self.centres[first:last] - vector) ** 2).sum(axis=1)
            for k, d in enumerate(away.tolist()):
                heapq.heappush(queue, (d, first + k))


def k_means(vectors: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Centres of at most k clusters that aren't empty."""
    centres = vectors[rng.choice(len(vectors), min(k, len(vectors)), replace=False)]
    for _ in range(ROUNDS):
        near = np.argmax(vectors @ centres.T - 0.5 * (centres * centres).sum(axis=1), axis=1)
        used = np.unique(near)
        centres = np.stack([vectors[near == c].mean(axis=0) for c in used])
    return centres


def grow(vectors: np.ndarray, seed: int = 3) -> Tree:
    """The tree of a sample of distinct unit vectors."""
    rng = np.random.default_rng(seed)
    width = vectors.shape[1] if vectors.ndim == 2 else 0
    centres, children, leaf, leaves = [np.zeros(width)], [(0, 0)], [-1], 0
    todo = [(0, vectors)]
    while todo:
        node, rows = todo.pop()
        split = k_means(rows, BRANCHES, rng) if len(rows) > LEAF_ROWS else rows[:0]
        if len(split) < 2:
            leaf[node] = leaves
            leaves += 1
            continue
        near = np.argmax(rows @ split.T - 0.5 * (split * split).sum(axis=1), axis=1)
        children[node] = (len(centres), len(centres) + len(split))
        for c in range(len(split)):
            centres.append(split[c])
            children.append((0, 0))
            leaf.append(-1)
            todo.append((len(centres) - 1, rows[near == c]))
    return Tree(np.stack(centres), children, leaf, leaves)


def graft(tree: Tree, grown: dict[int, Tree]) -> Tree:
    """The tree with some of its leaves replaced by trees of their own."""
    centres, children, leaf = list(tree.centres), list(tree.children), list(tree.leaf)
    for node in [n for n, k in enumerate(tree.leaf) if k in grown]:
        sub = grown[tree.leaf[node]]
        base = len(centres) - 1  # node i of the sub-tree becomes base + i, its root the leaf itself
        centres += list(sub.centres[1:])
        children[node] = (base + sub.children[0][0], base + sub.children[0][1])
        children += [(base + a, base + b) if b else (0, 0) for a, b in sub.children[1:]]
        leaf[node] = sub.leaf[0]
        leaf += sub.leaf[1:]
    names = iter(range(len(leaf)))
    leaf = [next(names) if b == 0 else -1 for _, b in children]
    return Tree(np.stack(centres), children, leaf, sum(k >= 0 for k in leaf))


def cells(tree: Tree, held: dict[int, int], most: int) -> np.ndarray:
    """Number of the cell of each leaf: leaves in the tree's order, cut where `most` entries are passed."""
    out, todo, number, total = np.zeros(tree.leaves, np.int64), [0], 0, 0
    while todo:
        node = todo.pop()
        if tree.leaf[node] < 0:
            todo += range(*tree.children[node])
            continue
        size = held.get(tree.leaf[node], 0)
        if total and total + size > most:
            number, total = number + 1, 0
        out[tree.leaf[node]], total = number, total + size
    return out


def visits_needed(places: list[list[int]], leaves: int, target: float = RECALL) -> int:
    """Leaves to open: the fewest at which the recall of the probes, less 1.64 standard errors, reaches the target.

    places: for each probe, the place of each of its neighbours' leaves in the probe's order of leaves.
    """
    for visits in sorted({p + 1 for row in places for p in row}):
        found = np.array([np.mean([p < visits for p in row]) for row in places if row])
        if found.mean() - 1.64 * found.std() / np.sqrt(len(found)) >= target:
            return visits
    return leaves


def usable(vector: Column) -> Column:
    """Vectors that take part."""
    length = F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & fine & (length > 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), np.float64).reshape(len(flat), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scale = np.abs(vectors).max(axis=1, keepdims=True, initial=0)
    vectors = vectors / np.where(scale > 0, scale, 1)
    return vectors / np.maximum(np.sqrt((vectors * vectors).sum(axis=1, keepdims=True)), 1e-300)


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine in double precision, the same for the same two vectors wherever they lie."""
    return float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))


def build(spark: SparkSession, entries: DataFrame) -> tuple[Tree, DataFrame]:
    """The tree of entries (v, ids), and the entries with their leaf."""
    sample = entries.select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE_ROWS).toArrow()
    tree = grow(_unit(_matrix(sample.column("v"))))
    while True:
        shared = spark.sparkContext.broadcast(tree)

        def assign(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                leaves = shared.value.descend(_unit(_matrix(batch.column("v")))) if len(batch) else []
                yield pa.RecordBatch.from_arrays([batch.column("v"), batch.column("ids"), pa.array(leaves, pa.int32())], ["v", "ids", "leaf"])

        index = written(spark, entries.mapInArrow(assign, "v array<double>, ids array<long>, leaf int"), "leaves")
        # One row per leaf, about MAX_LEAVES at most.
        large = [r["leaf"] for r in index.groupBy("leaf").count().filter(F.col("count") > SPLIT_ROWS).orderBy(F.desc("count"), "leaf").limit(MAX_LEAVES).collect()]
        if not large or tree.leaves >= MAX_LEAVES:
            return tree, index
        number = F.row_number().over(Window.partitionBy("leaf").orderBy(F.xxhash64("v"), "v"))
        some = index.filter(F.col("leaf").isin(large)).select("leaf", "v").withColumn("n", number).filter(F.col("n") <= SUB_ROWS)

        def fit(frame: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"leaf": frame["leaf"].iloc[:1], "tree": [pickle.dumps(grow(_unit(np.stack(frame["v"].to_numpy()))))]})

        grown = {r["leaf"]: pickle.loads(r["tree"]) for r in some.groupBy("leaf").applyInPandas(fit, "leaf int, tree binary").collect()}
        grown = {k: t for k, t in grown.items() if t.leaves > 1}
        if not grown:  # entries that k-means can't part
            return tree, index
        tree = graft(tree, grown)


def true_leaves(spark: SparkSession, index: DataFrame, probes: np.ndarray, k: int) -> dict[int, list[int]]:
    """The leaves of the k nearest entries of each probe, itself left out, by brute force over the whole index."""
    shared = spark.sparkContext.broadcast(probes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            near = shared.value @ _unit(_matrix(batch.column("v"))).T
            near[near > 1 - 1e-12] = -np.inf
            best = np.argsort(-near, axis=1)[:, :k]
            rows = np.repeat(np.arange(len(near)), best.shape[1])
            found = pa.array(near[rows, best.ravel()]), batch.column("leaf").take(pa.array(best.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), *found], ["probe", "near", "leaf"])

    rank = F.row_number().over(Window.partitionBy("probe").orderBy(F.desc("near"), "leaf"))
    best = index.select("v", "leaf").mapInArrow(run, "probe int, near double, leaf int").filter("near > -2").withColumn("rank", rank).filter(F.col("rank") <= k)
    out: dict[int, list[int]] = {}
    for r in best.select("probe", "leaf").collect():  # k rows a probe
        out.setdefault(r["probe"], []).append(r["leaf"])
    return out


def nearest(spark: SparkSession, vectors: DataFrame, k: int = 5, every: int = 50, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose id is divisible by `every`."""
    ship(spark)
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("v")))
    width = rows.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").first()
    if width is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.size("v") == width["w"])
    # Distinct vectors with their k + 1 smallest ids; the limit applies before the shuffle.
    first = F.dense_rank().over(Window.partitionBy("v").orderBy("id"))
    kept = rows.withColumn("at", first).filter(F.col("at") <= k + 1)
    entries = written(spark, kept.groupBy("v").agg(F.array_sort(F.collect_set("id")).alias("ids")), "entries")
    tree, index = build(spark, entries)
    asked = written(spark, rows.filter(F.col("id") % every == 0).dropDuplicates(["id", "v"]), "queries")
    probes = asked.orderBy(F.xxhash64("id"), "id", "v").limit(PROBES).toArrow()
    if len(probes):
        probes = _unit(_matrix(probes.column("v")))
        wanted = true_leaves(spark, index, probes, k)
        order = {p: {leaf: i for i, leaf in enumerate(tree.best_bins(probes[p]))} for p in wanted}
        tree.visits = visits_needed([[order[p][leaf] for leaf in leaves] for p, leaves in wanted.items()], tree.leaves)
    # One row per leaf, about MAX_LEAVES at most.
    counted = index.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("ids")).alias("ids")).collect()
    cell_of = cells(tree, {r["leaf"]: r["n"] for r in counted}, CELL_ROWS)
    shared = spark.sparkContext.broadcast((tree, {r["leaf"]: r["ids"] for r in counted}, cell_of))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, counts, cell_at = shared.value
        for batch in batches:
            units = _unit(_matrix(batch.column("v"))) if len(batch) else []
            owner, cell, opened = [], [], []
            for i, unit in enumerate(units):
                found, seen, by_cell = 0, 0, {}
                for leaf in model.best_bins(unit):
                    if leaf in counts:
                        by_cell.setdefault(int(cell_at[leaf]), []).append(leaf)
                        found += counts[leaf]
                    seen += 1
                    if seen >= model.visits and found > 4 * k:
                        break
                owner += [i] * len(by_cell)
                cell += by_cell
                opened += by_cell.values()
            at = pa.array(owner, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("id").take(at), batch.column("v").take(at), pa.array(cell, pa.int32()), pa.array(opened, pa.list_(pa.int32()))], ["id", "q", "cell", "opened"])

    def celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("of", pa.array(shared.value[2][np.asarray(batch.column("leaf"))], pa.int32()))

    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))  # the walks are the queries' work, however few bytes they are
    asked = written(spark, asked.repartition(spread).mapInArrow(walk, "id long, q array<double>, cell int, opened array<int>"), "asked")
    index = index.mapInArrow(celled, "v array<double>, ids array<long>, leaf int, of int")
    # Tiles: a leaf larger than a cell is cut into blocks, the queries of a busy cell into parts. One row per cell.
    held = np.bincount(cell_of[[r["leaf"] for r in counted]], [r["n"] for r in counted], len(cell_of)) if counted else np.zeros(0)
    facts = [(int(c), int(-(-n // CELL_ROWS))) for c, n in enumerate(held) if n]
    facts = spark.createDataFrame(facts, "cell int, blocks int").join(asked.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("parts")), "cell")
    facts = written(spark, facts, "facts")
    asked = asked.join(F.broadcast(facts), "cell").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    asked = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    renamed = facts.select(F.col("cell").alias("cell"), F.col("blocks").alias("blocks"), F.col("parts").alias("parts"))
    index = index.join(F.broadcast(renamed), F.col("of") == F.col("cell")).withColumn("block", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int"))
    index = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tile = ["cell", "block", "part"]

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            asked_v, held_v = np.stack(left["q"].to_numpy()), np.stack(right["v"].to_numpy())
            asked_u, held_u, leaf = _unit(asked_v), _unit(held_v), right["leaf"].to_numpy()
            opened = left["opened"].tolist()
            open_ = np.repeat(np.arange(len(left)), [len(o) for o in opened]), np.concatenate(opened)
            rough = np.full((len(left), len(right)), -np.inf)
            for name in np.unique(leaf):
                who, where = open_[0][open_[1] == name], np.flatnonzero(leaf == name)
                rough[np.ix_(who, where)] = asked_u[who] @ held_u[where].T
            ids = right["ids"].tolist()
            for i, query in enumerate(left["id"].tolist()):
                # entries near the k-th best by the matrix product are scored one by one
                line = rough[i]
                edge = np.partition(line, -k - 1)[-k - 1] - 1e-9 if len(line) > k + 1 else -np.inf
                scored = [(-cosine(asked_v[i], held_v[j]), c) for j in np.flatnonzero((line >= edge) & (line > -np.inf)) for c in ids[j] if c != query]
                out += [(query, c, -s) for s, c in heapq.nsmallest(k, scored)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = asked.groupBy(*tile).cogroup(index.groupBy(*tile)).applyInPandas(best, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
