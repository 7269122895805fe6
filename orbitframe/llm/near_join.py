"""N-gram Jaccard join by chosen paths: near copies by their sets of five-word shingles.

Documents with the same set of shingles are one entry (its smallest doc_id stands for it),
so copies are never paired with each other. Entries carry a sketch: COORDINATES sampled
shared tokens, the smallest hash of the set under each of as many hash functions; two sets
agree in a coordinate with the chance of their Jaccard similarity.

The join splits recursively. Each run starts from one coordinate and deals the entries
to buckets by its value; a Bloom filter of the values that come up twice lets only those that
may meet someone go on, with their sketches. A bucket of more than LIMIT entries is split again by
coordinates that its path chooses (FANOUT per level). Small buckets are searched by brute
force: sketches that agree in at least ROUGH of the coordinates become candidates, and of each
connected part of a bucket a star is kept, as only connection matters at this point. A bucket
still large at the last level is not searched but handed on whole, as one star. Runs are
repeated until the chance that a pair at the threshold meets in none is under 1 - RECALL.
The HOT_KEYS largest buckets of a level are never brought together.

Connected candidates form neighbourhoods. Within each, every pair is compared exactly on
the whole shingle sets, in tiles of at most 2 * TILE entries; this gives exact counts of
links, and of each tile a spanning forest of the links. Its components are the classes.

Words are runs of characters without white space, lower-cased; a text of fewer than five
words is one shingle. Null texts count as empty; texts without words are linked to nothing
and are classes of their own. Rows of null doc_id are returned with a null class;  Extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common
from .common import bitmap_filter, clean_text, drop_ids, filter_bits, join_groups, ship_texts, small, trimmed, with_maybe, written

WORDS, THRESHOLD, RECALL = 5, 0.8, 0.999
COORDINATES, ROUGH = 64, 0.6
LIMIT, TILE = 64, 256
#: Buckets of a level whose entries stay where they are; each other one has at most 1 / HOT_KEYS of the rows.
HOT_KEYS = 1000
#: Coordinates by which a large bucket is split, level by level below the root.
FANOUT = (2, 2, 1, 1)
#: Entries of a worker's cache of word hashes; a full cache starts anew.
CACHE_ENTRIES = 300_000
#: Shared tokens in one step of a tile's comparison.
STEP = 8192


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective mix of 64-bit integers."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Shingler:
    """Sets of hashed shingles of whole texts, and their sketches."""

    def __init__(self, words: int = WORDS):
        import xxhash

        self.words, self.digest = words, xxhash.xxh64_intdigest
        self.known: dict[str, int] = {}
        rng = np.random.default_rng(29)
        self.scale = rng.integers(0, 2**63, words, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.odd = rng.integers(0, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def shingles(self, text: str) -> np.ndarray:
        """Sorted distinct hashes of the shingles."""
        found = text.lower().split()
        if not found:
            return np.zeros(0, np.uint64)
        known = self.known
        try:
            hashes = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
        except KeyError:
            if len(known) > CACHE_ENTRIES:
                known.clear()
            for word in set(found):
                if word not in known:
                    known[word] = self.digest(word.encode("utf-8", "surrogatepass"))
            hashes = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
        n = max(1, len(found) - self.words + 1)
        total = np.zeros(n, np.uint64)
        for k in range(min(self.words, len(found))):
            total += hashes[k : k + n] * self.scale[k]
        return np.unique(mixed(total))

    def sketch(self, shingles: np.ndarray) -> np.ndarray:
        """The upper 32 bits of the least hash under each function."""
        least = np.full(COORDINATES, 2**64 - 1, np.uint64)
        for k in range(0, len(shingles), 4096):
            least = np.minimum(least, (shingles[None, k : k + 4096] * self.odd[:, None]).min(axis=1))
        return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def runs_needed(threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """Runs after which a pair at the threshold has met with the given chance, on the longest paths."""
    meets = 1.0
    for fan in reversed(FANOUT):
        meets = 1 - (1 - threshold * meets) ** fan
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold * meets))


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric boolean matrix."""
    edges, free = [], np.ones(len(linked), bool)
    for root in range(len(linked)):
        if not free[root]:
            continue
        free[root] = False
        todo = [root]
        while todo:
            at = todo.pop()
            new = np.flatnonzero(linked[at] & free)
            free[new] = False
            edges += [(at, int(x)) for x in new]
            todo += new.tolist()
    return edges


def similar(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Boolean matrix of pairs of sets with a Jaccard similarity of at least the threshold."""
    m = len(sets)
    lengths = np.array([len(s) for s in sets], np.float64)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    both = count[token] > 1
    rank = np.cumsum(count > 1) - 1
    owner, token = owner[both], rank[token[both]]
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    common = np.zeros((m, m))
    for k in range(0, int(token[-1]) + 1 if len(token) else 0, STEP):
        a, b = np.searchsorted(token, [k, k + STEP])
        held = np.zeros((m, STEP), np.float32)
        held[owner[a:b], token[a:b] - k] = 1
        common += held @ held.T
    linked = common >= threshold * (lengths[:, None] + lengths[None, :] - common) - 1e-9
    np.fill_diagonal(linked, False)
    return linked & (lengths[:, None] > 0)


def features(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n (shingles), fp1, fp2 (a fingerprint of the set), sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Shingler()
        for batch in small(batches):
            n, one, two, sketches = [], [], [], []
            for text in batch.column("_of_text").to_pylist():
                found = tool.shingles(text)
                n.append(len(found))
                one.append(int(mixed(found, 1).sum(dtype=np.uint64).view(np.int64)))
                two.append(int(mixed(found, 2).sum(dtype=np.uint64).view(np.int64)))
                sketches.append(tool.sketch(found))
            flat = np.concatenate([*sketches, np.zeros(0, np.int32)]).astype(np.int32)
            at = np.arange(0, len(flat) + 1, COORDINATES, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int32()), pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.ListArray.from_arrays(at, flat)],
                ["doc_id", "n", "fp1", "fp2", "sketch"],
            )

    return docs.select("doc_id", clean_text().alias("_of_text")).mapInArrow(lambda batches: trimmed(run(batches)), "doc_id long, n int, fp1 long, fp2 long, sketch array<int>")


def _stars(reps: np.ndarray, sketches: np.ndarray) -> list[tuple[int, int]]:
    """Candidate edges of a small bucket, whose reps ascend: of each connected part from its least rep."""
    agree = (sketches[:, None, :] == sketches[None, :, :]).sum(axis=2) >= ROUGH * COORDINATES
    np.fill_diagonal(agree, False)
    if not agree.any():
        return []
    root = np.arange(len(reps))
    for i, j in forest(agree):
        root[j] = root[i]
    star = np.flatnonzero(root != np.arange(len(reps)))
    return list(zip(reps[root[star]].tolist(), reps[star].tolist()))


def _meet(rows: DataFrame, last: bool) -> DataFrame:
    """Rows (a, b, key, sketch) of rows (key, rep, sketch): candidate edges (a, b) of small buckets.

    Entries of large buckets come back as (a, null, key, sketch); at the last level as edges to
    their bucket's least rep. A bucket streams by in order of rep, LIMIT entries held at most.
    """
    arrow = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64()), ("sketch", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, reps, held, large, least = None, [], [], False, None
        for batch in batches:
            edges: list[tuple[int, int]] = []
            passed: list[tuple[int, int, np.ndarray]] = []
            flat = np.asarray(batch.column("sketch").flatten(), np.int32).reshape(-1, COORDINATES)
            for k, rep, sketch in zip(batch.column("key").to_pylist(), batch.column("rep").to_pylist(), flat):
                if k != key:
                    if not large and len(reps) > 1:
                        edges += _stars(np.array(reps), np.stack(held))
                    key, reps, held, large, least = k, [], [], False, rep
                if large and last:
                    edges.append((least, rep))
                elif large:
                    passed.append((rep, k, sketch))
                else:
                    reps.append(rep)
                    held.append(sketch)
                    large = len(reps) > LIMIT
                    if large and last:
                        edges += [(least, r) for r in reps[1:]]
                    elif large:
                        passed += [(r, k, s) for r, s in zip(reps, held)]
            a = [e[0] for e in edges] + [p[0] for p in passed]
            b = [e[1] for e in edges] + [None] * len(passed)
            at = [None] * len(edges) + [p[1] for p in passed]
            sketches = [None] * len(edges) + [p[2] for p in passed]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((a, b, at, sketches), arrow)], schema=arrow)
        edges = _stars(np.array(reps), np.stack(held)) if not large and len(reps) > 1 else []
        yield pa.RecordBatch.from_pylist([{"a": a, "b": b, "key": None, "sketch": None} for a, b in edges], arrow)

    return rows.repartition("key").sortWithinPartitions("key", "rep").mapInArrow(run, "a long, b long, key long, sketch array<int>")


def candidates(spark: SparkSession, entries: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """Edges (a, b) between the reps of entries (rep, sketch) that the chosen paths bring together."""
    runs = runs_needed(threshold, recall)
    keys = F.transform(F.sequence(F.lit(1), F.lit(runs)), lambda r: F.xxhash64(r, F.element_at("sketch", r)))
    bits = filter_bits(runs * entries.count())
    filters = written(spark, bitmap_filter(entries.select(F.explode(keys).alias("key")), "key", bits, at_least=2), "filter")
    if bits <= common.MAX_FILTER_BITS:
        level = with_maybe(entries.select("rep", "sketch", F.explode(keys).alias("key")), "key", bits, filters).filter("_of_maybe").drop("_of_maybe")
    else:  # only keys move to a filter this large; who may meet fetches the sketch
        level = with_maybe(entries.select("rep", F.explode(keys).alias("key")), "key", bits, filters).filter("_of_maybe").drop("_of_maybe")
        level = level.join(entries.select("rep", "sketch"), "rep")
    edges = []
    for depth in range(len(FANOUT) + 1):
        last = depth == len(FANOUT)
        level = written(spark, level.select("key", "rep", "sketch"), f"level{depth}")
        sizes = level.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("least")).filter(F.col("n") > LIMIT)
        hot = {r["key"]: r["least"] for r in sizes.orderBy(F.desc("n"), "key").limit(HOT_KEYS).collect()}
        met = written(spark, _meet(level.filter(~F.col("key").isin(list(hot))) if hot else level, last), "met")
        edges.append(met.filter("b is not null").select("a", "b"))
        large = met.filter("b is null").select("key", F.col("a").alias("rep"), "sketch")
        if hot:
            apart = level.filter(F.col("key").isin(list(hot)))
            if last:
                edges.append(_to_least(apart, hot))
            large = large.unionByName(apart)
        if last or (not hot and large.isEmpty()):
            break
        fans = F.transform(F.sequence(F.lit(0), F.lit(FANOUT[depth] - 1)), lambda k: F.pmod(F.xxhash64("key", k), F.lit(COORDINATES)))
        split = F.transform(fans, lambda at: F.xxhash64("key", at, F.element_at("sketch", (at + 1).cast("int"))))
        level = large.select("rep", "sketch", F.explode(split).alias("key"))
    out = edges[0]
    for more in edges[1:]:
        out = out.unionByName(more)
    return out.distinct()


def _to_least(rows: DataFrame, least: dict[int, int]) -> DataFrame:
    """Edges (a, b) from the least rep of a bucket to each other one; rows (key, rep, ...), HOT_KEYS keys at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [(least[k], r) for k, r in zip(batch.column("key").to_pylist(), batch.column("rep").to_pylist()) if least[k] != r]
            yield pa.RecordBatch.from_arrays([pa.array([e[i] for e in made], pa.int64()) for i in (0, 1)], ["a", "b"])

    return rows.select("key", "rep").mapInArrow(run, "a long, b long")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """id, label (the least id of its component) of the ids in edges (a, b).

    Labels spread along edges by partial minima and then jump to their own label's label,
    until none changes; every round is a table in the shared folder.
    """
    edges = written(spark, edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "both")
    labels = written(spark, edges.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("label")), "labels")
    if labels.isEmpty():
        return labels
    while True:
        near = edges.join(labels, F.col("b") == F.col("id")).groupBy("a").agg(F.min("label").alias("near"))
        spread = labels.join(near, F.col("id") == F.col("a")).select("id", "label", F.least("label", "near").alias("less"))
        up = labels.select(F.col("id").alias("up"), F.col("label").alias("top"))
        moved = spread.join(up, F.col("less") == F.col("up")).select("id", F.least("less", "top").alias("now"), "label")
        moved = written(spark, moved, "labels")
        labels = moved.select("id", F.col("now").alias("label"))
        if moved.filter("now < label").isEmpty():
            return labels


def exact_links(spark: SparkSession, docs: DataFrame, members: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Compares all members (rep, fp1, fp2, copies, label) of a label exactly, in tiles.

    Rows (a, b, links, edge). edge false: links is the number of documents linked to a in one
    tile, and b is a's class where the label has only this tile, else null. edge true: (a, b)
    is an edge of a spanning forest of the links of one of several tiles.
    """
    ship_texts(spark)
    sizes = members.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("blocks"))
    members = written(spark, members.join(sizes, "label").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")), "members")
    bits = filter_bits(members.count())
    bitmaps = bitmap_filter(members.select(F.xxhash64("rep").alias("_of_h")), "_of_h", bits)
    texts = docs.select("doc_id", clean_text().alias("_of_text")).withColumn("_of_h", F.xxhash64("doc_id"))
    texts = with_maybe(texts, "_of_h", bits, bitmaps).filter("_of_maybe").select("doc_id", "_of_text")
    rows = members.join(texts, F.col("rep") == F.col("doc_id"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("label", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "blocks", "block", "rep", "fp1", "fp2", "copies", "_of_text")
    key = ["label", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Shingler()
        at, held = None, {}

        def close() -> pa.RecordBatch:
            reps, found = list(held), list(held.values())
            block = np.array([f[0] for f in found])
            linked = similar([f[2] for f in found], threshold)
            if at[1] != at[2]:
                linked &= block[:, None] != block[None, :]
            links = linked @ np.array([f[1] for f in found], np.int64)
            edges, own = forest(linked), [None] * len(reps)
            if found[0][3] == 1:
                own = list(reps)
                for i, j in edges:  # a tree's edges come from its root on
                    own[j] = own[i]
                least = {}
                for rep, root in zip(reps, own):
                    least[root] = min(rep, least.get(root, rep))
                own, edges = [least[root] for root in own], []
            a = [*reps, *(reps[i] for i, _ in edges)]
            b = [*own, *(reps[j] for _, j in edges)]
            made = [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array([*links.tolist(), *[0] * len(edges)], pa.int64()), pa.array([False] * len(reps) + [True] * len(edges))]
            return pa.RecordBatch.from_arrays(made, ["a", "b", "links", "edge"])

        for batch in small(batches):
            for label, i, j, blocks, block, rep, fp1, fp2, copies, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (label, i, j) != at:
                    if len(held) > 1:
                        yield close()
                    at, held = (label, i, j), {}
                found = tool.shingles(text)
                prints = tuple(int(mixed(found, k).sum(dtype=np.uint64).view(np.int64)) for k in (1, 2))
                if rep not in held and prints == (fp1, fp2):
                    held[rep] = (block, copies, found, blocks)
        if len(held) > 1:
            yield close()

    return rows.repartition(*key).sortWithinPartitions(*key, "rep", "fp1", "fp2").mapInArrow(lambda batches: trimmed(run(batches)), "a long, b long, links long, edge boolean")


def jaccard_join(spark: SparkSession, docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id (least doc_id of the class), n_links, copies for every row of docs.

    n_links: other rows of similarity at least the threshold, copies included.
    copies: rows with the same set of shingles, itself included.
    """
    ship_texts(spark)
    rows = written(spark, features(spark, docs), "features")
    some = rows.filter("n > 0 and doc_id is not null")
    groups = some.groupBy("fp1", "fp2").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("sketch").alias("sketch"))
    groups = written(spark, groups, "entries")
    near = components(spark, candidates(spark, groups, threshold, recall))
    members = groups.select("rep", "fp1", "fp2", "copies").join(near, F.col("rep") == F.col("id")).drop("id")
    links = written(spark, exact_links(spark, docs, members, threshold), "links")
    counts = links.filter("not edge").groupBy(F.col("a").alias("_of_a")).agg(F.sum("links").alias("links"), F.min("b").alias("own"))
    classes = components(spark, links.filter("edge").select("a", "b"))
    groups = groups.drop("sketch").join(classes, F.col("rep") == F.col("id"), "left").join(counts, F.col("rep") == F.col("_of_a"), "left")
    groups = groups.select(
        "fp1", "fp2", "copies", F.coalesce("label", "own", "rep").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    joined = join_groups(some.select("doc_id", "fp1", "fp2"), written(spark, groups, "classes"), ["fp1", "fp2"], "copies")
    joined = joined.select("doc_id", "class_id", "n_links", "copies")
    alone = rows.filter("n = 0 or doc_id is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("copies"))
    return joined.unionByName(alone)


def one_of_each(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """The rows of docs whose doc_id is the least of its class, with all their columns.

    Texts without words and rows of null doc_id are classes of their own and stay; rows of a
    repeated doc_id that is the least of its class all stay; an empty table stays empty.
    """
    found = jaccard_join(spark, docs, **options)
    return drop_ids(spark, docs, found.filter("doc_id <> class_id").select("doc_id"))
