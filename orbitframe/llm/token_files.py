"""Token ids as binary files: each document compressed apart with a shared dictionary.

A zstandard dictionary is trained on all ids of at most SAMPLE_ROWS documents (those of smallest
hash of doc_id), serialised in pieces of at most SAMPLE_BYTES with all their bytes. Every document's ids, end id last, are compressed by
themselves with it, dealt to shards by ranges of doc_id, sorted, and packed into segments.

A segment is one binary value: a header (magic, version, bytes per id, SHA-256 of the
dictionary, number of documents, ids of the shard before it), an index (doc_id, offset,
length, ids of each document) and the compressed documents. Segments are stored as rows
of a Parquet table with their doc_id range, so any store that Spark reads will do and a
document is fetched by reading one segment's index and one frame. The dictionary lies
beside them; readers refuse a segment whose dictionary hash differs.

Ids are serialised as little-endian integers of 2 bytes where the vocabulary allows,
else 4, low bytes of all ids first, then the next bytes, which compresses better.

Null texts count as empty (the end id alone); rows of a repeated doc_id each count and
are ordered by a hash of the text, and may fill several shards; null doc_ids come first; extra
columns are ignored; an empty table gives empty files and an empty result.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .bpe import blocks, encoder, read_vocabulary
from .common import clean_text, new_path, ship_texts, trimmed

SAMPLE_ROWS = 1000
#: Bytes of one piece of a document in the training sample, and of the dictionary.
SAMPLE_BYTES, DICTIONARY_BYTES = 16_384, 65_536
#: A segment is closed at this many documents or compressed bytes.
SEGMENT_DOCS, SEGMENT_BYTES = 512, 1 << 20
#: Bytes of text that are encoded together.
ENCODE_BYTES = 16 << 20
END_ID = 1
MAGIC, VERSION = b"OFTS", 1
HEADER = struct.Struct("<4sBBxx32sIq")
INDEX = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("offset", "<u4"), ("bytes", "<u4"), ("n", "<u4")])


def pack_ids(ids: np.ndarray, width: int) -> bytes:
    """Ids as planes of bytes, lowest first."""
    return ids.astype("<u4").view("u1").reshape(-1, 4)[:, :width].T.tobytes()


def unpack_ids(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 4), "u1")
    out[:, :width] = np.frombuffer(data, "u1").reshape(width, -1).T
    return out.view("<u4").reshape(-1)


def train_dictionary(samples: list[bytes]) -> bytes:
    """A shared dictionary, or none where there is too little to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _dictionary(data: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(data) if data else None


def write_files(spark: SparkSession, docs: DataFrame, vocabulary_path: str, path: str, end_id: int = END_ID) -> None:
    """Writes the ids of every whole text under path: segments/ and dictionary/."""
    import zstandard

    ship_texts(spark)
    vocabulary = spark.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    width = 2 if encoder(vocabulary.value).tokenizer.get_vocab_size() <= 1 << 16 else 4

    def ended(texts: pa.Array) -> Iterator[np.ndarray]:
        for ids in encoder(vocabulary.value).batch(texts):
            yield np.append(ids, np.uint32(end_id))

    def serialised(texts: pa.Array) -> Iterator[tuple[int, bytes]]:
        for ids in ended(texts):
            yield len(ids), pack_ids(ids, width)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = SAMPLE_BYTES // width
        for batch in batches:
            data = [pack_ids(ids[k : k + step], width) for ids in ended(batch.column("_of_text")) for k in range(0, len(ids), step)]
            yield pa.RecordBatch.from_arrays([pa.array(data, pa.binary())], ["data"])

    # a row's place among those of its doc_id: null ids before others, then by the text, equal rows at random
    place = F.xxhash64(clean_text()).bitwiseAND(~((1 << 20) - 1)).bitwiseOR(F.xxhash64(F.monotonically_increasing_id()).bitwiseAND((1 << 20) - 1))
    place = F.shiftrightunsigned(place, 1).bitwiseOR(F.when(F.col("doc_id").isNull(), F.lit(-(2**63))).otherwise(F.lit(0)))
    texts = docs.select("doc_id", clean_text().alias("_of_text"), place.alias("place"))
    chosen = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)
    taken = texts.join(F.broadcast(chosen), "doc_id", "left_semi").dropDuplicates(["doc_id"]).mapInArrow(sample, "data binary")
    samples = sorted(taken.toArrow().column("data").to_pylist())
    dictionary = spark.sparkContext.broadcast(train_dictionary(samples))
    digest = hashlib.sha256(dictionary.value).digest()
    spark.createDataFrame([(bytearray(digest), bytearray(dictionary.value), width)], "sha256 binary, data binary, width int").coalesce(1).write.parquet(f"{path}/dictionary")

    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = [float(k) / shards for k in range(1, shards)]
    known = F.coalesce("doc_id", F.lit(-(2**63)))
    bounds = (docs.select(F.percentile_approx(known, at, 10_000).alias("b")).first()["b"] if at else None) or []
    # a doc_id that is several bounds holds as many shards: its rows are dealt by their place
    hot: dict[int, list[int]] = {}
    for b, n in Counter(bounds).items():
        if n > 1:
            parts = [float(k) / n for k in range(1, n)]
            hot[b] = texts.filter(known == F.lit(b)).select(F.percentile_approx("place", parts, 10_000).alias("p")).first()["p"]

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, edges = zstandard.ZstdCompressor(level=3, dict_data=_dictionary(dictionary.value)), np.array(bounds, np.int64)
        for table in blocks(batches, ENCODE_BYTES):  # large blocks, as a distinct word is looked up once for each
            batch = table.to_batches()[0]
            packed = [(n, made.compress(data)) for n, data in serialised(batch.column("_of_text"))]
            ids = batch.column("doc_id").fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
            shard = np.searchsorted(edges, ids, side="left")
            for b, parts in hot.items():
                own = ids == b
                shard[own] += np.searchsorted(np.array(parts, np.int64), np.asarray(batch.column("place"))[own], side="left")
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("place"), pa.array(shard, pa.int32()), pa.array([n for n, _ in packed], pa.int64()), pa.array([d for _, d in packed], pa.binary())],
                ["doc_id", "place", "shard", "n", "frame"],
            )

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = number = before = 0

        def close() -> pa.RecordBatch:
            nonlocal rows, size, number, before
            body = pack_segment(rows, width, digest, before)
            total = sum(r[2] for r in rows)
            out = pa.RecordBatch.from_pylist(
                [{"shard": rows[0][1], "segment": number, "first_id": rows[0][0], "last_id": rows[-1][0], "docs": len(rows), "tokens": total, "body": body}],
                pa.schema([("shard", pa.int32()), ("segment", pa.int32()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("docs", pa.int32()), ("tokens", pa.int64()), ("body", pa.binary())]),
            )
            rows, size, number, before = [], 0, number + 1, before + total
            return out

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in ("doc_id", "shard", "n", "frame"))):
                if rows and (row[1] != rows[0][1] or len(rows) >= SEGMENT_DOCS or size + len(row[3]) > SEGMENT_BYTES):
                    other = row[1] != rows[0][1]
                    yield close()
                    if other:
                        number = before = 0
                rows.append(row)
                size += len(row[3])
        if rows:
            yield close()

    frames = texts.mapInArrow(lambda batches: trimmed(compress(batches)), "doc_id long, place long, shard int, n long, frame binary").repartitionById(shards, F.col("shard"))
    packed = frames.sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "place", "n", "frame")
    packed.mapInArrow(segments, "shard int, segment int, first_id long, last_id long, docs int, tokens long, body binary").write.parquet(f"{path}/segments")


def pack_segment(rows: list[tuple], width: int, digest: bytes, before: int) -> bytes:
    """A segment of rows (doc_id, shard, number of ids, compressed ids)."""
    index = np.zeros(len(rows), INDEX)
    index["doc_id"] = [r[0] or 0 for r in rows]
    index["null"] = [r[0] is None for r in rows]
    index["n"] = [r[2] for r in rows]
    index["bytes"] = [len(r[3]) for r in rows]
    index["offset"] = np.cumsum([0, *index["bytes"][:-1].tolist()])
    return HEADER.pack(MAGIC, VERSION, width, digest, len(rows), before) + index.tobytes() + b"".join(r[3] for r in rows)


def open_segment(body: bytes, digest: bytes) -> tuple[int, int, np.ndarray, memoryview]:
    """Bytes per id, ids of the shard before, the index and the compressed documents of a segment."""
    magic, version, width, found, count, before = HEADER.unpack_from(body)
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a segment of this format")
    if found != digest:
        raise ValueError("the segment was written with another dictionary")
    index = np.frombuffer(body, INDEX, count, HEADER.size)
    return width, before, index, memoryview(body)[HEADER.size + index.nbytes :]


def _reader(spark: SparkSession, path: str):
    import zstandard

    ship_texts(spark)
    row = spark.read.parquet(f"{path}/dictionary").first()
    digest, data = bytes(row["sha256"]), bytes(row["data"])
    if hashlib.sha256(data).digest() != digest:
        raise ValueError("the dictionary is damaged")
    shared = spark.sparkContext.broadcast(data)

    def documents(body: bytes, wanted: set[int] | None = None) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, ids of the shard before it, its ids), of all documents or of those wanted."""
        made = zstandard.ZstdDecompressor(dict_data=_dictionary(shared.value))
        width, before, index, frames = open_segment(body, digest)
        for doc_id, null, offset, size, n in index.tolist():
            if wanted is None or (not null and doc_id in wanted):
                yield None if null else doc_id, before, unpack_ids(made.decompress(frames[offset : offset + size]), width)
            before += n

    return documents


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of every document in the files."""
    documents = _reader(spark, path)
    files = spark.read.parquet(f"{path}/segments")
    # One row per shard, as many as there are shuffle partitions: bounded by the cluster's size.
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.groupBy("shard").agg(F.sum("tokens").alias("all")).select("shard", F.coalesce(F.sum("all").over(order), F.lit(0)).alias("shard_start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, base in zip(batch.column("body"), batch.column("shard_start").to_pylist()):
                rows = [(i, base + s, len(ids), zlib.crc32(ids.tobytes())) for i, s, ids in documents(body.as_py())]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.select("shard", "body").join(F.broadcast(starts), "shard").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """doc_id and ids (array<int>) of a few documents: only their segments and frames are read."""
    documents, wanted = _reader(spark, path), set(ids)
    files = spark.read.parquet(f"{path}/segments")
    near = F.lit(False)
    for i in sorted(wanted):
        near = near | ((F.coalesce("first_id", F.lit(i)) <= i) & (F.col("last_id") >= i))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, x.astype("<i4")) for body in batch.column("body") for i, _, x in documents(body.as_py(), wanted)]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int64()), pa.array([x for _, x in rows], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return files.filter(near).select("body").mapInArrow(run, "doc_id long, ids array<int>")


def token_files(spark: SparkSession, docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """Writes the files to the shared folder and reads them back."""
    path = new_path(spark, "tokens")
    write_files(spark, docs, vocabulary_path, path)
    return read_files(spark, path)
