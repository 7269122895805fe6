"""Byte-pair encoding and decoding by a distinct-word table.

Spark splits the texts at spaces and line ends, which no token of the vocabulary spans, in
blocks of about BLOCK_BYTES of text: a block's distinct words are numbered, and each
document becomes the numbers of its words, by position. The distinct words of all blocks are
dealt by their hash to as many buckets as there are shuffle partitions, so the copies of a
word meet in one task, which encodes each distinct word once. The ids go back to their blocks,
where they are joined to the numbers by position. What moves are words and ids once for each block
that holds them, and the numbers, all compressed; texts don't move.

Decoding joins ids to the id-to-piece table (as large as the vocabulary).

A task holds one block, or the distinct words of one bucket: the share of the corpus' distinct
words that a shuffle partition has. A frequent word takes one entry for each block, not for
each occurrence, so no bucket is hot.

Null texts count as empty (no ids, the empty decoded text); rows of a repeated or
null doc_id are each encoded; extra columns are ignored; an empty table gives an
empty result. A text of any length is one row of one block; memory follows the longest text.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import clean_text, ship_texts, trimmed

#: Bytes of text in a block, at least one document.
BLOCK_BYTES = 32 << 20
#: Ids that are decoded and hashed at a time, at least one document.
CHUNK_IDS = 1 << 20
#: Entries of a worker's memory of pre-tokens; a full one starts anew.
CACHE_ENTRIES = 300_000
#: Fixed value: the splitter's pattern of the vocabulary file that this module supports.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Characters for which the short paths below equal the library (tests compare all of them):
#: below U+0180 NFC changes nothing and lower case stays below, but for U+0130.
SIMPLE_END = 0x180
_SIMPLE = re.compile("[\x00-\u012f\u0131-\u017f]*\\Z")
_encoders: dict[str, "WordEncoder"] = {}


def byte_letters() -> list[str]:
    """The letter for each byte: printable Latin-1 bytes stand for themselves, the others for U+0100 on."""
    same = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = iter(range(256, 512))
    return [chr(b) if b in same else chr(next(rest)) for b in range(256)]


def splitter(pattern: str):
    """findall of the splitter's pattern for lower-case lines of simple characters, by Python's re.

    The classes are written out; only the apostrophe starts two alternatives, kept in order. Line ends are found, too.
    """
    import regex

    if pattern != SPLIT_PATTERN:
        raise ValueError("this vocabulary file's splitter isn't supported")
    held = lambda which: "".join(re.escape(chr(c)) for c in range(SIMPLE_END) if regex.match(which, chr(c)))
    letters, numbers, spaces = held(r"\p{L}"), held(r"\p{N}"), held(r"\s")
    return re.compile(f"[{letters}]+|[{numbers}]|'(?:s|t|re|ve|m|ll|d)|[^{spaces}{letters}{numbers}]+|\n").findall


class Memo(dict):
    """Values by key, made on the first use; a full one of `room` entries starts anew."""

    def __init__(self, room: int, make: Callable[[str], bytes]):
        super().__init__()
        self.room, self.make = room, make

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)
        if len(self) >= self.room:
            self.clear()
        self[key] = value
        return value


class WordEncoder:
    """Packed little-endian ids of words, equal to the library's ids of the same text."""

    def __init__(self, vocabulary: str, cache_entries: int = CACHE_ENTRIES):
        from tokenizers import Tokenizer

        spec = json.loads(vocabulary)
        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        steps = spec["pre_tokenizer"]["pretokenizers"]
        if [n["type"] for n in spec["normalizer"]["normalizers"]] != ["NFC", "Replace", "Lowercase"] or [p["type"] for p in steps] != ["Split", "ByteLevel"]:
            raise ValueError("this vocabulary file's normaliser or splitter isn't supported")
        self.split = splitter(steps[0]["pattern"]["Regex"])
        self.opening = os.path.commonprefix([t["content"] for t in spec["added_tokens"]])
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or "(?!)").search
        self.letters = byte_letters()
        self.pieces = Memo(cache_entries, self._piece)

    def _piece(self, piece: str) -> bytes:
        """Ids of one pre-token, by the library's own merges; none of a line end, at least one of any other."""
        if piece == "\n":
            return b""
        if not (piece.isascii() and piece.isprintable()):
            piece = "".join(map(self.letters.__getitem__, piece.encode()))
        ids = [t.id for t in self.tokenizer.model.tokenize(piece)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def simple(self, text: str) -> bool:
        """Whether the short path holds for a text, or for the words of lines."""
        return bool(text.isascii() or _SIMPLE.match(text)) and not (self.opening in text and self.special(text))

    def words(self, words: list[str]) -> tuple[bytes, np.ndarray]:
        """Ids of words (texts without spaces and line ends), one after the other, and how many each has."""
        lines = "\n".join(words)
        if self.simple(lines):
            values = list(map(self.pieces.__getitem__, self.split(lines.lower())))
            counts = np.fromiter(map(len, values), np.int64, len(values)) // 4
            upto = np.concatenate([[0], np.cumsum(counts)])
            # only line ends have no ids: they part the words
            return b"".join(values), np.diff(upto[np.concatenate([[0], np.flatnonzero(counts == 0), [len(counts)]])])
        kept = [self.simple(w) for w in words]
        flat, lengths = self.words([w for w, k in zip(words, kept) if k]) if any(kept) else (b"", [])
        ends, at, parts = np.cumsum(lengths, dtype=np.int64) * 4, 0, []
        for w, k in zip(words, kept):
            if k:
                parts.append(flat[ends[at - 1] if at else 0 : ends[at]])
                at += 1
            else:
                ids = self.tokenizer.encode(w, add_special_tokens=False).ids
                parts.append(struct.pack(f"<{len(ids)}I", *ids))
        return b"".join(parts), np.fromiter(map(len, parts), np.int64, len(parts)) // 4

    def text(self, text: str) -> bytes:
        """Ids of a whole text: the words' ids, by position."""
        return self.words(text.replace("\n", " ").split(" "))[0]

    def batch(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text, each distinct word encoded once."""
        words, numbers, sizes = numbered(texts)
        flat, lengths = self.words(words.to_pylist())
        return list(placed(np.frombuffer(flat, "<u4"), lengths, numbers, sizes)) if len(texts) else []


def numbered(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of texts, the number of the word at each position, and the positions of each text."""
    parts = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
    words = parts.flatten().dictionary_encode()
    return words.dictionary, words.indices.to_numpy(), parts.value_lengths().to_numpy()


def placed(flat: np.ndarray, lengths: np.ndarray, numbers: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Ids of each text: those of its words by position; flat has the words' ids one after the other."""
    starts, done, ends = np.cumsum(lengths) - lengths, 0, np.cumsum(sizes)
    while done < len(sizes):
        base = int(ends[done - 1]) if done else 0
        last = max(done + 1, int(np.searchsorted(ends, base + CHUNK_IDS, side="right")))
        at = numbers[base : int(ends[last - 1])]
        n = lengths[at]
        upto = np.concatenate([[0], np.cumsum(n)])
        ids = flat[np.repeat(starts[at] - upto[:-1], n) + np.arange(upto[-1])]
        yield from np.split(ids, upto[ends[done : last - 1] - base])
        done = last


def encoder(vocabulary: str) -> WordEncoder:
    """One encoder for each worker process and vocabulary."""
    key = hashlib.sha256(vocabulary.encode()).hexdigest()
    if key not in _encoders:
        _encoders[key] = WordEncoder(vocabulary)
    return _encoders[key]


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as file:  # a vocabulary file, small and fixed
        return file.read()


def piece_table(vocabulary: str) -> list[str]:
    """Pieces by id, added tokens included."""
    spec = json.loads(vocabulary)
    by_id = {i: p for p, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    return [by_id.get(i, "") for i in range(max(by_id) + 1)]


def blocks(batches: Iterator[pa.RecordBatch], size: int, column: str = "_of_text") -> Iterator[pa.Table]:
    """The rows of batches in blocks: the next one starts where a block's texts have `size` bytes."""
    held, total = [], 0
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
        first = 0
        while first < len(batch):
            base = int(ends[first - 1]) if first else 0
            last = min(len(batch), int(np.searchsorted(ends, base + size - total)) + 1)
            held.append(batch.slice(first, last - first))
            total += int(ends[last - 1]) - base
            first = last
            if total >= size:
                yield pa.Table.from_batches(held).combine_chunks()
                held, total = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def planes(values: np.ndarray) -> bytes:
    """Unsigned 32-bit integers as planes of bytes, lowest first: small ones compress well."""
    return values.astype("<u4").view("u1").reshape(-1, 4).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "u1").reshape(4, -1).T.copy().view("<u4").reshape(-1).astype(np.int64)


#: Rows of the exchanges: a block's documents (bucket -1), the words it has in a bucket, or their ids.
ROWS = "block long, bucket int, doc_ids array<long>, sizes array<int>, data binary, owners binary"
_ROWS = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("data", pa.binary()), ("owners", pa.binary())])


def _split(buckets: int, block_bytes: int):
    """Cuts documents into blocks of numbered words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press = zstandard.ZstdCompressor(level=3).compress
        task = TaskContext.get().partitionId() << 32
        _encoders.clear()  # not needed here
        for k, table in enumerate(blocks(batches, block_bytes)):
            texts = table.column("_of_text").combine_chunks()
            texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
            words, numbers, sizes = numbered(texts)
            owners = np.fromiter((zlib.crc32(w.encode()) % buckets for w in words.to_pylist()), np.int64, len(words))
            order = np.argsort(owners, kind="stable")
            names, edges = words.take(pa.array(order)).to_pylist(), np.searchsorted(owners[order], np.arange(buckets + 1)).tolist()
            rows = [{"block": task + k, "bucket": -1, "doc_ids": table.column("doc_id").to_pylist(), "sizes": sizes, "data": press(planes(numbers)), "owners": press(planes(owners))}]
            for b, (first, last) in enumerate(zip(edges, edges[1:])):
                if first < last:
                    rows.append({"block": task + k, "bucket": b, "doc_ids": None, "sizes": None, "data": press("\n".join(names[first:last]).encode()), "owners": None})
            yield pa.RecordBatch.from_pylist(rows, _ROWS)

    return run


def _encode_words(vocabulary):
    """Turns the rows of words into rows of ids, each distinct word of a bucket encoded once; others pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        press, open_ = zstandard.ZstdCompressor(level=3).compress, zstandard.ZstdDecompressor().decompress
        tool, known = encoder(vocabulary.value), {}
        for batch in batches:
            is_words = np.asarray(batch.column("bucket")) >= 0
            made = []
            for words, data in zip(is_words, batch.column("data")):
                if not words:
                    made.append(data.as_py())
                    continue
                names = open_(data.as_py()).decode().split("\n")
                fresh = [name for name in names if name not in known]
                if fresh:
                    flat, lengths = tool.words(fresh)
                    ends = (np.cumsum(lengths) * 4).tolist()
                    known.update(zip(fresh, (flat[a:b] for a, b in zip([0, *ends], ends))))
                values = list(map(known.__getitem__, names))
                counts = np.fromiter(map(len, values), np.int64, len(values)) // 4
                made.append(press(struct.pack("<q", len(values)) + planes(counts) + planes(np.frombuffer(b"".join(values), "<u4"))))
            yield batch.set_column(4, "data", pa.array(made, pa.binary()))

    return run


def _join(vocabulary, digest: bool):
    """Joins a block's ids to its documents by position; rows come by block, the documents first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        open_ = zstandard.ZstdDecompressor().decompress
        pieces = pa.array(piece_table(vocabulary.value)) if digest else None
        _encoders.clear()  # not needed here
        block, held, ids = None, None, []
        for batch in batches:
            for row in range(len(batch)):
                now = batch.column("block")[row].as_py()
                if now != block:
                    if held:
                        yield from close(held, ids, pieces)
                    block, held, ids = now, None, []
                data = open_(batch.column("data")[row].as_py())
                if batch.column("bucket")[row].as_py() < 0:
                    sizes = np.asarray(batch.column("sizes")[row].values, np.int64)
                    held = batch.column("doc_ids")[row].values, sizes, from_planes(data), from_planes(open_(batch.column("owners")[row].as_py()))
                else:
                    (n,) = struct.unpack_from("<q", data)
                    ids.append((from_planes(data[8 : 8 + 4 * n]), from_planes(data[8 + 4 * n :])))
        if held:
            yield from close(held, ids, pieces)

    def close(held, ids, pieces) -> Iterator[pa.RecordBatch]:
        doc_ids, sizes, numbers, owners = held
        order = np.argsort(owners, kind="stable")
        counts = np.concatenate([c for c, _ in ids])
        flat = np.concatenate([x for _, x in ids]).astype("<u4")
        # the words came bucket by bucket; their ids stay there, and each number learns its place
        lengths, starts = np.empty(len(owners), np.int64), np.empty(len(owners), np.int64)
        lengths[order], starts[order] = counts, np.cumsum(counts) - counts
        by_number = flat[np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(len(flat))]
        rows, first, total = [], 0, 0
        for k, found in enumerate(placed(by_number, lengths, numbers, sizes)):
            rows.append(found)
            total += len(found)
            if total >= CHUNK_IDS or k + 1 == len(sizes):
                yield shown(doc_ids.slice(first, len(rows)), rows, pieces)
                rows, first, total = [], k + 1, 0

    def shown(doc_ids: pa.Array, rows: list[np.ndarray], pieces) -> pa.RecordBatch:
        counts = np.array([len(r) for r in rows], np.int64)
        flat = np.concatenate(rows)
        offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype("<i4"))
        lists = pa.ListArray.from_arrays(offsets, pa.array(flat.astype("<i4")))
        if not digest:
            return pa.RecordBatch.from_arrays([doc_ids, pa.array(counts), lists], ["doc_id", "n_tokens", "ids"])
        return pa.RecordBatch.from_arrays(
            [doc_ids, pa.array(counts), pa.array([hashlib.sha256(r.tobytes()).hexdigest() for r in rows]), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in joined(lists, pieces)])],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return run


def joined(lists: pa.ListArray, pieces: pa.Array) -> list[str]:
    """Decoded texts: each list's ids joined to their pieces, in order."""
    found = pa.ListArray.from_arrays(lists.offsets, pieces.take(lists.values))
    return pc.binary_join(found, " ").to_pylist()


def encode(spark: SparkSession, docs: DataFrame, vocabulary_path: str, digest: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_tokens and ids (array<int>); with digest also hashes of the ids and of their decoded text.

    digest=True gives doc_id, n_tokens, ids_sha256, decoded_sha256 and leaves the ids out.
    """
    ship_texts(spark)
    vocabulary = spark.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # blocks are numbered by task and place, so those of neighbouring tasks go to different partitions
    spread = F.pmod(F.shiftright("block", 32) + F.col("block").bitwiseAND((1 << 32) - 1) * 7919, F.lit(buckets)).cast("int")
    split, words, join = _split(buckets, block_bytes), _encode_words(vocabulary), _join(vocabulary, digest)
    rows = docs.select("doc_id", clean_text().alias("_of_text")).mapInArrow(lambda batches: trimmed(split(batches)), ROWS)
    rows = rows.repartitionById(buckets, F.when(F.col("bucket") >= 0, F.col("bucket")).otherwise(spread))
    rows = rows.mapInArrow(lambda batches: trimmed(words(batches)), ROWS).repartitionById(buckets, spread).sortWithinPartitions("block", "bucket")
    schema = "doc_id long, n_tokens long, " + ("ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>")
    return rows.mapInArrow(lambda batches: trimmed(join(batches)), schema)


def decode(spark: SparkSession, encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id and text of rows (doc_id, ids): ids joined to their pieces, by position.

    Null ids count as none; an id outside the vocabulary fails the job.
    """
    ship_texts(spark)
    source = spark.sparkContext.broadcast(piece_table(read_vocabulary(vocabulary_path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pa.array(source.value)
        for batch in batches:
            lists = pc.fill_null(batch.column("ids"), pa.scalar([], pa.list_(pa.int32())))
            flat = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype("<i4")), lists.flatten())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(joined(flat, pieces), pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
