"""Byte-level BPE over the distinct words of the corpus: encode each once, join the ids back, reassemble by position.

Texts are split by the vocabulary's pattern. A block of documents turns into the list of its distinct words and, per
document, the sequence of their positions in that list. The words are exploded and shuffled over the whole corpus, in
buckets by hash: each distinct word is encoded once. Its ids return to every block that has it, where the sequences
are filled in. Words, positions and ids travel packed, many to a row, so the text itself is never shuffled.

Words and sequences go through one exchange: a word row's ``key`` is its bucket as a negative number, a document row's
is its block. Both consumers take all columns and pick their rows themselves, so Spark reuses that exchange and splits
every text once.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import public_tokenizers

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN

BLOCK_BYTES = 16 << 20  # text of a block: bounds the memory of a task
CHUNK_BYTES = 1 << 20  # text whose positions share a row
BUCKET_BYTES = 4 << 20  # text per bucket of words
LEAST_BUCKETS = 64

# No piece of the pattern goes from a character that is not white space to one that is, so texts may be cut there.
_SPACED = re.compile(r"\s*\S+|\s+")
# White space to this module, but not to every engine of patterns.
_SEPARATORS = re.compile("[\x1c-\x1f]")


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})


@lru_cache(maxsize=4)
def token_bytes(path: str) -> dict[int, bytes]:
    """The token-byte table: what each id stands for."""
    return {rank: token for token, rank in load_ranks(path).items()}


def _pack(array: np.ndarray) -> bytes:
    """Whole numbers below 2**32 as three byte planes, compressed."""
    low, high = (array & 0xFFFF).astype("<u2"), (array >> 16).astype("<u2")
    return zstandard.ZstdCompressor(level=1).compress(low.tobytes() + high.tobytes())


def _unpack(data: bytes) -> np.ndarray:
    both = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<u2").astype(np.int64)
    half = len(both) // 2
    return both[:half] | both[half:] << 16


class Block:
    """Documents of one task: distinct words in order of first appearance, and positions in that order."""

    def __init__(self, pattern: str):
        self.find = regex.compile(pattern).findall
        self.words: dict[str, int] = {}
        self.spaced: dict[str, list[int]] = {}
        self.documents: list[tuple[object, np.ndarray, int]] = []
        self.size = 0

    def add(self, doc_id, text: str) -> None:
        parts = [text] if _SEPARATORS.search(text) else _SPACED.findall(text)
        spaced, words = self.spaced, self.words
        for part in set(parts).difference(spaced):
            spaced[part] = [words.setdefault(word, len(words)) for word in self.find(part)]
        places = np.fromiter((place for part in parts for place in spaced[part]), np.int64)
        n_bytes = len(text.encode())
        self.documents.append((doc_id, places, n_bytes))
        self.size += n_bytes

    def rows(self, block: int, buckets: int) -> Iterator[dict]:
        """Word rows of each bucket and document rows; words are renumbered by frequency, which packs best."""
        everything = np.concatenate([places for _, places, _ in self.documents] or [np.empty(0, np.int64)])
        order = np.argsort(-np.bincount(everything, minlength=len(self.words)), kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        data = [word.encode() for word in self.words]
        bucket = np.fromiter((zlib.crc32(word) % buckets for word in data), np.int64, len(data))
        by_bucket = np.lexsort((rank, bucket))
        for part in np.split(by_bucket, np.flatnonzero(np.diff(bucket[by_bucket])) + 1):
            if len(part):
                words = [data[i] for i in part]
                lengths = np.fromiter(map(len, words), np.int64, len(words))
                packed = zstandard.ZstdCompressor(level=1).compress(b"".join(words))
                yield {
                    "key": -1 - int(bucket[part[0]]), "block": block, "places": _pack(np.diff(rank[part], prepend=0)),
                    "lengths": _pack(lengths), "data": packed,
                }
        ids, counts, places, size = [], [], [], 0
        for doc_id, own, n_bytes in self.documents:
            ids.append(doc_id)
            counts.append(len(own))
            places.append(rank[own])
            size += n_bytes
            if size >= CHUNK_BYTES:
                yield {"key": block, "block": block, "ids": ids, "counts": counts, "places": _pack(np.concatenate(places))}
                ids, counts, places, size = [], [], [], 0
        if ids:
            yield {"key": block, "block": block, "ids": ids, "counts": counts, "places": _pack(np.concatenate(places))}


def split_blocks(docs: DataFrame, id_col: str, text_col: str, pattern: str, buckets: int, block_bytes: int) -> DataFrame:
    """Rows of words (``key`` below 0) and of documents, with the block they are from."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, n = TaskContext.get().partitionId() << 32, 0
        block, schema = Block(pattern), None

        def made() -> Iterable[pa.RecordBatch]:
            for row in block.rows(first + n, buckets):
                yield pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            if schema is None:
                schema = pa.schema(
                    [("key", pa.int64()), ("block", pa.int64()), ("ids", pa.list_(batch.schema.field("id").type)),
                     ("counts", pa.list_(pa.int32())), ("places", pa.binary()), ("lengths", pa.binary()), ("data", pa.binary())]
                )
            for doc_id, text in zip(batch.column("id"), batch.column("text")):
                block.add(doc_id.as_py(), text.as_py())
                if block.size >= block_bytes:
                    yield from made()
                    block, n = Block(pattern), n + 1
        if block.documents:
            yield from made()

    return rows.mapInArrow(
        run, f"key bigint, block bigint, ids array<{kind}>, counts array<int>, places binary, lengths binary, data binary"
    )


def _cut(data: bytes, lengths: np.ndarray) -> list[bytes]:
    ends = np.cumsum(lengths).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def encode_words(split: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per word row its ids: each distinct word of a bucket is encoded once, whatever the number of blocks it is in."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        if key[0].as_py() >= 0:
            table = table.slice(0, 0)
        encode = encoding(path, pattern)._encode_single_piece
        known: dict[bytes, list[int]] = {}
        counts, ids = [], []
        for lengths, data in zip(table.column("lengths"), table.column("data")):
            words = _cut(zstandard.ZstdDecompressor().decompress(data.as_py()), _unpack(lengths.as_py()))
            for word in words:
                if word not in known:
                    known[word] = encode(word)
            found = [known[word] for word in words]
            counts.append(_pack(np.fromiter(map(len, found), np.int64, len(found))))
            ids.append(_pack(np.fromiter((i for word in found for i in word), np.int64)))
        return pa.table(
            [table.column("block"), table.column("places"), pa.array(counts, pa.binary()), pa.array(ids, pa.binary())],
            names=["block", "places", "counts", "ids"],
        )

    return split.groupBy("key").applyInArrow(run, "block bigint, places binary, counts binary, ids binary")


class _Filled:
    """The words of a block with their ids and bytes, by position."""

    def __init__(self, encoded: pa.Table, table: dict[int, bytes]):
        places, counts, ids = [], [], []
        for own, count, part in zip(encoded.column("places"), encoded.column("counts"), encoded.column("ids")):
            places.append(np.cumsum(_unpack(own.as_py())))
            counts.append(_unpack(count.as_py()))
            ids.append(_unpack(part.as_py()))
        none = [np.empty(0, np.int64)]
        place, count = np.concatenate(places or none), np.concatenate(counts or none)
        self.ids = np.concatenate(ids or none)
        self.starts, self.counts = np.zeros_like(count), np.zeros_like(count)
        self.starts[place], self.counts[place] = np.cumsum(count) - count, count
        pieces = [table[i] for i in self.ids.tolist()]
        ends = (self.starts + self.counts).tolist()
        self.bytes = [b"".join(pieces[a:b]) for a, b in zip(self.starts.tolist(), ends)]

    def sequence(self, places: np.ndarray) -> np.ndarray:
        """The ids of a sequence of words."""
        counts = self.counts[places]
        shift = self.starts[places] - (np.cumsum(counts) - counts)
        return self.ids[np.repeat(shift, counts) + np.arange(counts.sum())]

    def decoded(self, places: np.ndarray) -> bytes:
        return b"".join(map(self.bytes.__getitem__, places.tolist()))


def reassemble(split: DataFrame, encoded: DataFrame, path: str, id_col: str, keep_ids: bool) -> DataFrame:
    """Each block's documents, filled with the ids of its words by position, and decoded again."""
    kind = split.schema["ids"].dataType.elementType.simpleString()

    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            left = left.slice(0, 0)
        block = _Filled(right, token_bytes(path))
        ids, sizes, digests, texts, kept = [], [], [], [], []
        for own, counts, places in zip(left.column("ids"), left.column("counts"), left.column("places")):
            ends = np.cumsum(counts.as_py())[:-1]
            ids.extend(own.as_py())
            for part in np.split(_unpack(places.as_py()), ends):
                found = block.sequence(part)
                sizes.append(len(found))
                digests.append(hashlib.sha256(found.astype("<u4").tobytes()).hexdigest())
                texts.append(hashlib.sha256(block.decoded(part)).hexdigest())
                if keep_ids:
                    kept.append(found.astype(np.int32))
        columns = [
            pa.array(ids, left.schema.field("ids").type.value_type),
            pa.array(sizes, pa.int64()),
            pa.array(digests, pa.string()),
            pa.array(texts, pa.string()),
        ]
        names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
        if keep_ids:
            columns.append(pa.array(kept, pa.list_(pa.int32())))
            names.append("ids")
        return pa.table(columns, names=names)

    schema = f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" if keep_ids else ""
    return split.groupBy("key").cogroup(encoded.groupBy("block")).applyInArrow(run, schema)


def encode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str = RANKS,
    pattern: str = PATTERN,
    keep_ids: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per row: id, ``n_tokens``, ``ids_sha256`` (ids as little-endian 32-bit numbers), ``decoded_sha256``; with
    ``keep_ids`` the ids too.

    A null or empty text has no tokens. Rows that repeat an id, and null ids, are rows of their own. Other columns are
    not read. An empty table gives no rows. A task holds one block of documents, or one document if that is longer.
    """
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text_col}`")))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, size // BUCKET_BYTES)
    split = split_blocks(docs, id_col, text_col, pattern, buckets, block_bytes).repartition("key")
    return reassemble(split, encode_words(split, path, pattern), path, id_col, keep_ids)
