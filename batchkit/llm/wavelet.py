"""Token ids in shards of wavelet matrices: one file per shard with access, counting and occurrence lookup.

A wavelet matrix has a plane of bits for each bit of an id, the highest first. Each plane sorts the sequence, stably, by
its bit: zeros first. Ranks of the planes lead from a position to its id and from an id to its positions. A shard file
holds the planes, each compressed and with counts of ones at fixed steps, and the documents' ids and ends.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tokenizers
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

import public_tokenizers

from batchkit.llm.files import created, new_name, opened
from batchkit.session import land, scratch_path

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
SHARD_TOKENS = 4 << 20
STEP = 512  # bits between stored counts
MAGIC = b"WVMATRX1"
CACHED_WORDS = 1 << 20
CACHED_CHARS = 64  # longer words are not kept
JOINED_WORDS = 4096  # words encoded in one call
CALL_BYTES = 8 << 20  # texts that are cut and looked up together

# The tokenizer cuts at white space, and between a letter and an ASCII symbol. Only Latin letters are cut off: normalising
# or lower case turns some others, and the dotted capital I, into a letter and a mark.
_LETTERS = "[A-Za-zÀ-ÖØ-öø-įı-ɏ]+"
_BEFORE_SYMBOL = rf"^({_LETTERS})([!-/:-@\[-`{{-~])"
_ONE_UNIT = rf"^{_LETTERS}$"


class WaveletMatrix:
    """A sequence of whole numbers below ``2 ** bits``."""

    def __init__(self, size: int, planes: list[np.ndarray], zeros: list[int], counts: list[np.ndarray]):
        self.size, self.planes, self.zeros, self.counts = size, planes, zeros, counts

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        planes, zeros, counts = [], [], []
        for bit in reversed(range(bits)):
            ones = (ids & ids.dtype.type(1 << bit)) != 0
            planes.append(np.packbits(ones, bitorder="little"))
            steps = np.bitwise_count(np.pad(planes[-1], (0, -len(planes[-1]) % (STEP // 8))).view(np.uint64)).reshape(-1, STEP // 64)
            counts.append(np.concatenate([[0], np.cumsum(steps.sum(axis=1, dtype=np.int64))]))
            # Taking by place is faster than by a mask of mixed bits.
            left = ids.take(np.flatnonzero(~ones))
            zeros.append(len(left))
            ids = np.concatenate([left, ids.take(np.flatnonzero(ones))])
        return cls(len(ids), planes, zeros, counts)

    def ids(self, kind=np.int64) -> np.ndarray:
        """The whole sequence: the planes' sortings undone, the last first."""
        values = np.zeros(self.size, kind)
        for bit, (plane, zeros) in enumerate(zip(reversed(self.planes), reversed(self.zeros))):
            ones = np.unpackbits(plane, count=self.size, bitorder="little").astype(bool)
            merged = np.empty_like(values)
            merged[~ones] = values[:zeros]
            merged[ones] = values[zeros:] | kind(1 << bit)
            values = merged
        return values

    def _ones(self, level: int, position: int) -> int:
        """Ones of a plane before the position."""
        step = position // STEP
        part = np.unpackbits(self.planes[level][step * STEP // 8 : (position + 7) // 8], bitorder="little")
        return int(self.counts[level][step]) + int(part[: position - step * STEP].sum())

    def _bit(self, level: int, position: int) -> int:
        return int(self.planes[level][position >> 3]) >> (position & 7) & 1

    def access(self, position: int) -> int:
        """The id at a position."""
        value = 0
        for level, zeros in enumerate(self.zeros):
            bit, ones = self._bit(level, position), self._ones(level, position)
            value = value << 1 | bit
            position = zeros + ones if bit else position - ones
        return value

    def _range(self, value: int, start: int, end: int) -> tuple[int, int]:
        """Where the value's occurrences in [start, end) stand after the last sorting."""
        for level, zeros in enumerate(self.zeros):
            before, within = self._ones(level, start), self._ones(level, end)
            if value >> len(self.zeros) - 1 - level & 1:
                start, end = zeros + before, zeros + within
            else:
                start, end = start - before, end - within
        return start, end

    def rank(self, value: int, end: int) -> int:
        """Occurrences of the value before the position."""
        start, end = self._range(value, 0, end)
        return end - start

    def select(self, value: int, nth: int) -> int:
        """The position of the nth occurrence, from 0; IndexError if there are fewer."""
        start, end = self._range(value, 0, self.size)
        if not 0 <= nth < end - start:
            raise IndexError(nth)
        position = start + nth
        for level in reversed(range(len(self.zeros))):
            wanted = position - self.zeros[level] if position >= self.zeros[level] else position
            position = self._find(level, wanted, position >= self.zeros[level])
        return position

    def _find(self, level: int, nth: int, ones: bool) -> int:
        """The position of the nth one, or zero, of a plane."""
        low, high = 0, self.size
        while high - low > 1:
            middle = (low + high) // 2
            before = self._ones(level, middle)
            if (before if ones else middle - before) <= nth:
                low = middle
            else:
                high = middle
        return low

    def occurrences(self, value: int) -> list[int]:
        return [self.select(value, i) for i in range(self.rank(value, self.size))]


def write_shard(stream, doc_ids: list, ends: np.ndarray, ids: np.ndarray, bits: int) -> None:
    """Header with JSON facts, then the parts it lists, each compressed on its own."""
    matrix = WaveletMatrix.build(ids, bits)
    compress = zstandard.ZstdCompressor(level=1).compress
    parts = [compress(json.dumps(doc_ids).encode()), compress(ends.astype("<i8").tobytes())]
    for plane, counts in zip(matrix.planes, matrix.counts):
        parts += [compress(plane.tobytes()), compress(counts.astype("<i8").tobytes())]
    facts = json.dumps({"size": matrix.size, "zeros": matrix.zeros, "parts": [len(p) for p in parts]}).encode()
    stream.write(MAGIC + struct.pack("<I", len(facts)) + facts)
    for part in parts:
        stream.write(part)


def read_shard(stream) -> tuple[list, np.ndarray, WaveletMatrix]:
    """Document ids, their ends, and the matrix of a shard file."""
    if stream.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a shard of token ids")
    facts = json.loads(stream.read(struct.unpack("<I", stream.read(4))[0]))
    inflate = zstandard.ZstdDecompressor().decompress
    parts = [inflate(stream.read(n)) for n in facts["parts"]]
    planes = [np.frombuffer(p, np.uint8) for p in parts[2::2]]
    counts = [np.frombuffer(p, "<i8") for p in parts[3::2]]
    return json.loads(parts[0]), np.frombuffer(parts[1], "<i8"), WaveletMatrix(facts["size"], planes, facts["zeros"], counts)


@lru_cache(maxsize=2)
def load_tokenizer(path: str) -> tokenizers.Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return tokenizers.Tokenizer.from_file(path)


def _spans(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The spans of an array one after the other."""
    ends = np.cumsum(sizes)
    shifts = np.repeat(starts - ends + sizes, sizes)
    shifts += np.arange(len(shifts))
    return data[shifts]


def _strings(names: pa.Array) -> list[str]:
    return names.to_numpy(zero_copy_only=False).tolist()


class WordEncoder:
    """Encodes texts word by word, words part by part. Different words are cut and looked up once per call; parts are
    kept, up to ``CACHED_WORDS`` of them, as spans of one array of ids.

    Special tokens inside a text contain no space and begin with a symbol: a part begins there if a letter comes before
    them, and they stay within a part otherwise.
    """

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        vocabulary = self.tokenizer.get_vocab()
        self.kind = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self.word_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.word_end[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        """Part 0 is empty; ``ends`` has one number more than there are parts."""
        self.known: dict[str, int] = {"": 0}
        self.ids, self.ends = np.zeros(0, self.kind), np.zeros(2, np.int64)

    def __call__(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not len(texts):
            return []
        words = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = pc.dictionary_encode(words.flatten())
        # Letters before a symbol are a part, the symbol and what follows another.
        pieces = pc.split_pattern(pc.replace_substring_regex(coded.dictionary, _BEFORE_SYMBOL, r"\1 \2"), " ")
        parts = pc.dictionary_encode(pieces.flatten())
        numbers = self._numbers(parts.dictionary)[parts.indices.to_numpy()]
        # Ids of the different words, then of all words in their order.
        starts, ends = self.ends[numbers], self.ends[numbers + 1]
        of_words = _spans(self.ids, starts, ends - starts)
        firsts = pieces.offsets.to_numpy() - pieces.offsets[0].as_py()
        sizes = np.add.reduceat(ends - starts, firsts[:-1])
        word = coded.indices.to_numpy()
        result = _spans(of_words, (np.cumsum(sizes) - sizes)[word], sizes[word])
        reached = np.concatenate([[0], np.cumsum(sizes[word])])
        cuts = reached[words.offsets.to_numpy() - words.offsets[0].as_py()].tolist()
        if len(self.known) > CACHED_WORDS or len(self.ids) > 16 * CACHED_WORDS:
            self._forget()
        return [result[a:b] for a, b in zip(cuts, cuts[1:])]

    def _numbers(self, parts: pa.Array) -> np.ndarray:
        """Where the parts are kept; new ones are encoded."""
        names = _strings(parts)
        numbers = self._find(names)
        missing = np.flatnonzero(numbers < 0)
        if len(missing):
            fresh = parts.take(pa.array(missing))
            # Latin letters are one unit of the tokenizer in any surroundings; upper case makes no difference.
            plain = pc.match_substring_regex(fresh, _ONE_UNIT).to_numpy(zero_copy_only=False)
            units = pc.dictionary_encode(pc.utf8_lower(fresh.filter(pa.array(plain))))
            lower, rest = _strings(units.dictionary), _strings(fresh.filter(pa.array(~plain)))
            of_units = self._find(lower)
            unknown = np.flatnonzero(of_units < 0)
            of_units[unknown] = self._keep([lower[i] for i in unknown.tolist()], self._joined)
            found = np.empty(len(missing), np.int64)
            found[plain] = of_units[units.indices.to_numpy()]
            found[~plain] = self._keep(rest, self._alone)
            numbers[missing] = found
            fresh = [names[i] for i in missing.tolist()]
            self.known.update(zip(fresh, found.tolist()))
            for name in [name for name in fresh if len(name) > CACHED_CHARS]:
                for kept in {name, *_strings(pc.utf8_lower(pa.array([name])))}:
                    self.known.pop(kept, None)
        return numbers

    def _find(self, names: list[str]) -> np.ndarray:
        return np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))

    def _keep(self, names: list[str], encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Numbers of new names."""
        first, ids, ends = len(self.ends) - 1, [self.ids], [self.ends]
        reached = len(self.ids)
        for start in range(0, len(names), JOINED_WORDS):
            found, cuts = encode(names[start : start + JOINED_WORDS])
            ids.append(found)
            ends.append(reached + cuts)
            reached += len(found)
        self.ids, self.ends = np.concatenate(ids), np.concatenate(ends)
        self.known.update(zip(names, range(first, first + len(names))))
        return np.arange(first, first + len(names))

    def _joined(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of names that are units, and where each ends."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(names)], add_special_tokens=False)[0].ids, self.kind)
        ends = np.flatnonzero(self.word_end[ids]) + 1
        return (ids, ends) if len(ends) == len(names) else self._alone(names)

    def _alone(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for any names."""
        found = [encoded.ids for encoded in self.tokenizer.encode_batch_fast(names, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(found), self.kind)
        return ids, np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """One per Python worker: its tasks share the words."""
    return WordEncoder(path)


def write_shards(
    docs: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str = TOKENIZER,
    end_id: int = END_ID,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Write the ids of all documents in ascending id order; one row per shard: its place in that order, file, size.

    Texts are range partitioned by id and sorted, so shard after shard follows the order. Every attempt of a task
    writes files of its own and only those of finished tasks are listed. Null ids come first; rows that repeat an id
    stand together, ordered by a hash of the text. A null or empty text has the end id alone. An empty table has no
    shards. A document is never split; one longer than ``shard_tokens`` makes a shard of its own size.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text")).withColumn("order", F.xxhash64("text"))
    # Ranges are cut by the text too, so that rows without an id, or with one that repeats, go to several tasks.
    rows = rows.repartitionByRange("id", "order").sortWithinPartitions("id", "order").select("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(path)
        bits = max(encode.tokenizer.get_vocab_size() - 1, end_id, 1).bit_length()
        kind = np.uint16 if bits <= 16 else np.uint32
        partition, turn = TaskContext.get().partitionId(), 0
        ids, sequences, size = [], [], 0

        def shard() -> pa.RecordBatch:
            file = new_name(folder, ".wvm")
            ends = np.cumsum([len(s) for s in sequences])
            with created(file) as stream:
                write_shard(stream, ids, ends, np.concatenate(sequences), bits)
            return pa.RecordBatch.from_pydict(
                {"partition": [partition], "turn": [turn], "file": [file], "n_tokens": [int(ends[-1])], "n_docs": [len(ids)]}
            )

        for batch in batches:
            texts, own = batch.column("text"), batch.column("id").to_pylist()
            reached = np.cumsum(pc.binary_length(texts).to_numpy())
            start = 0
            while start < len(own):
                # Up to CALL_BYTES of texts, one at least.
                before = int(reached[start - 1]) if start else 0
                end = max(start + 1, int(np.searchsorted(reached, before + CALL_BYTES, "right")))
                for doc_id, found in zip(own[start:end], encode(texts.slice(start, end - start))):
                    ids.append(doc_id)
                    sequences.append(np.append(found, end_id).astype(kind))
                    size += len(sequences[-1])
                    if size >= shard_tokens:
                        yield shard()
                        ids, sequences, size, turn = [], [], 0, turn + 1
                start = end
        if ids:
            yield shard()

    return rows.mapInArrow(run, "partition bigint, turn bigint, file string, n_tokens bigint, n_docs bigint")


def with_starts(shards: DataFrame) -> DataFrame:
    """``start``: ids in all shards before. One window runs over a row per partition, another inside each."""
    before = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    totals = shards.groupBy("partition").agg(F.sum("n_tokens").alias("n"))
    totals = totals.select("partition", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("partition").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return placed.join(totals, "partition").withColumn("start", F.col("first") + F.col("inside")).drop("first", "inside")


def read_documents(shards: DataFrame, id_type: str = "bigint", id_col: str = "doc_id") -> DataFrame:
    """Per document, from the files: id, ``start``, ``n_tokens``, ``ids_crc32`` of the ids as little-endian 32 bits."""
    count = shards.count()
    # As many tasks as shards, dealt by a hash; files are listed by row, so a task opens its own only.
    rows = shards.select("file", "start").repartition(max(1, count), "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, first in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                with opened(file) as stream:
                    doc_ids, ends, matrix = read_shard(stream)
                ids = matrix.ids(np.uint16 if len(matrix.zeros) <= 16 else np.int64).astype("<u4")
                starts = np.concatenate([[0], ends[:-1]])
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, kind), pa.array(first + starts), pa.array(ends - starts), pa.array(crcs, pa.int64())],
                    names=[id_col, "start", "n_tokens", "ids_crc32"],
                )

    kind = pa.string() if id_type == "string" else pa.int64()
    return rows.mapInArrow(run, f"`{id_col}` {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Write all documents and read them back. Ids are whole numbers (bigint) or texts."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-ids")
    shards = land(write_shards(docs, folder, id_col, text_col, **options), "shards")
    return read_documents(with_starts(shards), docs.schema[id_col].dataType.simpleString(), id_col)
