"""Alignment of two tokenizers' tokens over the same bytes, by pointer jumping.

Every token points to the farthest-right token of the other sequence that overlaps it, if that one reaches further.
Doubling the pointers (each token takes its successor's successor) leads every token to the last token of its connected
component in a logarithm of the component's length: that last token names the group. Groups are the smallest stretches
both sequences cut alike; the two tokens at a group's end are linked, as their byte ranges end together.

Counts of linked id pairs are of the whole corpus, but no link is shuffled: tasks keep the links of a block of
documents in a file of the shared folder and send each of the block's distinct pairs once, with its number. What returns
to a block are its own pairs, with their counts.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import public_tokenizers

from batchkit.llm.files import load_table, new_name, save_table
from batchkit.session import land, scratch_path

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
PATTERN = public_tokenizers.PATTERN

BLOCK_BYTES = 8 << 20  # text of a block: bounds the memory of a task

_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def byte_alphabet() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable ones themselves, the others from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class ByteTokens:
    """A byte-level BPE vocabulary in the JSON format of the tokenizers library, special tokens left out.

    Its merges join the pair of the least new id first, so ids serve as ranks; the constructor checks that they do.
    """

    def __init__(self, path: str, pattern: str = PATTERN):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model, special = described["model"], {t["content"] for t in described.get("added_tokens", ())}
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        whole = all(bytes([b]) in ranks for b in range(256))  # so every text is given back
        if not whole or described.get("normalizer") or any(a >= b for a, b in zip(merged, merged[1:])):
            raise ValueError(f"{path} is not a plain byte-level vocabulary in the order of its merges")
        self.table = _by_id({i: t for t, i in ranks.items()})
        self._encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        return self._encoding.encode_to_numpy(" " + text, disallowed_special=())


class PieceTokens:
    """A sentencepiece model; it adds the leading space itself."""

    def __init__(self, path: str):
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = {i: self._model.id_to_piece(i) for i in range(self._model.get_piece_size())}
        self.table = _by_id({i: self._bytes(p) for i, p in pieces.items()})

    @staticmethod
    def _bytes(piece: str) -> bytes:
        found = _BYTE_PIECE.fullmatch(piece)
        return bytes([int(found[1], 16)]) if found else piece.replace("▁", " ").encode()

    def encode(self, text: str) -> list[int]:
        return self._model.encode(text)


def _by_id(tokens: dict[int, bytes]) -> list[bytes]:
    return [tokens.get(i, b"") for i in range(max(tokens) + 1)]


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """Per token, A's first and B's after them, the last token of its component.

    A token points to the other sequence's token that holds its last byte: of all that overlap it, the one farthest
    right. The pointer stays at home where that token reaches no further; of two that end together, B's is the last.
    """
    n = len(ends_a)
    over_a = n + np.searchsorted(ends_b, ends_a)
    over_b = np.searchsorted(ends_a, ends_b)
    own_b = n + np.arange(len(ends_b))
    successor = np.concatenate([over_a, np.where(ends_a[over_b] > ends_b, over_b, own_b)])
    while True:
        further = successor[successor]
        if np.array_equal(further, successor):
            return successor
        successor = further


class Aligner:
    """Aligns texts; holds both vocabularies and the parts from which a group's description is put together."""

    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.b = ByteTokens(byte_path), PieceTokens(piece_path)
        self.sizes = [np.fromiter(map(len, t.table), np.int64, len(t.table)) for t in (self.a, self.b)]
        names = [[str(i) for i in range(len(t.table))] for t in (self.a, self.b)]
        parts = [f"{i}{mark}" for own, marks in zip(names, (",|", ",;")) for mark in marks for i in own]
        self.parts = np.array(parts, object)

    def groups(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, str]:
        """The linked pairs, one per group (A's id in the high half), and the groups' description."""
        label = terminals(np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b]))
        label_a, label_b = label[: len(a)], label[len(a) :]
        last_a = np.append(label_a[1:] != label_a[:-1], True)
        last_b = np.append(label_b[1:] != label_b[:-1], True)
        links = a[last_a] << 32 | b[last_b]
        n_a, n_b = len(self.sizes[0]), len(self.sizes[1])
        codes = np.concatenate([a + n_a * last_a, b + 2 * n_a + n_b * last_b])
        order = np.argsort(np.concatenate([label_a * 2, label_b * 2 + 1]), kind="stable")
        return links, "".join(self.parts[codes[order]].tolist())[:-1]

    def align(self, text: str) -> tuple[int, int, np.ndarray, str]:
        """The numbers of A's and B's tokens, the links, the groups as text."""
        ids = self.b.encode(text) if text else []
        whole = (" " + text).encode()
        if not text or b"".join(map(self.b.table.__getitem__, ids)) != whole:
            return 0, 0, np.empty(0, np.int64), ""
        a, b = self.a.encode(text).astype(np.int64), np.array(ids, np.int64)
        return len(a), len(b), *self.groups(a, b)


@lru_cache(maxsize=2)
def aligner(byte_path: str, piece_path: str) -> Aligner:
    return Aligner(byte_path, piece_path)


_FACTS = ("id", "n_a", "n_b", "n_groups", "groups_sha256", "groups")


def align_blocks(
    docs: DataFrame, id_col: str, text_col: str, byte_path: str, piece_path: str, block_bytes: int, keep_groups: bool
) -> DataFrame:
    """Rows (block, path) of the files with documents and links, rows (block, pair, n) of each block's distinct pairs."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    folder = scratch_path(docs.sparkSession, "aligned")

    def saved(ids: list, found: list, kind: pa.DataType, block: int) -> pa.RecordBatch:
        n_a, n_b, links, digests, groups = zip(*found)
        counts = np.fromiter(map(len, links), np.int64, len(links))
        pairs, places, n = np.unique(np.concatenate(links), return_inverse=True, return_counts=True)
        ends = np.concatenate([[0], np.cumsum(counts)])
        path = new_name(folder, ".arrow")
        columns = [
            pa.array(ids, kind), pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()), pa.array(counts),
            pa.array(digests), pa.array(groups, pa.large_string()), pa.LargeListArray.from_arrays(pa.array(ends), pa.array(places.astype(np.uint32))),
        ]
        save_table(path, pa.table(columns, names=[*_FACTS, "links"]))
        return pa.record_batch(
            [pa.array(np.full(len(pairs) + 1, block)), pa.array([path] + [None] * len(pairs), pa.string()),
             pa.array([None, *pairs.tolist()], pa.int64()), pa.array([None, *n.tolist()], pa.int64())],
            names=["block", "path", "pair", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, found, size, kind = TaskContext.get().partitionId() << 32, [], [], 0, pa.null()
        engine = aligner(byte_path, piece_path)
        for batch in batches:
            kind = batch.schema.field("id").type
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                text = text.as_py()
                ids.append(doc_id)
                *counts, links, groups = engine.align(text)
                digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
                found.append((*counts, links, digest, groups if keep_groups else None))
                size += len(text.encode())
                if size >= block_bytes:
                    yield saved(ids, found, kind, block)
                    block, ids, found, size = block + 1, [], [], 0
        if ids:
            yield saved(ids, found, kind, block)

    return rows.mapInArrow(run, "block bigint, path string, pair bigint, n bigint")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """Per pair its corpus-wide count and whether that is the highest of its B id."""
    counted = pairs.groupBy("pair").agg(F.sum("n").alias("count"))
    piece = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("piece")
    counted = counted.select("pair", "count", piece)
    highest = counted.groupBy("piece").agg(F.max("count").alias("highest"))
    return counted.join(highest, "piece").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def align_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    byte_path: str = BYTE_VOCABULARY,
    piece_path: str = PIECE_MODEL,
    block_bytes: int = BLOCK_BYTES,
    keep_groups: bool = False,
) -> DataFrame:
    """Per row: id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``; with
    ``keep_groups`` also ``groups``, the alignment as text (``a1,a2|b1;a3|b2,b3``).

    ``count_sum`` adds over the row's links how often the corpus links their two ids; ``n_best`` is how many of them
    link a B id with its most frequent partner, ties included. A null or empty text, and one whose bytes either
    tokenizer does not give back, has no tokens: zeros and an empty digest. Rows that repeat an id, and null ids, are
    rows of their own. Other columns are not read, so their names cannot clash. An empty table gives no rows. A task
    holds one block of documents, or one document if that is longer; a frequent pair has one row per block.
    """
    blocks = land(align_blocks(docs, id_col, text_col, byte_path, piece_path, block_bytes, keep_groups), "aligned-blocks")
    pairs = blocks.filter(F.col("pair").isNotNull()).select("block", "pair", "n")
    known = pairs.select("block", "pair").join(pair_counts(pairs), "pair")
    files = blocks.filter(F.col("path").isNotNull()).select("block", "path")
    both = files.unionByName(known, allowMissingColumns=True)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        path = table.column("path").drop_null()[0].as_py()
        table = table.filter(table.column("pair").is_valid()).sort_by("pair")
        count, best = table.column("count").to_numpy(), table.column("best").to_numpy().astype(np.int64)
        own = load_table(path).combine_chunks()
        links = own.column("links").combine_chunks()
        places, ends = links.values.to_numpy(), links.offsets.to_numpy()
        sums = [np.diff(np.concatenate([[0], np.cumsum(x[places])])[ends]) for x in (best, count)]
        facts = [own.column(c) for c in _FACTS]
        columns = [*facts[:4], facts[3], pa.array(sums[0], pa.int64()), pa.array(sums[1], pa.int64()), facts[4]]
        names = [id_col, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        if keep_groups:
            columns, names = [*columns, facts[5].cast(pa.string())], [*names, "groups"]
        return pa.table(columns, names=names)

    schema = f"`{id_col}` {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
    schema += "groups_sha256 string" + (", groups string" if keep_groups else "")
    return both.groupBy("block").applyInArrow(run, schema)
