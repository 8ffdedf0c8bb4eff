"""Lexical search of all documents for a set of items, by classes of documents that no item can tell apart.

Only a document's terms among the items' terms, with their frequencies, and its length measure ``m`` enter a score. So
documents are reduced to such bags, equal bags with equal ``m`` form a class (found by a hash, told apart by the bags
themselves), each class is scored once, and only the best classes of an item are expanded, by ascending id: the best
``top`` documents are members of the ``top`` classes that come first by score and smallest id.

Items are taken in blocks of bounded size. A block's terms and weights go to every task; tasks keep the best classes
per item of their share, which combine by item. A class with a great part of all rows is one row after the map side's
combination, and of its members each task passes on ``top`` at most.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from batchkit.session import land

TOP = 20
BLOCK_TERMS = 1 << 18  # terms of items, distinct within an item, in a block: bounds what goes to every task
BROADCAST_BYTES = 64 << 20
SCORES = 1 << 20  # scores a task holds at a time

# ASCII letters, in lower case, and digits stay, as do all bytes of other characters.
_TERMS = bytes(ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERMS).split(b" ") if text else []


def count_terms(text: bytes) -> tuple[int, Counter]:
    """The number of terms and how often each is in the text."""
    counts = Counter(terms_of(text))
    counts.pop(b"", None)
    return counts.total(), counts


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    return df.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_terms: int) -> Iterator[list[tuple[object, Counter]]]:
    """(id, counts of terms) of the items, as many at a time as have ``block_terms`` terms, or one that has more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [count_terms(text.as_py())[1] for text in batch.column("text")]
            yield pa.record_batch(
                [batch.column("id"), pa.array([list(c) for c in counts], pa.list_(pa.binary())),
                 pa.array([list(c.values()) for c in counts], pa.list_(pa.int64()))],
                names=["id", "terms", "counts"],
            )

    kind = items.schema[id_col].dataType.simpleString()
    rows = _texts(items, id_col, text_col).mapInArrow(run, f"id {kind}, terms array<binary>, counts array<bigint>")
    block, size = [], 0
    for row in rows.toLocalIterator():
        if block and size + len(row.terms) > block_terms:
            yield block
            block, size = [], 0
        block.append((row.id, dict(zip(map(bytes, row.terms), row.counts))))
        size += len(row.terms)
    if block:
        yield block


def bags(docs: DataFrame, id_col: str, text_col: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document the number of its terms, and those of the vocabulary with their frequencies, in ascending order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, terms, counts, ends = [], [], [], [0]
            for text in batch.column("text"):
                size, held = count_terms(text.as_py())
                own = sorted((vocabulary[t], n) for t, n in held.items() if t in vocabulary)
                sizes.append(size)
                terms.extend(t for t, _ in own)
                counts.extend(n for _, n in own)
                ends.append(len(terms))
            offsets = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int32())) for x in (terms, counts)]
            yield pa.record_batch([batch.column("id"), pa.array(sizes, pa.int64()), *lists], names=["id", "n", "terms", "counts"])

    kind = docs.schema[id_col].dataType.simpleString()
    return _texts(docs, id_col, text_col).mapInArrow(run, f"id {kind}, n bigint, terms array<int>, counts array<int>")


def term_weights(n_documents: int, held: list[Row], size: int) -> np.ndarray:
    """Per term its weight; 0 for a term no document has."""
    weights = np.zeros(size, np.int64)
    for term, documents in held:
        weights[term] = math.floor(1000 * math.log((2 * n_documents + 2) / (2 * documents + 1)))
    return weights


class Scorer:
    """Scores bags against the items of a block and keeps the best of each item. Bags arrive by ascending id."""

    def __init__(self, weights: np.ndarray, block: list[dict[int, int]], top: int):
        pairs = sorted((term, item, n) for item, counts in enumerate(block) for term, n in counts.items())
        term, self.items, self.repeats = (np.array(x, np.int64) for x in zip(*pairs))
        self.starts = np.searchsorted(term, np.arange(len(weights) + 1))
        self.weights, self.top = weights, top
        self.least = np.zeros(len(block), np.int64)  # a bag must score more than this
        self.best = {c: np.empty(0, np.int64) for c in ("item", "score", "place", "name")}
        self.firsts = np.empty(0, object)
        self.seen = 0

    def scores(self, m: np.ndarray, lengths: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Bags by items."""
        bag = np.repeat(np.arange(len(m)), lengths)
        counts = counts.astype(np.int64)
        parts = self.weights[terms] * (1_000_000_000 * counts // (1000 * counts + 12 * m[bag]))
        begin, n = self.starts[terms], self.starts[terms + 1] - self.starts[terms]
        entry = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
        scores = np.zeros((len(m), len(self.least)), np.int64)
        cell = np.repeat(bag * len(self.least), n) + self.items[entry]
        np.add.at(scores.reshape(-1), cell, np.repeat(parts, n) * self.repeats[entry])
        return scores

    def add(self, names: np.ndarray, firsts: np.ndarray, scores: np.ndarray) -> None:
        bag, item = np.nonzero(scores > self.least)
        fresh = {"item": item, "score": scores[bag, item], "place": self.seen + bag, "name": names[bag]}
        best = {c: np.concatenate([self.best[c], fresh[c]]) for c in fresh}
        owners = np.concatenate([self.firsts, firsts[bag]])
        order = np.lexsort((best["place"], -best["score"], best["item"]))
        item = best["item"][order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        kept = order[rank < self.top]
        self.least[item[rank == self.top - 1]] = best["score"][order[rank == self.top - 1]]
        self.best, self.firsts = {c: x[kept] for c, x in best.items()}, owners[kept]
        self.seen += len(names)


def best_classes(classes: DataFrame, weights: np.ndarray, block: list[dict[int, int]], top: int) -> DataFrame:
    """Per item of the block its first classes of each task, by score and smallest id."""
    kind = classes.schema["first"].dataType.simpleString()
    step = max(1, SCORES // len(block))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, id_type = Scorer(weights, block, top), pa.null()
        for whole in batches:
            id_type = whole.schema.field("first").type
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                terms, counts = (batch.column(c).flatten().to_numpy() for c in ("terms", "counts"))
                lengths = batch.column("terms").value_lengths().to_numpy()
                scores = scorer.scores(batch.column("m").to_numpy(), lengths, terms, counts)
                firsts = np.empty(batch.num_rows, object)
                firsts[:] = batch.column("first").to_pylist()
                scorer.add(batch.column("class").to_numpy(), firsts, scores)
        best = scorer.best
        yield pa.record_batch(
            [pa.array(best["item"].astype(np.int32)), pa.array(best["name"]), pa.array(best["score"]),
             pa.array(scorer.firsts.tolist(), id_type)],
            names=["item", "class", "score", "first"],
        )

    rows = classes.select("class", "m", "terms", "counts", "first").sortWithinPartitions(F.col("first").asc_nulls_last())
    return rows.mapInArrow(run, f"item int, class bigint, score bigint, first {kind}")


def _first_rows(df: DataFrame, key: str, order: list[Column], top: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("rank") <= top)


def rank_block(docs: DataFrame, block: list[tuple[object, dict]], id_col: str, text_col: str, top: int) -> DataFrame:
    """(item, rank, id, score), the item by its place in the block."""
    vocabulary: dict[bytes, int] = {}
    counted = [{vocabulary.setdefault(t, len(vocabulary)): n for t, n in counts.items()} for _, counts in block]
    reduced = land(bags(docs, id_col, text_col, vocabulary), "search-bags")
    n_documents, n_terms = reduced.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    held = reduced.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weights = term_weights(n_documents, held, len(vocabulary))
    m = F.expr(f"100 - 25 + (25 * n * {n_documents}L) div {max(n_terms or 0, 1)}L").alias("m")
    told = reduced.filter(F.size("terms") > 0).select("id", m, "terms", "counts")
    same = ["hash", "m", "terms", "counts"]
    told = told.withColumn("hash", F.xxhash64("m", "terms", "counts"))
    classes = told.groupBy(*same).agg(F.min("id").alias("first"))
    classes = land(classes.withColumn("class", F.monotonically_increasing_id()), "search-classes")
    best = best_classes(classes, weights, counted, top)
    best = _first_rows(best, "item", [F.col("score").desc(), F.col("first").asc_nulls_last(), F.col("class")], top)
    best = land(best.select("item", "class", "score"), "search-best")
    chosen = land(classes.join(best.select("class").distinct(), "class", "left_semi").select("class", *same), "search-chosen")
    size = chosen.agg(F.sum(8 * F.size("terms") + 64)).first()[0] or 0
    members = told.join(F.broadcast(chosen) if size <= BROADCAST_BYTES else chosen, same)
    by_id = F.col("id").asc_nulls_last()
    members = _first_rows(members.select("class", "id"), "class", [by_id], top).drop("rank")
    return _first_rows(best.join(members, "class"), "item", [F.col("score").desc(), by_id], top).select("item", "rank", "id", "score")


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """Per item its ``top`` documents with the highest scores above 0: item id, ``rank`` from 1, id, ``score``.

    Terms are the longest runs of ASCII letters (in lower case), digits and other characters beyond ASCII. A null or
    empty text has no terms: such a document is never found, such an item finds nothing. Equal scores go by ascending
    id, null last. Rows that repeat an id are documents, or items, of their own. Other columns are not read, so their
    names cannot clash. Without documents, or without items, there are no rows. Items are a query set that passes
    through the driver in blocks of ``block_terms`` terms; each block reads the documents once.
    """
    spark = docs.sparkSession
    kinds = docs.schema[id_col].dataType.simpleString(), items.schema[item_col].dataType
    result = spark.createDataFrame([], f"`{item_col}` {kinds[1].simpleString()}, rank int, `{id_col}` {kinds[0]}, score bigint")
    for block in item_blocks(items, item_col, item_text_col, block_terms):
        if any(counts for _, counts in block):
            names = spark.createDataFrame(
                [(n, name) for n, (name, _) in enumerate(block)], f"item int, name {kinds[1].simpleString()}"
            )
            found = rank_block(docs, block, id_col, text_col, top).join(names, "item")
            result = result.unionByName(
                found.select(F.col("name").alias(item_col), "rank", F.col("id").alias(id_col), "score")
            )
    return result
