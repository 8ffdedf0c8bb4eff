"""Passages that documents with smaller ids hold too, found with suffix automata and removed.

A reference shard is a set of passages; its suffix automaton knows every run of words in them. Documents stream through
it in the order of their ids: the matching statistics say, word by word, how long a run ending there the earlier
documents hold, and runs of at least the threshold are removed. What is new in a document then joins the automaton.

One automaton of all documents, or every document against every shard, would not survive a large corpus, so shards are
dealt by content. Each window of ``window_words`` words has an anchor, the least hash among its runs of ``ANCHOR_WORDS``
words: equal windows have equal anchors wherever they stand. A stretch of windows with one anchor goes to the shard of
that anchor, and only if two documents have it; the automaton of a shard is given to just those stretches. Hashes route,
automata decide, by whole words.

* Tasks pack a block of documents into a file of the shared folder; texts are never shuffled. A block sends each of its
  anchors once, with the number of its documents that have it. Only anchors of two documents come back.
* A block sends equal stretches once. Stretches of an anchor that very many documents have are cut into single windows,
  dealt by their own hash, so a shard stays small where a frequent passage begins and ends in ever new surroundings.
* A group has at most one row per block for the same anchor or the same stretch.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from batchkit.llm.files import load_table, new_name, save_table
from batchkit.session import land, scratch_path

WINDOW_WORDS = 13
ANCHOR_WORDS = 6
BLOCK_BYTES = 8 << 20  # text of a block: bounds the memory of a task
SHARD_WORDS = 1 << 16  # words of the corpus for each shard
FREQUENT = 1 << 12  # documents with an anchor, above which its stretches are cut into windows


class SuffixAutomaton:
    """Of several sequences: every run of symbols in any of them leads from state 0 to a state."""

    def __init__(self):
        self.follow: list[dict[int, int]] = [{}]
        self.link = [-1]  # the state of the longest suffix that occurs in more places
        self.length = [0]  # of the longest run that leads to the state

    def add(self, sequence: list[int]) -> None:
        state = 0
        for symbol in sequence:
            state = self._extend(state, symbol)

    def _extend(self, state: int, symbol: int) -> int:
        follow, link, length = self.follow, self.link, self.length
        known = follow[state].get(symbol)
        if known is not None:
            return known if length[known] == length[state] + 1 else self._split(state, symbol, known)
        new = len(follow)
        follow.append({})
        length.append(length[state] + 1)
        link.append(0)
        while state >= 0 and symbol not in follow[state]:
            follow[state][symbol] = new
            state = link[state]
        if state >= 0:
            known = follow[state][symbol]
            link[new] = known if length[known] == length[state] + 1 else self._split(state, symbol, known)
        return new

    def _split(self, state: int, symbol: int, known: int) -> int:
        """A state for the shorter runs of ``known``, which now end in one more place than its longer ones."""
        follow, link, length = self.follow, self.link, self.length
        new = len(follow)
        follow.append(follow[known].copy())
        length.append(length[state] + 1)
        link.append(link[known])
        link[known] = new
        while state >= 0 and follow[state].get(symbol) == known:
            follow[state][symbol] = new
            state = link[state]
        return new

    def matching_statistics(self, sequence: list[int]) -> list[int]:
        """Per symbol the length of the longest run ending there that one of the sequences holds."""
        follow, link, length = self.follow, self.link, self.length
        state = size = 0
        sizes = []
        for symbol in sequence:
            while state and symbol not in follow[state]:
                state = link[state]
                size = length[state]
            known = follow[state].get(symbol)
            if known is None:
                size = 0
            else:
                state, size = known, size + 1
            sizes.append(size)
        return sizes


class Block:
    """Documents of one task as word sequences, one after the other."""

    def __init__(self, documents: list[list[bytes]]):
        self.words = [word for document in documents for word in document]
        self.ends = np.cumsum([len(document) for document in documents], dtype=np.int64)
        self.starts = self.ends - np.diff(self.ends, prepend=0)

    def anchors(self, window: int, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the windows that lie within a document: where they begin, their document, their anchor."""
        n = len(self.words) - window + 1
        if n <= 0:
            none = np.empty(0, np.int64)
            return none, none, none
        known = {word: xxhash.xxh3_64_intdigest(word) for word in set(self.words)}
        hashes = np.fromiter(map(known.__getitem__, self.words), np.uint64, len(self.words))
        runs = np.zeros(len(hashes) - size + 1, np.uint64)
        for k in range(size):
            runs *= np.uint64(0x9E3779B97F4A7C15)
            runs += hashes[k : k + len(runs)]
        runs ^= runs >> np.uint64(32)
        runs *= np.uint64(0xD6E8FEB86659FD93)
        runs ^= runs >> np.uint64(32)
        least = runs[:n].copy()
        for k in range(1, window - size + 1):
            np.minimum(least, runs[k : k + n], out=least)
        document = np.repeat(np.arange(len(self.ends)), self.ends - self.starts)
        within = np.flatnonzero(document[:n] == document[window - 1 :])
        return within, document[within], least[within].view(np.int64)

    def text(self, start: int, end: int) -> bytes:
        return b" ".join(self.words[start:end])


def _ranks(ids: list) -> np.ndarray:
    """The ids' places in their order, equal for equal ones."""
    ordered = {key: n for n, key in enumerate(sorted(set(map(_order, ids))))}
    return np.fromiter((ordered[_order(i)] for i in ids), np.int64, len(ids))


def _order(doc_id) -> tuple:
    """Ids in order, null after all."""
    return (doc_id is None, 0 if doc_id is None else doc_id)


def pack_blocks(docs: DataFrame, id_col: str, text_col: str, window: int, anchor_words: int, block_bytes: int) -> DataFrame:
    """Rows (block, path, n): files with their words; rows (block, anchor, n): documents of a block with an anchor."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    folder = scratch_path(docs.sparkSession, "passages")

    def saved(ids: list, documents: list[list[bytes]], kind: pa.DataType, block: int) -> pa.RecordBatch:
        path = new_name(folder, ".arrow")
        held = Block(documents)
        texts = pa.array([b" ".join(words) for words in documents], pa.large_binary())
        save_table(path, pa.table([pa.array(ids, kind), texts, held.ends - held.starts], names=["id", "words", "n_words"]))
        _, document, anchor = held.anchors(window, anchor_words)
        changes = np.append(True, (anchor[1:] != anchor[:-1]) | (document[1:] != document[:-1]))[: len(anchor)]
        document, anchor = document[changes], anchor[changes]
        order = np.lexsort((document, anchor))
        anchor, document = anchor[order], document[order]
        first = np.append(True, (anchor[1:] != anchor[:-1]) | (document[1:] != document[:-1]))[: len(anchor)]
        anchor, n = np.unique(anchor[first], return_counts=True)
        return pa.record_batch(
            [pa.array(np.full(len(anchor) + 1, block)), pa.array([path] + [None] * len(anchor), pa.string()),
             pa.array([None, *anchor.tolist()], pa.int64()), pa.array([len(held.words), *n.tolist()], pa.int64())],
            names=["block", "path", "anchor", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, documents, size, kind = TaskContext.get().partitionId() << 32, [], [], 0, pa.null()
        for batch in batches:
            kind = batch.schema.field("id").type
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                text = text.as_py()
                ids.append(doc_id)
                documents.append(text.split())  # of bytes: at ASCII white space
                size += len(text)
                if size >= block_bytes:
                    yield saved(ids, documents, kind, block)
                    block, ids, documents, size = block + 1, [], [], 0
        if ids:
            yield saved(ids, documents, kind, block)

    return rows.mapInArrow(run, "block bigint, path string, anchor bigint, n bigint")


def cut_stretches(blocks: DataFrame, kind: str, window: int, anchor_words: int, shards: int, frequent: int) -> DataFrame:
    """Distinct stretches of each block: shard, words and the least id in the block. One more row of a block has the
    path of a file that says where they stand."""
    anchors = blocks.filter(F.col("anchor").isNotNull()).select("block", "anchor", "n")
    total = F.sum("n").over(Window.partitionBy("anchor"))
    shared = anchors.select("block", "anchor", total.alias("total")).filter("total > 1")
    shared = shared.select("block", "anchor", (F.col("total") > frequent).alias("frequent"))
    files = blocks.filter(F.col("path").isNotNull()).select("block", "path")
    both = files.unionByName(shared, allowMissingColumns=True)
    folder = scratch_path(blocks.sparkSession, "passage-places")

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        path = table.column("path").drop_null()[0].as_py()
        table = table.filter(table.column("anchor").is_valid()).sort_by("anchor")
        wanted, often = table.column("anchor").to_numpy(), table.column("frequent").to_numpy()
        own = load_table(path)
        ids = own.column("id").to_pylist()
        block = Block([text.as_py().split() for text in own.column("words")])
        start, document, anchor = block.anchors(window, anchor_words)
        kept = np.isin(anchor, wanted)
        start, document, anchor = start[kept], document[kept], anchor[kept]
        single = often[np.searchsorted(wanted, anchor)].astype(bool)
        goes_on = (start[1:] == start[:-1] + 1) & (document[1:] == document[:-1]) & (anchor[1:] == anchor[:-1]) & ~single[1:]
        heads = np.flatnonzero(np.append(True, ~goes_on)[: len(start)])
        tails = np.append(heads[1:], len(start))[: len(heads)] - 1
        start, end, document, anchor, single = start[heads], start[tails] + window, document[heads], anchor[heads], single[heads]
        known: dict[bytes, int] = {}
        texts = (block.text(a, b) for a, b in zip(start.tolist(), end.tolist()))
        stretch = np.fromiter((known.setdefault(text, len(known)) for text in texts), np.int64, len(start))
        ranks = _ranks(ids)
        least = np.full(len(known), len(ids))
        np.minimum.at(least, stretch, ranks[document])
        by_rank = np.zeros(len(ids), np.int64)
        by_rank[ranks] = np.arange(len(ids))
        first = [ids[n] for n in by_rank[least].tolist()]
        shard = np.zeros(len(known), np.int64)
        shard[stretch] = anchor % shards
        shard[stretch[single]] = -1
        if single.any():
            shard = [xxhash.xxh3_64_intdigest(text) % shards if n < 0 else n for text, n in zip(known, shard.tolist())]
        places = new_name(folder, ".arrow")
        later = ranks[document] > least[stretch]
        columns = [stretch, start, end, later]
        save_table(places, pa.table([pa.array(c) for c in columns], names=["stretch", "start", "end", "later"]))
        return pa.table(
            [pa.array([key[0].as_py()] * (len(known) + 1), pa.int64()), pa.array([places] + [None] * len(known), pa.string()),
             pa.array([None, *range(len(known))], pa.int32()), pa.array([None, *shard], pa.int64()),
             pa.array([None, *known], pa.binary()), pa.array([None, *first], own.schema.field("id").type)],
            names=["block", "places", "stretch", "shard", "words", "first"],
        )

    return both.groupBy("block").applyInArrow(
        run, f"block bigint, places string, stretch int, shard bigint, words binary, first {kind}"
    )


def match_shard(stretches: dict[bytes, object], window: int) -> dict[bytes, list[int]]:
    """Per stretch the windows that a smaller id holds, for the document with its least id: ends of windows, counted from 0.

    ``stretches`` has the least id of each. Those of a null id come last and are held by no smaller id.
    """
    numbers: dict[bytes, int] = {}
    automaton = SuffixAutomaton()
    found = {}
    ordered = sorted(stretches.items(), key=lambda item: _order(item[1]))
    for _, same in groupby(ordered, key=lambda item: _order(item[1])):
        new = []
        for text, _ in same:
            sequence = [numbers.setdefault(word, len(numbers)) for word in text.split(b" ")]
            sizes = automaton.matching_statistics(sequence)
            hits = [end for end, size in enumerate(sizes) if size >= window]
            if hits:
                found[text] = hits
            if sizes[-1] < len(sequence):
                new.append(sequence)
        for sequence in new:
            automaton.add(sequence)
    return found


def judge_stretches(stretches: DataFrame, window: int) -> DataFrame:
    """Per stretch of a block about which there is something to say: whether another block has it with a smaller id,
    and else the windows that the documents of its least id lose (their ends, as 32-bit numbers)."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        texts, first = table.column("words").to_pylist(), table.column("first").to_pylist()
        least: dict[bytes, object] = {}
        for text, doc_id in zip(texts, first):
            if text not in least or _order(doc_id) < _order(least[text]):
                least[text] = doc_id
        gc.disable()  # the automaton has no cycles, and its many dictionaries would be looked through again and again
        try:
            found = match_shard(least, window)
        finally:
            gc.enable()
        elsewhere = [least[text] != own for text, own in zip(texts, first)]
        told = [n for n, text in enumerate(texts) if elsewhere[n] or text in found]
        hits = [None if elsewhere[n] else np.array(found[texts[n]], "<i4").tobytes() for n in told]
        rows = pa.array(told, pa.int64())
        return pa.table(
            [table.column("block").take(rows), table.column("stretch").take(rows),
             pa.array([elsewhere[n] for n in told], pa.bool_()), pa.array(hits, pa.binary())],
            names=["block", "stretch", "elsewhere", "hits"],
        )

    rows = stretches.filter(F.col("words").isNotNull()).select("shard", "block", "stretch", "words", "first")
    return rows.groupBy("shard").applyInArrow(run, "block bigint, stretch int, elsewhere boolean, hits binary")


def _removed(size: int, places: pa.Table, judged: pa.Table, window: int) -> np.ndarray:
    """Which of the block's words go."""
    stretch, start, end, later = (places.column(c).to_numpy() for c in ("stretch", "start", "end", "later"))
    known = np.zeros(int(stretch.max(initial=-1)) + 1, bool)
    known[judged.filter(judged.column("elsewhere")).column("stretch").to_numpy()] = True
    whole = later.astype(bool) | known[stretch]
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, start[whole], 1)
    np.add.at(change, end[whole], -1)
    judged = judged.filter(judged.column("hits").is_valid())
    hits = dict(zip(judged.column("stretch").to_pylist(), judged.column("hits").to_pylist()))
    parts = np.flatnonzero(~whole & np.isin(stretch, np.fromiter(hits, np.int64, len(hits))))
    for own, begin in zip(stretch[parts].tolist(), start[parts].tolist()):
        ends = begin + 1 + np.frombuffer(hits[own], "<i4")
        np.add.at(change, ends - window, 1)
        np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0


def drop_repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window_words: int = WINDOW_WORDS,
    anchor_words: int = ANCHOR_WORDS,
    block_bytes: int = BLOCK_BYTES,
    shard_words: int = SHARD_WORDS,
    frequent: int = FREQUENT,
) -> DataFrame:
    """Per row: id, ``n_words``, ``n_removed``, ``removed`` (ranges of words, from 0, ends excluded) and ``kept_text``
    (the other words, joined by a space).

    A word goes if a window of ``window_words`` words over it also stands in a row with a smaller id. Windows are those
    of the input. Words are the stretches without ASCII white space. A null or empty text has no words. Rows that repeat
    an id are rows of their own, and take nothing from each other; null ids count as larger than all others, and take
    nothing from each other. Other columns are not read, so their names cannot clash. An empty table gives no rows. A
    task holds one block of documents, or one document if that is longer.
    """
    if not 0 < anchor_words <= window_words:
        raise ValueError("an anchor has from one word to the words of a window")
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    blocks = land(pack_blocks(docs, id_col, text_col, window_words, anchor_words, block_bytes), "passage-blocks")
    files = blocks.filter(F.col("path").isNotNull())
    n_words = files.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-n_words // shard_words))
    stretches = land(cut_stretches(blocks, kind, window_words, anchor_words, shards, frequent), "passage-stretches")
    judged = judge_stretches(stretches, window_words)
    places = stretches.filter(F.col("places").isNotNull()).select("block", "places")
    both = files.select("block", "path").unionByName(places, allowMissingColumns=True)
    both = both.unionByName(judged, allowMissingColumns=True)

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        own = load_table(table.column("path").drop_null()[0].as_py())
        n_words, texts = own.column("n_words").to_numpy(), own.column("words").to_pylist()
        ends = np.cumsum(n_words)
        placed = table.column("places").drop_null()
        judged = table.filter(table.column("stretch").is_valid())
        size = int(n_words.sum())
        gone = _removed(size, load_table(placed[0].as_py()), judged, window_words) if len(placed) else np.zeros(size, bool)
        n_removed, kept, spans, bounds = [], [], [], [0]
        for start, end, text in zip((ends - n_words).tolist(), ends.tolist(), texts):
            flags = gone[start:end]
            n = int(flags.sum())
            n_removed.append(n)
            if n:
                kept.append(b" ".join([w for w, x in zip(text.split(), flags.tolist()) if not x]))
                edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
                spans.append(edges)
                bounds.append(bounds[-1] + len(edges) // 2)
            else:
                kept.append(text)
                bounds.append(bounds[-1])
        spans = np.concatenate(spans or [np.empty(0, np.int64)]).astype(np.int32)
        ranges = pa.StructArray.from_arrays([pa.array(spans[::2]), pa.array(spans[1::2])], names=["start", "end"])
        columns = [
            own.column("id"), own.column("n_words"), pa.array(n_removed, pa.int64()),
            pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), ranges), pa.array(kept, pa.binary()).cast(pa.string()),
        ]
        return pa.table(columns, names=[id_col, "n_words", "n_removed", "removed", "kept_text"])

    return both.groupBy("block").applyInArrow(
        run, f"`{id_col}` {kind}, n_words bigint, n_removed bigint, removed array<struct<start:int,end:int>>, kept_text string"
    )
