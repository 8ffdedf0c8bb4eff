"""Token counts of a piece vocabulary by a compiled finite-state transducer.

The tokens of a text's prefix end in one last token, and taking it away leaves the tokens of a shorter prefix. Which
token is last depends only on the ends of the text that begin some piece, and on the last token before each. They are the
state of a deterministic transducer; a transition reads a character and carries by how much the number of tokens grows
(it may fall, when a merge swallows tokens). States and transitions are compiled when first met.

No piece goes from another character to the mark of a space, so there every state turns into the start state. A chunk
of text is a map of states: characters up to its first such place, whose count depends on the state it is entered
with, a fixed count after it, and the characters since its last one, which determine the state it is left with. Maps
of adjacent chunks compose associatively, so a long text is counted chunk by chunk and combined by a prefix scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

import public_tokenizers

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIMIT = 4096
CHUNK_CHARS = 1 << 20
SPACE = "▁"
STATES = 1 << 18  # compiled states a task keeps
WORDS = 1 << 19  # composed words a task keeps

# From one space, or run of spaces, up to the next.
_SEGMENT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Transducer:
    """Deterministic transducer of a BPE vocabulary, compiled on the way."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.begins = {piece[:i] for piece in scores for i in range(1, len(piece))}
        self.pairs: dict[tuple[str, str], bool] = {}
        self._clear()

    def _clear(self) -> None:
        # A state has, for each end of the text that begins a piece, longest first: that end, the last token before
        # it, and the number of tokens before it relative to that of the whole text.
        self.states: list[tuple[tuple[str, str, int], ...]] = [(("", "", 0),)]
        self.ids = {self.states[0]: 0}
        self.arcs: list[dict[str, tuple[int, int]]] = [{}]
        self.words: dict[str, int] = {}

    def merge(self, text: str) -> list[str]:
        """The pieces of a short text: the best adjacent pair is joined first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _adjacent(self, left: str, right: str) -> bool:
        """Whether the two tokens can stand side by side."""
        known = self.pairs.get((left, right))
        if known is None:
            known = self.pairs[left, right] = not left or self.merge(left + right) == [left, right]
        return known

    def arc(self, state: int, char: str) -> tuple[int, int]:
        """The next state and the change of the number of tokens."""
        found = self.arcs[state].get(char)
        if found is None:
            found = self.arcs[state][char] = self._compile(state, char)
        return found

    def _compile(self, state: int, char: str) -> tuple[int, int]:
        scores, begins = self.scores, self.begins
        known = char in scores
        ends, grown, last = [], None, char
        for end, before, count in self.states[state]:
            token = end + char
            if grown is None and (token in scores or not end) and self._adjacent(before, token):
                last, grown = token, count + (1 if known else len(char.encode()))
            if token in begins:
                ends.append((token, before, count))
        key = (*((end, before, count - grown) for end, before, count in ends), ("", last, 0))
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append(key)
            self.arcs.append({})
        return self.ids[key], grown

    def run(self, text: str, state: int = 0) -> tuple[int, int]:
        """The state after ``text`` and its number of tokens."""
        total = 0
        for char in text:
            state, emitted = self.arc(state, char)
            total += emitted
        return state, total

    def count(self, text: str) -> int:
        """Tokens of a text that begins in the start state. A segment's arcs are composed into one and kept."""
        words, total = self.words, 0
        for segment in _SEGMENT.findall(text):
            known = words.get(segment)
            if known is None:
                known = words[segment] = self.run(segment)[1]
            total += known
        if len(self.states) > STATES:
            self._clear()
        elif len(words) > WORDS:
            words.clear()
        if len(self.pairs) > STATES:
            self.pairs.clear()
        return total


@lru_cache(maxsize=4)
def compile_model(path: str) -> Transducer:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    scores = {}
    for i in range(model.get_piece_size()):
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)):
            scores[model.id_to_piece(i)] = model.get_score(i)
    crossing = [p for p in scores if SPACE in p.lstrip(SPACE)]
    unreached = [p for p in scores if any(c not in scores for c in p)]
    if crossing or unreached:
        raise ValueError("the vocabulary has pieces across spaces or of unknown characters")
    return Transducer(scores)


class ChunkMap(NamedTuple):
    """What a chunk does to the state it is entered with. Without a place to start anew, ``head`` is all of it."""

    head: str
    count: int
    tail: str
    anew: bool


def chunk_map(machine: Transducer, text: str) -> ChunkMap:
    first = re.search(f"(?<=[^{SPACE}]){SPACE}", text)
    if first is None:
        return ChunkMap(text, 0, "", False)
    start = first.start()
    last = text.rfind(SPACE)
    while text[last - 1] == SPACE:
        last -= 1
    if last == 0:  # only the run at the very beginning: not preceded by another character
        last = start
    last = max(last, start)
    return ChunkMap(text[:start], machine.count(text[start:last]), text[last:], True)


def compose(machine: Transducer, left: ChunkMap, right: ChunkMap) -> ChunkMap:
    if not right.anew:
        if left.anew:
            return _settled(machine, left._replace(tail=left.tail + right.head))
        return chunk_map(machine, left.head + right.head)
    if not left.anew:
        joined = chunk_map(machine, left.head + right.head)
        if not joined.anew:
            return right._replace(head=joined.head)
        return ChunkMap(joined.head, joined.count + machine.count(joined.tail) + right.count, right.tail, True)
    return ChunkMap(left.head, left.count + machine.count(left.tail + right.head) + right.count, right.tail, True)


def _settled(machine: Transducer, part: ChunkMap) -> ChunkMap:
    """The same map with a tail that has no place to start anew inside."""
    rest = chunk_map(machine, part.tail)
    if not rest.anew:
        return part
    return part._replace(count=part.count + machine.count(rest.head) + rest.count, tail=rest.tail)


def scan(machine: Transducer, maps: list[ChunkMap]) -> ChunkMap:
    """All maps composed, neighbours first, as a parallel scan does: long tails are not copied again and again."""
    while len(maps) > 1:
        pairs = [compose(machine, a, b) for a, b in zip(maps[::2], maps[1::2])]
        maps = pairs + maps[len(pairs) * 2 :]
    return maps[0]


MAP_TYPE = T.StructType(
    [
        T.StructField("head", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("tail", T.StringType()),
        T.StructField("anew", T.BooleanType()),
    ]
)


def _map_chunks(path: str):
    @F.pandas_udf(MAP_TYPE)
    def mapped(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = compile_model(path)
        for chunks in batches:
            yield pd.DataFrame([chunk_map(machine, c.replace(" ", SPACE)) for c in chunks], columns=MAP_TYPE.names)

    return mapped


def _total(path: str):
    @F.pandas_udf(T.LongType())
    def total(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = compile_model(path)
        for documents in batches:
            counts = []
            for parts in documents:
                whole = scan(machine, [ChunkMap(p["head"], p["count"], p["tail"], p["anew"]) for p in parts])
                counts.append(machine.count(whole.head) + whole.count + machine.count(whole.tail))
            yield pd.Series(counts, dtype="int64")

    return total


def count_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str = MODEL,
    limit: int = LIMIT,
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """Per row: id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``.

    Texts are mapped chunk by chunk; only the maps are shuffled and composed. A chunk without a place to start anew is
    its own map, so a text without spaces is put together and counted in one task. A null or empty text has no tokens. Rows that repeat an id, and null ids, are rows of their own. Other
    columns are not read. An empty table gives no rows.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").alias("id"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
        # The library puts a space before every text that is not empty.
        F.when(text == "", text).otherwise(F.concat(F.lit(" "), text)).alias("text"),
    )
    starts = F.sequence(F.lit(0), F.expr(f"cast(greatest(char_length(text) - 1, 0) div {chunk_chars} as int)"))
    chunks = F.transform(starts, lambda i: F.substring(F.col("text"), i * chunk_chars + 1, F.lit(chunk_chars)))
    chunks = F.when(F.col("n_bytes") < chunk_chars, F.array("text")).otherwise(chunks)
    parts = rows.select("row", "id", "n_bytes", F.posexplode(chunks).alias("chunk", "part"))
    mapped = parts.select("row", "id", "n_bytes", "chunk", _map_chunks(path)("part").alias("map"))
    whole = mapped.groupBy("row", "id", "n_bytes").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("chunk", "map"))), lambda x: x["map"]).alias("maps")
    )
    counted = whole.select(F.col("id").alias(id_col), "n_bytes", _total(path)("maps").alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
