"""Line deduplication with a log-template tree of fixed depth.

Lines go down the tree by their number of tokens and their first tokens; tokens with a digit count as variable. Wildcard
branches leave one of the first tokens open, or lead by the last tokens. In a leaf a token is constant if enough
different lines have it in its place. Small and large templates mixed in one leaf are told apart by levels: a line has
a name per level, its tokens constant at that level with the others variable, if these are two thirds or more. Names
that recur across documents are templates, and so is every masked line that does; their lines are dropped.

Texts are written once, in blocks, with the digests and leaves of their lines. A block sends each of its leaves once and
hears which of them hold other lines too; only lines of those are sent, to their leaves. Lines that differ in the middle
meet in all their leaves: leaves of the same lines give the same names, so only one of them is sent. A block drops the
lines whose names recur.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from hashlib import md5
from itertools import groupby, pairwise
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchkit.llm.files import load_table, new_name, save_table
from batchkit.session import land, scratch_path

LEADING = 3  # tokens that lead through the tree
LEAST_TOKENS = 1  # lines of every size
LEAST_DOCUMENTS = 2  # different texts a template must be in
LEVELS = tuple(2 * 4**i for i in range(12))  # different lines of a leaf that must hold a token, level by level
VARIABLE = "<*>"
BLOCK_CHARS = 8 << 20  # a block of texts ends above it
LEAF_TOKENS = 1 << 20  # leaves with more tokens are counted by all tasks together

_SPACES = re.compile(r" [ \t\r\x0b\f]+|[\t\r\x0b\f][ \t\r\x0b\f]*")
_find_digit = re.compile("[0-9]").search
_NUMBERED = re.compile("(?<![^ ])[^ 0-9]*+[0-9][^ ]*+")


def masked(line: str) -> str:
    """A line whose tokens have one space between them, those with a digit as the variable mark."""
    if "  " in line or "\t" in line or "\r" in line or "\x0b" in line or "\f" in line:
        line = _SPACES.sub(" ", line)
    line = line.strip(" ")
    return _NUMBERED.sub(VARIABLE, line) if _find_digit(line) else line


def _masked(lines: pa.Array) -> pa.Array:
    """The same for many lines; most are not changed."""
    touched = pc.match_substring_regex(lines, r"[0-9\t\r\x0b\f]|  |^ | $")
    changed = [masked(line) for line in lines.filter(touched).to_pylist()]
    return pc.replace_with_mask(lines, touched, pa.array(changed, lines.type))


def _mixed(values: np.ndarray) -> np.ndarray:
    """The last steps of SplitMix64: every bit depends on every bit."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _hashes(tokens: pa.Array) -> np.ndarray:
    """64 bits of each token, from its bytes and their places. No token is empty."""
    known = tokens.dictionary_encode()
    _, ends, whole = known.dictionary.buffers()
    ends = np.frombuffer(ends, np.int32)[: len(known.dictionary) + 1]
    places = np.arange(ends[-1]) - np.repeat(ends[:-1], np.diff(ends))
    signs = (places.astype(np.uint64) << np.uint64(8)) + np.frombuffer(whole, np.uint8)[: ends[-1]]
    return np.bitwise_xor.reduceat(_mixed(signs + np.uint64(1)), ends[:-1])[known.indices.to_numpy()]


def _branches(contents: pa.Array, sizes: np.ndarray, leading: int) -> np.ndarray:
    """The leaves of lines, a row per line: by its first tokens, with one of them open, and by its last tokens."""
    leaves = np.empty((len(contents), leading + 2), np.uint64)
    if not len(contents):
        return leaves.view(np.int64)

    def hashes(split: pa.ListArray, first: int, count: int) -> np.ndarray:
        places = split.offsets.to_numpy()[:-1, None] + np.arange(first, first + count)
        return _hashes(split.values.take(pa.array(places.ravel()))).reshape(places.shape)

    head = hashes(pc.split_pattern(contents, " ", max_splits=leading + 1), 0, leading + 1)
    last = hashes(pc.split_pattern(contents, " ", max_splits=leading, reverse=True), 1, leading) if leading else head[:, :0]
    ways = [head[:, :leading], *[np.delete(head[:, : leading + 1], i, axis=1) for i in range(leading)], last]
    for way, own in enumerate(ways):
        leaf = _mixed(sizes.astype(np.uint64) * np.uint64(leading + 2) + np.uint64(way + 1))
        for place in range(leading):
            leaf = _mixed(leaf ^ own[:, place])
        leaves[:, way] = leaf
    return leaves.view(np.int64)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns])


def _write_blocks(docs: DataFrame, folder: str, id_col: str, text_col: str, leading: int, least_tokens: int) -> DataFrame:
    """One row per block: its number and file.

    ``<file>.texts`` holds ids and texts, ``<file>.kinds`` the different lines, by digest, with the place of one of each,
    ``<file>.lines`` the kind of every line. A line of ``leading`` tokens or fewer is alone in its leaf and has none.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))

    def digests(values: pa.Array) -> list[bytes]:
        if not len(values):
            return []
        whole, ends = memoryview(values.buffers()[2] or b""), np.frombuffer(values.buffers()[1], np.int32).tolist()
        return [md5(whole[start:end]).digest() for start, end in pairwise(ends[values.offset : values.offset + len(values) + 1])]

    def block(own: pa.Table) -> str:
        own = own.combine_chunks()
        texts = own.column("text").cast(pa.string()).combine_chunks()
        texts_digests = digests(texts)
        split = pc.split_pattern(texts, "\n")
        starts = split.offsets.to_numpy()
        doc = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(starts))
        line = np.arange(len(doc), dtype=np.int32) - starts[doc]
        # Equal lines are masked and hashed once; different ones may be equal when masked.
        lines = split.values.dictionary_encode()
        contents = _masked(lines.dictionary).dictionary_encode()
        kind = contents.indices.to_numpy()[lines.indices.to_numpy()]
        contents = contents.dictionary
        size = pc.count_substring(contents, " ").to_numpy() + 1
        wanted = (size >= least_tokens) & (pc.binary_length(contents).to_numpy() > 0)
        number = np.cumsum(wanted, dtype=np.int32) - 1
        contents, size = contents.filter(pa.array(wanted)), size[wanted]
        own_lines = np.flatnonzero(wanted[kind])
        doc, line, kind = doc[own_lines], line[own_lines], number[kind[own_lines]]
        one = np.unique(kind, return_index=True)[1]
        deep = size > leading
        leaves = _branches(contents.filter(pa.array(deep)), size[deep], leading).ravel()
        ends = np.concatenate([[0], np.cumsum(deep * (leading + 2))]).astype(np.int32)
        keys = pa.array(digests(contents), pa.binary(16))
        kinds = {"key": keys, "size": size, "doc": doc[one], "line": line[one], "leaves": pa.ListArray.from_arrays(pa.array(ends), pa.array(leaves))}
        text = np.frombuffer(b"".join(texts_digests), "<i8")[::2][doc]
        file = new_name(folder, "")
        save_table(f"{file}.texts", own.append_column("digest", pa.array(texts_digests, pa.binary())))
        save_table(f"{file}.kinds", pa.table(kinds))
        save_table(f"{file}.lines", pa.table({"doc": doc, "line": line, "kind": kind, "text": text}))
        return file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, turn, held, chars = TaskContext.get().partitionId() << 32, 0, [], 0

        def written() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"block": [first + turn], "file": [block(pa.Table.from_batches(held))]})

        for batch in batches:
            sizes, start = pa.compute.binary_length(batch.column("text")).to_pylist(), 0
            for end, size in enumerate(sizes, 1):
                chars += size
                if chars >= BLOCK_CHARS:
                    held.append(batch.slice(start, end - start))
                    yield written()
                    start, turn, held, chars = end, turn + 1, [], 0
            if start < len(sizes):
                held.append(batch.slice(start))
        if held:
            yield written()

    return land(rows.mapInArrow(run, "block bigint, file string"), "blocks")


class _Lines:
    """The lines of a block and its kinds: the different ones among them."""

    def __init__(self, file: str):
        read = lambda table: [column.to_numpy() for column in table.columns]
        self.doc, self.line, self.kind, self.text = read(load_table(f"{file}.lines"))
        kinds = load_table(f"{file}.kinds").combine_chunks()
        keys = kinds.column("key").combine_chunks()
        self.keys = keys.cast(pa.binary())
        # Of each kind the first 8 bytes of its digest, its tokens and the place of one of its lines.
        self.number = np.frombuffer(keys.buffers()[1], "<i8")[: 2 * len(keys) : 2]
        self.size, self.at_doc, self.at_line = read(kinds.select(["size", "doc", "line"]))
        # The kind of each leaf of a kind.
        leaves = kinds.column("leaves").combine_chunks()
        self.owner = np.repeat(np.arange(len(leaves)), np.diff(leaves.offsets.to_numpy()))
        self.leaf = leaves.flatten().to_numpy()

    def texts(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(kind, text) of the different texts of each kind, ``most`` of a kind at most; in order of kinds."""
        order = np.lexsort((self.text, self.kind))
        kind, text = self.kind[order], self.text[order]
        new = np.ones(len(kind), bool)
        new[1:] = (kind[1:] != kind[:-1]) | (text[1:] != text[:-1])
        kind, text = kind[new], text[new]
        kept = np.arange(len(kind)) - np.searchsorted(kind, kind) < most
        return kind[kept], text[kept]


def _block_tasks(blocks: DataFrame) -> DataFrame:
    return blocks.repartition(max(1, blocks.count()), "block")


def _open_leaves(blocks: DataFrame) -> DataFrame:
    """(block, leaf, same, hot) of the leaves that hold different lines. A leaf is one row per block that knows it.

    Leaves with the same lines have the same ``same``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, file in _rows(batches):
            own = _Lines(file)
            if len(own.leaf):
                order = np.argsort(own.leaf, kind="stable")
                leaf, kind = own.leaf[order], own.owner[order]
                starts = np.flatnonzero(np.concatenate([[True], leaf[1:] != leaf[:-1]]))
                key = own.number[kind]
                tokens = np.add.reduceat(own.size[kind].astype(np.int64), starts)
                low, high = np.minimum.reduceat(key, starts), np.maximum.reduceat(key, starts)
                # With the block, as a line is in a leaf once per block. That of a single line is left out and follows from it.
                marks = _mixed(key.view(np.uint64) ^ _mixed(np.array([number], np.uint64)))
                mark = pa.array(np.bitwise_xor.reduceat(marks, starts).view(np.int64), mask=low == high)
                columns = [*map(pa.array, [np.full(len(starts), number), leaf[starts], low, high, tokens]), mark]
                yield pa.RecordBatch.from_arrays(columns, ["block", "leaf", "low", "high", "tokens", "mark"])

    known = _block_tasks(blocks).mapInArrow(run, "block bigint, leaf bigint, low bigint, high bigint, tokens bigint, mark bigint")
    known = known.repartition("leaf").withColumn("mark", F.coalesce("mark", F.xxhash64("low", "block")))
    of_leaf = Window.partitionBy("leaf")
    whole = [F.min("low"), F.max("high"), F.sum("tokens"), F.bit_xor("mark")]
    known = known.select("block", "leaf", *[value.over(of_leaf).alias(name) for value, name in zip(whole, ["low", "high", "tokens", "mark"])])
    known = known.filter("low <> high").select(
        "block", "leaf", F.xxhash64("low", "high", "tokens", "mark").alias("same"), (F.col("tokens") > LEAF_TOKENS).alias("hot")
    )
    return land(known, "leaves")


def _by_block(blocks: DataFrame, others: DataFrame) -> DataFrame:
    """A block's rows together, that with its file first."""
    rows = blocks.unionByName(others, allowMissingColumns=True)
    return rows.repartition(max(1, blocks.count()), "block").sortWithinPartitions("block", F.col("file").asc_nulls_last())


def _each_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str, pa.Table]]:
    """(number, file, other rows) of each block."""
    held: list[pa.RecordBatch] = []

    def whole() -> tuple[int, str, pa.Table]:
        table = pa.Table.from_batches(held)
        return table.column("block")[0].as_py(), table.column("file")[0].as_py(), table.slice(1)

    for batch in batches:
        firsts = pc.indices_nonzero(batch.column("file").is_valid()).to_pylist()
        for start, end in pairwise(sorted({0, *firsts, batch.num_rows})):
            if held and batch.column("file")[start].is_valid:
                yield whole()
                held = []
            held.append(batch.slice(start, end - start))
    if held:
        yield whole()


def _members(blocks: DataFrame, leaves: DataFrame, least_documents: int) -> DataFrame:
    """(leaf, key, content, block, texts) of the lines in the leaves, once per block.

    Of leaves with the same lines one is taken. A block that knows a line knows all its leaves, so all blocks take the same.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, file, rows in _each_block(batches):
            if not len(rows):
                continue
            leaf, same = rows.column("leaf").to_numpy(), rows.column("same").to_numpy()
            order = np.lexsort((leaf, same))
            wanted = leaf[order[np.unique(same[order], return_index=True)[1]]]
            own = _Lines(file)
            found = np.flatnonzero(np.isin(own.leaf, wanted))
            leaf, owner = own.leaf[found], own.owner[found]
            kinds, place = np.unique(owner, return_inverse=True)
            whole, lines, contents = load_table(f"{file}.texts").column("text"), (None, []), []
            # Kinds are in order of the places of their first lines.
            for doc, line in zip(own.at_doc[kinds].tolist(), own.at_line[kinds].tolist()):
                if lines[0] != doc:
                    lines = doc, whole[doc].as_py().split("\n")
                contents.append(masked(lines[1][line]))
            contents = pa.array(contents, pa.string())
            kind, text = own.texts(least_documents)
            ends = np.searchsorted(kind, np.arange(len(own.keys) + 1)).astype(np.int32)
            texts = pa.ListArray.from_arrays(pa.array(ends), pa.array(text))
            # In parts, as a line goes to each of its leaves.
            for start in range(0, len(found), 4096):
                part = slice(start, start + 4096)
                at, size = pa.array(owner[part]), len(owner[part])
                columns = [
                    pa.array(leaf[part]), own.keys.take(at), contents.take(pa.array(place[part])), pa.array(np.full(size, number)), texts.take(at)
                ]
                yield pa.RecordBatch.from_arrays(columns, ["leaf", "key", "content", "block", "texts"])

    schema = "leaf bigint, key binary, content string, block bigint, texts array<bigint>"
    return _by_block(blocks, leaves.select("block", "leaf", "same")).mapInArrow(run, schema)


def leaf_names(lines: dict[bytes, str]) -> dict[bytes, set[str]]:
    """The names of a leaf's lines at every level; none if too few places hold a shared token."""
    rows = [content.split(" ") for content in lines.values()]
    size, places = len(rows[0]), list(zip(*rows))
    different = list(map(len, map(set, places)))
    if 3 * (size - different.count(len(rows))) < 2 * size:
        return {}
    # Where all lines have the same token, or each has one of its own, nothing needs counting.
    held = [Counter(place) if 1 < n < len(rows) else None for place, n in zip(places, different)]
    alone = [len(rows) if n == 1 else 1 for n in different]
    always = len(rows) + LEVELS[-1]  # above all levels that are looked at
    names: dict[bytes, set[str]] = {}
    for key, tokens in zip(lines, rows):
        counts = [always if token == VARIABLE else n if place is None else place[token] for token, place, n in zip(tokens, held, alone)]
        own, last = set(), None
        names[key] = own
        for level in LEVELS:
            # Above all counts the variable tokens alone are constant.
            constant = [n >= level for n in counts]
            if 3 * constant.count(True) < 2 * size:
                break
            if constant != last:
                own.add(" ".join([token if shared else VARIABLE for token, shared in zip(tokens, constant)]))
                last = constant
            if level > len(rows):
                break
    return names


NAMED = "name binary, key binary, block bigint, text bigint, template string"


def _names_in_tasks(members: DataFrame, templates: bool) -> DataFrame:
    """The names of lines, a leaf after the other; a row for each block of a line and each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        for _, rows in groupby(_rows(batches), itemgetter(0)):
            rows = list(rows)
            lines = {key: content for _, key, content, _, _ in rows}
            if len(lines) > 1 and len({text for *_, texts in rows for text in texts}) > 1:
                names = leaf_names(lines)
                digests = {key: [(md5(n.encode()).digest(), n if templates else None) for n in own if n != lines[key]] for key, own in names.items()}
                found += [(name, key, number, text, template) for _, key, _, number, texts in rows for name, template in digests.get(key, ()) for text in texts]
            if len(found) >= 8192:
                yield table(found)
                found = []
        if found:
            yield table(found)

    def table(found: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*found), kinds)], ["name", "key", "block", "text", "template"])

    return members.repartition("leaf").sortWithinPartitions("leaf").mapInArrow(run, NAMED)


def _names(items: Column) -> Column:
    """The names of a line at every level; ``items`` are its tokens with the number of lines that share each."""
    constant = lambda x, level: (x["n"] >= level) | (x["token"] == VARIABLE)
    levels = F.filter(
        F.array(*[F.lit(v) for v in LEVELS]),
        lambda level: 3 * F.size(F.filter(items, lambda x: constant(x, level))) >= 2 * F.size(items),
    )
    name = lambda level: F.transform(items, lambda x: F.when(constant(x, level), x["token"]).otherwise(F.lit(VARIABLE)))
    return F.array_distinct(F.transform(levels, lambda level: F.array_join(name(level), " ")))


def _names_across_tasks(members: DataFrame, templates: bool) -> DataFrame:
    """The same for leaves of any size: their tokens are counted on the map side, and counts joined to the lines."""
    members = land(members, "members")
    kinds = members.groupBy("leaf", "key").agg(F.min("content").alias("content"), F.min(F.array_min("texts")).alias("low"), F.max(F.array_max("texts")).alias("high"))
    kinds = land(kinds, "kinds")
    texts = kinds.groupBy("leaf").agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low <> high").select("leaf")
    tokens = kinds.select("leaf", "key", F.posexplode(F.split("content", " ")).alias("place", "token")).withColumn("hash", F.xxhash64("token"))
    size = F.octet_length("content") - F.octet_length(F.replace("content", F.lit(" "), F.lit(""))) + 1
    sizes = kinds.groupBy("leaf").agg(F.min(size).alias("size"))
    counted = land(tokens.groupBy("leaf", "place", "hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "counted")
    rich = counted.groupBy("leaf").agg(F.count_distinct("place").alias("places")).join(sizes, "leaf").join(texts, "leaf")
    rich = land(rich.filter("3 * places >= 2 * size").select("leaf"), "rich")
    items = tokens.join(rich.hint("merge"), "leaf").join(counted.hint("merge"), ["leaf", "place", "hash"], "left").groupBy("leaf", "key")
    items = items.agg(F.array_sort(F.collect_list(F.struct("place", "token", F.coalesce("n", F.lit(1)).alias("n")))).alias("items"))
    named = items.select("leaf", "key", F.explode(_names(F.col("items"))).alias("template"))
    named = named.join(members.select("leaf", "key", "block", F.explode("texts").alias("text")).hint("merge"), ["leaf", "key"])
    template = F.col("template") if templates else F.lit(None).cast("string")
    return named.select(F.unhex(F.md5("template")).alias("name"), "key", "block", "text", template.alias("template"))


def _own_names(blocks: DataFrame, least_documents: int) -> DataFrame:
    """Every masked line is a name of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, file in _rows(batches):
            own = _Lines(file)
            kind, text = own.texts(least_documents)
            if len(kind):
                keys, none = own.keys.take(pa.array(kind)), pa.nulls(len(kind), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [keys, keys, pa.array(np.full(len(kind), number)), pa.array(text), none], ["name", "key", "block", "text", "template"]
                )

    return _block_tasks(blocks).mapInArrow(run, NAMED)


def _recurring_lines(blocks: DataFrame, least_documents: int, templates: bool) -> DataFrame:
    """(block, key, template) of the lines with a name in enough texts; the template is null where it is the line.

    Two texts are told by their smallest and largest digest, which combine on the map side. A block sends no more texts
    of a line than are asked for.
    """
    leaves = _open_leaves(blocks)
    named = land(_names_in_tasks(_members(blocks, leaves.filter("NOT hot"), least_documents), templates), "named")
    if not leaves.filter("hot").isEmpty():
        hot = _names_across_tasks(_members(blocks, leaves.filter("hot"), least_documents), templates)
        named = named.unionByName(land(hot, "named"))
    named = named.unionByName(_own_names(blocks, least_documents))
    if least_documents > 2:
        enough = named.select("name", "text").distinct().groupBy("name").count().filter(F.col("count") >= least_documents)
    else:
        enough = named.groupBy("name").agg(F.min("text").alias("low"), F.max("text").alias("high"))
        enough = enough.filter("low <> high" if least_documents == 2 else "true")
    # The number of names grows with the corpus: merged at every size, so that small input shows the plan of large.
    return named.select("name", "key", "block", "template").join(enough.select("name").hint("merge"), "name").drop("name")


def _dropped(file: str, keys: pa.ChunkedArray) -> tuple[pa.Table, np.ndarray, np.ndarray, pa.Array]:
    """A block's texts, and of its lines to drop the document, the place there and the digest."""
    own = _Lines(file)
    named = pc.is_in(own.keys, value_set=keys.combine_chunks()).to_numpy(zero_copy_only=False)
    gone = np.flatnonzero(named[own.kind])
    return load_table(f"{file}.texts"), own.doc[gone], own.line[gone], own.keys.take(pa.array(own.kind[gone]))


def _with_blocks(docs: DataFrame, id_col: str, text_col: str, least_documents: int, leading: int, least_tokens: int, templates: bool):
    folder = scratch_path(docs.sparkSession, "line-blocks")
    blocks = _write_blocks(docs, folder, id_col, text_col, leading, least_tokens)
    gone = land(_recurring_lines(blocks, least_documents, templates), "gone")
    return _by_block(blocks, gone.select("block", "key", "template"))


def template_lines(
    docs: DataFrame, id_col: str, text_col: str, least_documents: int, leading: int, least_tokens: int
) -> DataFrame:
    """(id, digest, line, template) of the lines with a recurring template; ``line`` is the place in the document.

    Equal texts count once. Leaves of one text, and leaves with shared tokens in less than two thirds of their places,
    give no names. Different texts of a name are told by 64 bits of their digests.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, file, rows in _each_block(batches):
            names: dict[bytes, set] = {}
            for key, template in zip(rows.column("key").to_pylist(), rows.column("template").to_pylist()):
                names.setdefault(key, set()).add(template)
            texts, docs_at, lines, keys = _dropped(file, rows.column("key"))
            split = {doc: texts.column("text")[doc].as_py().split("\n") for doc in set(docs_at.tolist())}
            contents = [masked(split[doc][line]) for doc, line in zip(docs_at.tolist(), lines.tolist())]
            chosen = [min(content if name is None else name for name in names[key]) for content, key in zip(contents, keys.to_pylist())]
            columns = [texts.column(c).combine_chunks().take(pa.array(docs_at)) for c in ("id", "digest")]
            columns += [pa.array(lines), pa.array(chosen, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "digest", "line", "template"])

    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("digest", T.BinaryType())])
    schema = schema.add("line", "integer").add("template", "string")
    return _with_blocks(docs, id_col, text_col, least_documents, leading, least_tokens, True).mapInArrow(run, schema)


def drop_recurring_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_documents: int = LEAST_DOCUMENTS,
    leading: int = LEADING,
    least_tokens: int = LEAST_TOKENS,
) -> DataFrame:
    """Per row: id, ``n_lines``, ``n_dropped``, ``clean_text`` (the other lines, in order).

    A null or empty text has one empty line and loses nothing. Rows that repeat an id are rows of their own; rows with
    id and text equal are alike. Other columns are not read. An empty table gives no rows. A line that a third of all
    documents share is one row per block in each of its leaves, and a leaf of very many lines is counted by all tasks.
    """
    names = [id_col, "n_lines", "n_dropped", "clean_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, file, rows in _each_block(batches):
            table, docs_at, lines, _ = _dropped(file, rows.column("key"))
            texts = table.column("text").to_pylist()
            counts = pc.add(pc.count_substring(table.column("text"), "\n"), 1).cast(pa.int64()).combine_chunks()
            for doc, gone in groupby(zip(docs_at.tolist(), lines.tolist()), itemgetter(0)):
                own = {line for _, line in gone}
                texts[doc] = "\n".join([line for i, line in enumerate(texts[doc].split("\n")) if i not in own])
            dropped = np.bincount(docs_at, minlength=len(texts))
            columns = [table.column("id").combine_chunks(), counts, pa.array(dropped), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)])
    schema = schema.add(names[1], "long").add(names[2], "long").add(names[3], "string")
    return _with_blocks(docs, id_col, text_col, least_documents, leading, least_tokens, False).mapInArrow(run, schema)
