"""Near-duplicate detection with HyperMinHash sketches and links confirmed on full shingle sets.

A sketch has 256 registers. A shingle's hash picks a register with its first 8 bits; the register keeps the smallest
of the other bits, compressed to 16 bits: leading zeros and the 10 bits that follow the first one. Runs of six
registers are the bands; for them an empty register borrows the value of another, always tried in the same order, so
that a band of a short text says as much as that of a long one. Documents that share a band are compared by the share
of equal registers, corrected for registers that are equal by chance, and then by their sets.

At a similarity of 0.8 a band agrees with probability 0.26 or more, so all 42 differ with probability 3e-6. Texts that
share a tenth of their shingles agree in one of a million bands.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchkit.session import land

REGISTER_BITS = 8
REGISTERS = 1 << REGISTER_BITS
MANTISSA_BITS = 10
BAND = 6
BANDS = REGISTERS // BAND
EMPTY = 0xFFFF
CACHED_WORDS = 1 << 20
TILE = 2048  # members of a bucket that are compared with as many others in one place
TILE_SHINGLES = 1 << 22  # shingles of such members together

_SALTS = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


class Shingler:
    """Words and hashed shingle sets of texts. Words already hashed are kept, up to ``CACHED_WORDS`` of them."""

    def __init__(self, shingle_words: int):
        self.width = shingle_words
        self.hashes: dict[bytes, int] = {}

    @staticmethod
    def words(text: bytes | None) -> list[bytes]:
        """A-Z in lower case, split at the six ASCII white-space characters."""
        return (text or b"").lower().split()

    def shingles(self, words: list[bytes]) -> np.ndarray:
        """The sorted distinct 64-bit hashes of the shingles; fewer words than a shingle has are one together."""
        if not words:
            return np.empty(0, np.uint64)
        if len(self.hashes) > CACHED_WORDS:
            self.hashes.clear()
        known = self.hashes
        for word in set(words).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        hashed = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        width = min(self.width, len(words))
        mixed = np.full(len(words) - width + 1, width, np.uint64)
        for i in range(width):
            mixed = _scatter(mixed * _SALTS[0] + hashed[i : len(words) - width + 1 + i])
        return np.unique(mixed)


def _scatter(x: np.ndarray) -> np.ndarray:
    """A reversible mixing of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _SALTS[1]
    x = (x ^ (x >> np.uint64(27))) * _SALTS[2]
    return x ^ (x >> np.uint64(31))


def registers(shingles: np.ndarray) -> np.ndarray:
    """The registers of a sorted shingle set; the first value of each register's range is its smallest."""
    result = np.full(REGISTERS, EMPTY, np.uint16)
    if len(shingles):
        place, first = np.unique(shingles >> np.uint64(64 - REGISTER_BITS), return_index=True)
        part, exponent = np.frexp((shingles[first] << np.uint64(REGISTER_BITS)).astype(np.float64))
        zeros = np.minimum(64 - exponent, 62)
        mantissa = np.maximum((part * 2 - 1) * (1 << MANTISSA_BITS), 0).astype(np.int64)
        result[place.astype(np.int64)] = zeros << MANTISSA_BITS | np.minimum(mantissa, (1 << MANTISSA_BITS) - 1)
    return result


# For each register the others in the order in which it borrows.
_LENDERS = np.random.default_rng(13).permuted(np.tile(np.arange(REGISTERS), (REGISTERS, 1)), axis=1)


def bands(sketched: np.ndarray) -> np.ndarray:
    """A hash per band of a sketch that has values."""
    empty = sketched == EMPTY
    filled = sketched.astype(np.uint64)
    places = np.flatnonzero(empty)
    lenders = _LENDERS[places]
    filled[places] = sketched[lenders[np.arange(len(places)), np.argmax(~empty[lenders], axis=1)]]
    runs = filled[: BANDS * BAND].reshape(BANDS, BAND)
    mixed = np.arange(1, BANDS + 1).astype(np.uint64)
    for i in range(BAND):
        mixed = _scatter(mixed * _SALTS[0] + runs[:, i])
    return mixed.view(np.int64)


def chance_equal(n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """Probability that registers of disjoint sets of these sizes are equal, for register ranges that both reach."""
    levels = np.arange(63)[:, None]

    def zeros(n):
        reach = 1 - (1 - 2.0**-levels) ** np.maximum(n / REGISTERS, 1)[None, :]
        return reach - np.vstack([reach[1:], np.zeros((1, len(n)))])

    return (zeros(n_left) * zeros(n_right)).sum(axis=0) / (1 << MANTISSA_BITS)


def estimate(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray):
    """Estimated similarity of sketches row by row, and the number of registers it rests on."""
    used = (left != EMPTY) | (right != EMPTY)
    both = (left != EMPTY) & (right != EMPTY)
    equal = (both & (left == right)).sum(axis=1)
    count = np.maximum(used.sum(axis=1), 1)
    by_chance = chance_equal(n_left, n_right) * np.maximum(both.sum(axis=1) - equal, 0)
    return (equal - by_chance) / count, count


def can_reach(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, minimum: float) -> np.ndarray:
    """Whether sketches row by row can have the minimum similarity within five standard deviations of the estimate."""
    similarity, count = estimate(left, right, n_left, n_right)
    return similarity >= minimum - 5 * np.sqrt(minimum * (1 - minimum) / count)


def _plausible(minimum: float):
    @F.pandas_udf(T.BooleanType())
    def test(left: pd.Series, right: pd.Series, n_left: pd.Series, n_right: pd.Series) -> pd.Series:
        sketches = [np.frombuffer(b"".join(s), np.uint16).reshape(-1, REGISTERS) for s in (left, right)]
        return pd.Series(can_reach(*sketches, n_left.to_numpy(float), n_right.to_numpy(float), minimum))

    return test


class _Stars:
    """Pairs of the first row of each bucket with the rows of other components; rows are sorted by bucket."""

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int, int, int] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            bucket, node, comp = (np.asarray(batch.column(c)) for c in ("bucket", "node", "comp"))
            if held is not None:
                bucket, node, comp = (np.r_[h, x] for h, x in zip(held, (bucket, node, comp)))
            first = np.r_[True, bucket[1:] != bucket[:-1]]
            centre = np.maximum.accumulate(np.where(first, np.arange(len(bucket)), 0))
            held = bucket[-1], node[centre[-1]], comp[centre[-1]]
            ends = np.stack([node, node[centre]], axis=1)[comp != comp[centre]]
            ends = np.unique(np.sort(ends, axis=1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])


class _Tiles:
    """Plausible pairs inside runs of rows with one (bucket, low, high); rows are sorted by these."""

    COLUMNS = ("bucket", "low", "high", "slice", "node", "comp", "n")

    def __init__(self, minimum: int):
        self.minimum = minimum

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            new = self.columns(batch)
            now = [np.concatenate(x) for x in zip(held, new)] if held else new
            key = np.stack(now[:3], axis=1)
            # The last run may go on in the next batch.
            last = len(key) - int(np.argmax((key[::-1] != key[-1]).any(axis=1))) if (key != key[-1]).any() else 0
            held = [x[last:] for x in now]
            if last:
                yield self.pairs([x[:last] for x in now])
        if held:
            yield self.pairs(held)

    def columns(self, batch: pa.RecordBatch) -> list[np.ndarray]:
        sketches = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
        return [*[np.asarray(batch.column(c)) for c in self.COLUMNS], sketches]

    def plausible(self, columns: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of the two rows of each pair, told in the first bucket they share only."""
        bucket, low, high, part, node, comp, n, sketches = columns[:8]
        run = np.cumsum(np.r_[0, (np.diff(bucket) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0)])
        own = np.empty((len(run), BANDS), np.int64)
        known = np.zeros(len(run), bool)
        for step in range(1, len(run)):
            i = np.flatnonzero(run[:-step] == run[step:])
            if not len(i):
                break
            j = i + step
            least, most = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
            fits = (comp[i] != comp[j]) & ((low[i] == high[i]) | (part[i] != part[j])) & (100 * least >= self.minimum * most)
            i, j = i[fits], j[fits]
            if len(i):
                likely = can_reach(sketches[i], sketches[j], n[i].astype(float), n[j].astype(float), self.minimum / 100)
                i, j = i[likely], j[likely]
                for row in np.unique(np.r_[i, j]):
                    if not known[row]:
                        own[row], known[row] = bands(sketches[row]), True
                same = own[i] == own[j]
                first = own[i, np.argmax(same, axis=1)] == bucket[i]
                yield i[first], j[first]

    def pairs(self, columns: list[np.ndarray]) -> pa.RecordBatch:
        node = columns[4]
        found = [np.stack([node[i], node[j]], axis=1) for i, j in self.plausible(columns)]
        return _ends(np.concatenate(found) if found else np.empty((0, 2), np.int64))


def _ends(pairs: np.ndarray) -> pa.RecordBatch:
    ends = np.sort(pairs, axis=1)
    return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])


class _TileRows(_Tiles):
    """The rows that have a plausible partner, each once, instead of the pairs: never more than come in."""

    def pairs(self, columns: list[np.ndarray]) -> pa.RecordBatch:
        needed = np.zeros(len(columns[0]), bool)
        for i, j in self.plausible(columns):
            needed[i] = needed[j] = True
        return pa.RecordBatch.from_arrays([pa.array(x[needed]) for x in columns[:7]], names=list(self.COLUMNS))


class _TileLinks(_Tiles):
    """Links confirmed on full sets, as many as join the components of a tile: fewer than its rows."""

    def columns(self, batch: pa.RecordBatch) -> list[np.ndarray]:
        sets = batch.column("shingles")
        flat, at = np.asarray(sets.flatten()).view(np.uint64), np.asarray(sets.offsets) - sets.offsets[0].as_py()
        cut = np.empty(batch.num_rows, object)
        cut[:] = [flat[begin:end] for begin, end in zip(at[:-1], at[1:])]
        return [*super().columns(batch), cut]

    def pairs(self, columns: list[np.ndarray]) -> pa.RecordBatch:
        node, comp, sets = columns[4], columns[5], columns[8]
        names, root = np.unique(comp, return_inverse=True)
        joined = np.arange(len(names))
        found = []
        for i, j in self.plausible(columns):
            for a, b in zip(i.tolist(), j.tolist()):
                left, right = joined[root[a]], joined[root[b]]
                if left == right:
                    continue
                n = len(sets[a]) + len(sets[b])
                both = np.concatenate([sets[a], sets[b]])
                both.sort(kind="stable")
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                if 100 * shared >= self.minimum * (n - shared):
                    joined[joined == right] = left
                    found.append((node[a], node[b]))
        return _ends(np.array(found, np.int64).reshape(-1, 2))


def sketch(docs: DataFrame, id_col: str, text_col: str, shingle_words: int) -> DataFrame:
    """Per row: id, ``n`` (set size), ``key`` (digest of the words), ``registers`` and ``bands`` (null for an empty set)."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(shingle_words)
        for batch in batches:
            sizes, keys, sketches, banded = [], [], [], []
            for text in batch.column("text"):
                words = shingler.words(text.as_py())
                found = shingler.shingles(words)
                sizes.append(len(found))
                keys.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
                own = registers(found) if words else None
                sketches.append(own.tobytes() if words else None)
                banded.append(bands(own) if words else None)
            yield pa.record_batch(
                [
                    batch.column("id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(sketches, pa.binary()),
                    pa.array(banded, pa.list_(pa.int64())),
                ],
                names=["id", "n", "key", "registers", "bands"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n bigint, key binary, registers binary, bands array<bigint>")


def shingle_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, shingle_words: int) -> DataFrame:
    """(node, shingles) of the wanted classes (node, id, key), from a row with the class's id and words."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    asked = wanted.select("node", F.col("id").alias("wanted_id"), "key")
    # Merged at every size: the classes grow with the corpus, and so small input shows the plan and the disk of large.
    same = F.col("id").eqNullSafe(F.col("wanted_id"))
    found = rows.join(asked.hint("merge"), same).select("node", "key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(shingle_words)
        for batch in batches:
            nodes, sets = [], []
            for node, key, text in zip(*(batch.column(c) for c in ("node", "key", "text"))):
                words = shingler.words(text.as_py())
                if hashlib.blake2b(b" ".join(words), digest_size=16).digest() == key.as_py():
                    nodes.append(node.as_py())
                    sets.append(shingler.shingles(words).view(np.int64))
            yield pa.record_batch(
                [pa.array(nodes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["node", "shingles"]
            )

    sets = found.mapInArrow(run, "node bigint, shingles array<bigint>")
    # Rows that repeat an id and a text give a set each.
    return sets.dropDuplicates(["node"])


def relabel(labels: DataFrame, links: DataFrame, spark: SparkSession) -> DataFrame:
    """``labels`` (node, comp) after joining the components that ``links`` (a, b) connect.

    Each component takes the smallest of its neighbours, paths are shortened twice, and the links are drawn between
    the new components until none is left between two. Smallest values combine on the map side.
    """
    edges = _drawn(links, labels)
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy(F.col("a").alias("old")).agg(F.least(F.min("b"), F.col("a")).alias("new"))
        parents = land(parents, "parents")
        for _ in range(2):
            next_up = parents.select(F.col("old").alias("new"), F.col("new").alias("newer"))
            parents = land(parents.join(next_up, "new").select("old", F.col("newer").alias("new")), "parents")
        moved = labels.join(parents, F.col("comp") == F.col("old"), "left")
        labels = land(moved.select("node", F.coalesce("new", "comp").alias("comp")), "labels")
        by_old = parents.select(F.col("old").alias("node"), F.col("new").alias("comp"))
        edges = _drawn(edges, by_old)
    return labels


def _drawn(links: DataFrame, labels: DataFrame) -> DataFrame:
    """Distinct links between different components."""
    left = labels.select(F.col("node").alias("a"), F.col("comp").alias("comp_a"))
    right = labels.select(F.col("node").alias("b"), F.col("comp").alias("comp_b"))
    ends = links.join(left, "a").join(right, "b").filter("comp_a <> comp_b")
    return land(ends.select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")).distinct(), "edges")


class _Linker:
    """Finds the links between classes that share a band, component by component."""

    def __init__(self, sketches: DataFrame, members: DataFrame, sets: DataFrame, minimum: int):
        self.spark = sketches.sparkSession
        self.sketches, self.sets, self.minimum = sketches, sets, minimum
        self.members = members
        self.labels = land(members.select("node", F.col("node").alias("comp")).distinct(), "labels")

    def open_buckets(self) -> tuple[DataFrame, DataFrame] | None:
        """(bucket, slices) of the buckets with several components, and their members; None without any.

        The others are done with for good, as components do not part again.
        """
        labelled = self.members.join(self.labels, "node").join(self.sketches.select("node", "n"), "node")
        labelled = land(labelled, "labelled")
        buckets = labelled.groupBy("bucket").agg(
            F.min("comp").alias("low"), F.max("comp").alias("high"),
            F.ceil(F.greatest(F.count(F.lit(1)) / TILE, F.sum("n") / TILE_SHINGLES)).cast("bigint").alias("slices"),
        )
        still = land(buckets.filter("low <> high").select("bucket", "slices"), "open")
        return None if still.isEmpty() else (still, labelled)

    def stars(self) -> DataFrame:
        """Pairs of each bucket's centre with its other members. The order of centres is the same in all buckets."""
        rows = self.members.select("bucket", "node", F.col("node").alias("comp"), F.xxhash64("node", F.lit(0)).alias("order"))
        dealt = rows.repartition("bucket").sortWithinPartitions("bucket", "order", "node")
        return dealt.select("bucket", "node", "comp").mapInArrow(_Stars(), "a bigint, b bigint").distinct()

    def link_stars(self) -> None:
        """Join the components of the star pairs that are similar enough."""
        pairs = land(self.stars(), "pairs")
        for end in ("a", "b"):
            ends = self.sketches.select(F.col("node").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in ("n", "registers")])
            pairs = pairs.join(ends, end)
        least, most = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
        sized = pairs.filter(100 * least >= self.minimum * most)
        likely = sized.filter(_plausible(self.minimum / 100)("registers_a", "registers_b", "n_a", "n_b"))
        checked = land(likely.select("a", "b", "n_a", "n_b"), "likely")
        for end in ("a", "b"):
            ends = self.sets.select(F.col("node").alias(end), F.col("shingles").alias(f"set_{end}"))
            checked = checked.join(ends, end)
        shared = F.size(F.array_intersect("set_a", "set_b"))
        similar = 100 * shared >= self.minimum * (F.col("n_a") + F.col("n_b") - shared)
        self.labels = relabel(self.labels, land(checked.filter(similar).select("a", "b"), "links"), self.spark)

    def link_rest(self) -> None:
        """Join all components with a link between members that share a bucket.

        The members of a bucket are dealt to slices; every two slices meet in one tile, where their sketches are compared.
        Rows with a plausible partner meet in the same tile once more, now with their sets, and links that join components
        leave it. Pairs stay inside the tiles, so a large group of half-similar texts costs time but no rows.
        """
        found = self.open_buckets()
        if found is None:
            return
        still, labelled = found
        rows = labelled.join(still, "bucket").join(self.sketches.select("node", "registers"), "node")
        rows = rows.withColumn("slice", F.pmod(F.xxhash64("node", F.lit("slice")), "slices"))
        other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1))
        met = rows.withColumn("other", other).select(
            "bucket", F.least("slice", "other").alias("low"), F.greatest("slice", "other").alias("high"),
            "slice", "node", "comp", "n", "registers",
        )
        key = ["bucket", "low", "high"]
        dealt = met.repartition(*key).sortWithinPartitions(*key)
        kinds = ", ".join(f"{c} bigint" for c in _Tiles.COLUMNS)
        needed = land(dealt.mapInArrow(_TileRows(self.minimum), kinds), "needed")
        full = needed.join(self.sketches.select("node", "registers"), "node").join(self.sets, "node")
        dealt = full.repartition(*key).sortWithinPartitions(*key)
        links = land(dealt.mapInArrow(_TileLinks(self.minimum), "a bigint, b bigint").distinct(), "links")
        self.labels = relabel(self.labels, links, self.spark)


def _components(docs: DataFrame, id_col: str, text_col: str, shingle_words: int, minimum: int) -> tuple[DataFrame, DataFrame]:
    """The sketched rows, and (id, key, comp) per class of rows with the same words: its smallest id and its component."""
    spark = docs.sparkSession
    rows = land(sketch(docs, id_col, text_col, shingle_words), "sketches")
    grouped = rows.filter("n > 0").groupBy("key").agg(
        F.min("id").alias("id"), F.max("n").alias("n"), F.max(F.struct("registers", "bands")).alias("s")
    ).select("id", "key", "n", "s.*")
    classes = land(grouped.withColumn("node", F.monotonically_increasing_id()), "classes")
    banded = classes.select("node", F.explode("bands").alias("bucket"))
    shared = land(banded.groupBy("bucket").count().filter("count > 1").select("bucket"), "buckets")
    members = land(banded.join(shared, "bucket"), "members")
    wanted = classes.join(members.select("node").distinct(), "node", "left_semi")
    wanted = land(wanted.select("node", "id", "key", "n", "registers"), "wanted")
    sets = land(shingle_sets(docs, wanted, id_col, text_col, shingle_words), "sets")

    linker = _Linker(wanted.select("node", "n", "registers"), members, sets, minimum)
    linker.link_stars()
    linker.link_rest()

    of_node = classes.select("node", "id", "key").join(linker.labels, "node", "left")
    of_node = land(of_node.select("id", "key", F.coalesce("comp", "node").alias("comp")), "components")
    return rows, of_node


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 5,
    minimum: int = 80,
) -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id`` (smallest id linked over any path), ``kept``.

    Documents are linked if 100 * shared shingles >= ``minimum`` * all shingles of both. Rows with the same words are
    one class, so exact copies cost nothing beyond their row. In every bucket a centre is tested against the other
    members; then all pairs that are still in different components are tested, tile by tile, and only links that join
    components leave a tile. So no link between components is lost and large groups of copies are never paired up.

    A null or empty text has no shingles and is linked with nothing. Rows without id take part; an id is null only if
    all rows of the component lack one. Rows that repeat an id are rows of their own. Other columns are not read. An
    empty table gives no rows.
    """
    rows, of_node = _components(docs, id_col, text_col, shingle_words, minimum)
    smallest = land(of_node.groupBy("comp").agg(F.min("id").alias("component_id")), "smallest")
    by_key = land(of_node.join(smallest, "comp").select("key", "component_id"), "by-key")
    full = rows.filter("n > 0").select("id", "n", "key").join(by_key, "key").select("id", "n", "component_id")
    empty = rows.filter("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return full.unionByName(empty).select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


@F.pandas_udf(T.BinaryType())
def _words_key(texts: pd.Series) -> pd.Series:
    """The digest of the words, as ``sketch`` has it."""
    words = (Shingler.words(None if t is None else bytes(t)) for t in texts)
    return pd.Series([hashlib.blake2b(b" ".join(w), digest_size=16).digest() for w in words], dtype=object)


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, minimum: int = 80
) -> DataFrame:
    """The rows that stay, with all their columns: of each component one with the smallest id, if it has any.

    Where that id repeats, the words decide: of its rows in the component those with the smallest digest are alike, and
    one stays. Rows without shingles stay; those that repeat id and text leave one.
    """
    rows, of_node = _components(docs, id_col, text_col, shingle_words, minimum)
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first")
    keepers = of_node.groupBy("comp").agg(first).select("first.id", "first.key")
    stays = keepers.unionByName(rows.filter("n = 0").select("id", "key").distinct())
    counts = rows.groupBy(F.col("id").alias("_id")).agg(F.count(F.lit(1)).alias("_stay_rows"))
    stays = stays.join(counts, F.col("id").eqNullSafe(F.col("_id")))
    stays = land(stays.select(F.col("id").alias("_stay_id"), F.col("key").alias("_stay_key"), "_stay_rows"), "stays")
    same = F.col(f"`{id_col}`").eqNullSafe(F.col("_stay_id"))
    # Merged at every size, as in shingle_sets.
    once = docs.join(stays.filter("_stay_rows = 1").hint("merge"), same, "left_semi")
    several = stays.filter("_stay_rows > 1")
    if several.isEmpty():
        return once
    # Ids that rows share are told apart by their words.
    keyed = docs.join(several.select("_stay_id").distinct(), same, "left_semi")
    keyed = keyed.withColumn("_key", _words_key(F.col(f"`{text_col}`").cast("binary")))
    keyed = keyed.join(several, same & (F.col("_key") == F.col("_stay_key")), "left_semi")
    empty = F.when(F.col("_key") == F.lit(hashlib.blake2b(b"", digest_size=16).digest()), F.col(f"`{text_col}`"))
    keyed = keyed.withColumn("_empty", empty).dropDuplicates([id_col, "_key", "_empty"])
    return once.unionByName(keyed.select(*[F.col(f"`{c}`") for c in docs.columns]))
