"""Delimited text whose cells hold line breaks, read by many tasks per file, with the ordinals a serial reader gives.

Whether a line break ends a record depends on all quotes before it. A file split is therefore first taken as a function:
from whether it begins inside a quoted cell to whether it ends inside one, how many records begin in it, and which
pieces of records stand at its borders. Splits are small in number; composing their functions in the order of the file
gives each one's true beginning and the number of records before it. Records that cross a border are put together from
those pieces; a second pass over the lines cuts all others.

Both passes stream the lines of a split in the order of the file, and lines are not shuffled unless there are more than
``BROADCAST_SPLITS`` splits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import groupby
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from batchkit.errors import DataError
from batchkit.functions.quotes import inside_after
from batchkit.session import land

FILE = "_file"
LINE = "_line"
RECORD = "_record"

BROADCAST_SPLITS = 1 << 19  # rows of some 100 bytes that go to every task
MAX_RECORD_BYTES = 32 << 20  # a longer record is taken for a quote that nothing closes

_KEY = ["file", "start"]


def text_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The lines with their file and the begin of their split; those of a split stand in order, in one partition."""
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
            F.col("value").cast("binary").alias("line"),
            F.col("_metadata.file_size").alias("file_size"),
        )
    )


def with_split_facts(lines: DataFrame, facts: DataFrame, broadcast_splits: int = BROADCAST_SPLITS) -> DataFrame:
    """The lines with what ``facts`` (file, start, ...) says of their split; a split's lines stay together and in order."""
    if facts.count() <= broadcast_splits:
        return lines.join(F.broadcast(facts), _KEY)
    placed = lines.withColumn("place", F.monotonically_increasing_id())
    return placed.join(facts, _KEY).repartition(*_KEY).sortWithinPartitions(*_KEY, "place").drop("place")


def of_splits(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The batch cut where another split begins."""
    at = 0
    for key, same in groupby(zip(batch.column("file").to_pylist(), batch.column("start").to_pylist())):
        n = sum(1 for _ in same)
        yield key, batch.slice(at, n)
        at += n


class _Reader:
    """Cuts the lines of one split into records; pieces of records at its borders are kept apart."""

    def __init__(self, inside: bool, sep: bytes, limit: int):
        self.inside, self.sep, self.limit = inside, sep, limit
        self.in_first = inside  # still in the record that an earlier split began
        self.first: tuple[bytes | None, int] | None = None  # the end of that record, and its size
        self.begun = 0
        self.held: list[bytes] = []
        self.size = 0
        self.too_long = False

    def add(self, lines: list[bytes], quoted: list[bool]) -> list[tuple[int, bytes]]:
        """Whole records, with their place among those that begin in the split."""
        records = []
        for line, has_quote in zip(lines, quoted):
            if not self.inside:
                if line in (b"", b"\r"):
                    continue
                self.begun += 1
            if has_quote:
                self.inside = inside_after(line, self.inside, self.sep)
            if self.inside or self.held or self.in_first:
                self._hold(line)
                if not self.inside:
                    text = self._held()
                    if self.in_first:
                        self.first, self.in_first = (text, self.size), False
                    elif text is not None:
                        records.append((self.begun, text))
                    self.held, self.size = [], 0
            else:
                records.append((self.begun, line))
        return records

    def _hold(self, line: bytes) -> None:
        self.size += len(line) + 1
        if self.size > self.limit:
            # Held no longer: should this be how the split begins, whoever joins the pieces sees the size and raises.
            self.too_long = self.too_long or not self.in_first
            self.held = [b""]
        else:
            self.held.append(line)

    def _held(self) -> bytes | None:
        return b"\n".join(self.held) if self.size <= self.limit else None

    def rest(self) -> tuple[bytes | None, int]:
        """What is left open at the end of the split, and its size."""
        return (self._held(), self.size) if self.size else (None, 0)


_FUNCTION = (
    "file string, start bigint, outside_to boolean, outside_records bigint, outside_rest binary, outside_size bigint, "
    "inside_to boolean, inside_records bigint, inside_rest binary, inside_size bigint, "
    "first binary, first_size bigint, first_ends boolean"
)
_FUNCTION_TYPES = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}


def split_functions(lines: DataFrame, sep: str = ",", limit: int = MAX_RECORD_BYTES) -> DataFrame:
    """Per split what it does to a reader that comes to it outside, and inside, a quoted cell.

    The first split of a file begins outside. ``first`` is the end of a record that began earlier, the two ``rest`` are
    what the split leaves open; pieces of more than ``limit`` bytes are left out, and only their sizes told.
    """
    mark = sep.encode()
    fields = [field.split() for field in _FUNCTION.split(", ")]
    schema = pa.schema([(name, _FUNCTION_TYPES[kind]) for name, kind in fields])

    def row(key: tuple[str, int], readers: list[_Reader]) -> pa.RecordBatch:
        values = list(key)
        for reader in (readers[0], readers[-1]):
            values += [reader.inside, reader.begun, *reader.rest()]
        first = readers[-1].first
        values += [*(first or (None, 0)), first is not None]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, readers = None, []
        for batch in batches:
            for key, part in of_splits(batch):
                if key != current:
                    if current is not None:
                        yield row(current, readers)
                    current, readers = key, [_Reader(inside, mark, limit) for inside in ((False, True) if key[1] else (False,))]
                own = part.column("line").to_pylist(), pc.match_substring(part.column("line"), '"').to_pylist()
                for reader in readers:
                    reader.add(*own)
        if current is not None:
            yield row(current, readers)

    return lines.mapInArrow(run, _FUNCTION)


def split_states(functions: DataFrame) -> DataFrame:
    """Adds whether the split begins ``inside`` a quoted cell, and ``before``: the records of its file begun before it.

    The functions are composed in order. One that ends alike from both beginnings settles the state; behind the last
    such split only those count that turn the state round.
    """
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    turns = (F.col("outside_to") & ~F.col("inside_to")).cast("int")
    settles = F.col("outside_to") == F.col("inside_to")
    counted = functions.withColumn("turned", F.coalesce(F.sum(turns).over(earlier), F.lit(0)))
    settled = counted.withColumn("settled", F.when(settles, F.col("outside_to").cast("int") - F.col("turned")))
    state = F.coalesce(F.last("settled", ignorenulls=True).over(earlier), F.lit(0)) + F.col("turned")
    placed = settled.withColumn("inside", F.pmod(state, F.lit(2)) == 1)
    records = F.when(F.col("inside"), F.col("inside_records")).otherwise(F.col("outside_records"))
    placed = placed.withColumn("records", records)
    return placed.withColumn("before", F.coalesce(F.sum("records").over(earlier), F.lit(0))).drop("turned", "settled")


def stitch(states: DataFrame, limit: int = MAX_RECORD_BYTES) -> DataFrame:
    """The records that cross borders of splits, put together: (file, ordinal, record)."""
    inside, ends = F.col("inside"), F.col("first_ends")
    piece = lambda text, size: F.struct(F.col(text).alias("text"), F.col(size).alias("size"))
    first = F.when(inside & ends, piece("first", "first_size")).when(inside, piece("inside_rest", "inside_size"))
    opened = F.when(inside & ends & F.col("inside_to"), piece("inside_rest", "inside_size"))
    opened = opened.when(~inside & F.col("outside_to"), piece("outside_rest", "outside_size"))
    both = states.select(
        *_KEY,
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("place"), F.lit(None).cast("bigint").alias("ordinal"), first.alias("piece")),
                F.struct(F.lit(1).alias("place"), (F.col("before") + F.col("records")).alias("ordinal"), opened.alias("piece")),
            )
        ).alias("at"),
    ).select(*_KEY, "at.*")
    order = Window.partitionBy("file").orderBy("start", "place")
    pieces = both.filter(F.col("piece").isNotNull()).withColumn("owner", F.last("ordinal", ignorenulls=True).over(order))
    joined = pieces.groupBy("file", "owner").agg(
        F.sum("piece.size").alias("size"),
        F.array_sort(F.collect_list(F.struct("start", F.col("piece.text").cast("string").alias("text")))).alias("parts"),
    )
    message = F.concat(F.col("file"), F.lit(f": a record has more than {limit} bytes; is a quote left open?"))
    text = F.array_join(F.col("parts.text"), "\n")
    record = F.when(F.col("size") > limit, F.raise_error(message).cast("string")).otherwise(text)
    return joined.select("file", F.col("owner").alias("ordinal"), record.alias("record"))


def cut_records(lines: DataFrame, sep: str = ",", limit: int = MAX_RECORD_BYTES) -> DataFrame:
    """(file, ordinal, record) of all records that lie within a split.

    ``lines`` has ``inside`` and ``before`` of its split, and each split's lines together and in order.
    """
    mark = sep.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, reader, before = None, None, 0
        for batch in batches:
            for key, part in of_splits(batch):
                if key != current:
                    current, before = key, part.column("before")[0].as_py()
                    reader = _Reader(part.column("inside")[0].as_py(), mark, limit)
                quoted = pc.match_substring(part.column("line"), '"').to_pylist()
                records = reader.add(part.column("line").to_pylist(), quoted)
                if reader.too_long:
                    raise DataError(f"{key[0]}: a record has more than {limit} bytes; is a quote left open?")
                if records:
                    places, texts = zip(*records)
                    columns = [
                        pa.array([key[0]] * len(texts)), pa.array([before + n for n in places], pa.int64()),
                        pa.array(texts, pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["file", "ordinal", "record"])

    return lines.mapInArrow(run, "file string, ordinal bigint, record binary")


def record_scan(
    spark: SparkSession,
    path: str | Sequence[str],
    sep: str = ",",
    max_record_bytes: int = MAX_RECORD_BYTES,
    broadcast_splits: int = BROADCAST_SPLITS,
) -> DataFrame:
    """The records of delimited files: ``_file``, ``_line`` (from 1 in each file, the header counted) and ``_record``.

    Lines end with LF, or with CR and LF. Empty lines between records are left out and not counted, as Python's reader
    does. A quote that nothing closes makes one record of the rest of its file; a record of more than
    ``max_record_bytes`` raises. A file without lines has no records.
    """
    lines = text_lines(spark, path)
    states = land(split_states(split_functions(lines, sep, max_record_bytes)), "splits")
    known = with_split_facts(lines, states.select(*_KEY, "inside", "before"), broadcast_splits)
    cut = cut_records(known.select(*_KEY, "line", "inside", "before"), sep, max_record_bytes)
    records = cut.withColumn("record", F.col("record").cast("string")).unionByName(stitch(states, max_record_bytes))
    return records.select(
        F.col("file").alias(FILE), F.col("ordinal").alias(LINE), F.regexp_replace("record", "\r$", "").alias(RECORD)
    )


def head_records(spark: SparkSession, path: str | Sequence[str], n: int, sep: str = ",") -> DataFrame:
    """The first ``n`` records behind the headers, in the order of file names and of lines.

    Files are listed, not read, and looked at in growing groups until enough records are there; the records come out of
    those files by a top-n, not a sort of all.
    """
    files = sorted(unquote(file) for file in spark.read.text(path).inputFiles())
    found = at = 0
    step = 1
    while found < n and at < len(files):
        group = files[at : at + step]
        found += record_scan(spark, group, sep).filter(F.col(LINE) > 1).limit(n - found).count()
        at, step = at + len(group), 2 * step
    records = record_scan(spark, files[: max(at, 1)], sep)
    return records.filter(F.col(LINE) > 1).orderBy(FILE, LINE).limit(n)
