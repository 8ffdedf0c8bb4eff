"""Digests of text files of any size, by many tasks per file.

A file is cut into blocks of lines by the offset of their first byte, whatever its splits are. Each block has a SHA-256,
and the file the SHA-256 of its blocks' digests in order. A split hashes the blocks that lie within it; the first and
the last block of a split may go on in its neighbours, and their content is put together before it is hashed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from batchkit.session import land
from batchkit.sources.records import BROADCAST_SPLITS, of_splits, text_lines, with_split_facts

BLOCK_BYTES = 4 << 20


def _split_offsets(lines: DataFrame, parts: bool) -> DataFrame:
    """Where the first line of each split begins in its file, or in all files in a row: the sum of all lines before."""
    order = Window.orderBy("file", "start") if parts else Window.partitionBy("file").orderBy("start")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    sizes = lines.groupBy("file", "start").agg(F.sum(F.octet_length("line") + 1).alias("n"))
    return sizes.select("file", "start", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))


def _hash_blocks(lines: DataFrame, block_bytes: int) -> DataFrame:
    """(file, begin, block, sha256) of the blocks within a split, (file, begin, block, content) at its borders; ``begin``
    is the offset of the split."""
    names = ["file", "begin", "block", "sha256", "content"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def row(file: str, begin: int, block: int, held: list[bytes], inner: bool) -> pa.RecordBatch:
        content = b"".join(held)
        values = [file, begin, block, hashlib.sha256(content).hexdigest() if inner else None, None if inner else content]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, begin, offset, block, first, held = None, 0, 0, 0, True, []
        for batch in batches:
            for key, part in of_splits(batch):
                if key != current:
                    if held:
                        yield row(current[0], begin, block, held, False)
                    offset = begin = part.column("offset")[0].as_py()
                    current, block, first, held = key, offset // block_bytes, True, []
                for line in part.column("line").to_pylist():
                    if offset // block_bytes != block:
                        yield row(current[0], begin, block, held, not first)
                        block, first, held = offset // block_bytes, False, []
                    held.append(line + b"\n")
                    offset += len(line) + 1
        if held:
            yield row(current[0], begin, block, held, False)

    return lines.mapInArrow(run, "file string, begin bigint, block bigint, sha256 string, content binary")


def block_digests(
    spark: SparkSession,
    path: str,
    block_bytes: int = BLOCK_BYTES,
    broadcast_splits: int = BROADCAST_SPLITS,
    parts: bool = False,
) -> DataFrame:
    """(file, block, sha256): blocks are numbered by offset, and one in which no line begins is left out.

    With ``parts`` the files in the order of their names are one file, called by ``path``.
    """
    lines = text_lines(spark, path)
    offsets = land(_split_offsets(lines, parts), "offsets")
    known = with_split_facts(lines.select("file", "start", "line"), offsets, broadcast_splits)
    hashed = _hash_blocks(known, block_bytes)
    hashed = land(hashed.withColumn("file", F.lit(path)) if parts else hashed, "blocks")
    whole = hashed.filter(F.col("sha256").isNotNull()).select("file", "block", "sha256")
    pieces = hashed.filter(F.col("content").isNotNull()).groupBy("file", "block")
    joined = pieces.agg(F.array_sort(F.collect_list(F.struct("begin", "content"))).alias("parts"))
    content = F.aggregate("parts", F.lit("").cast("binary"), lambda seen, part: F.concat(seen, part["content"]))
    return whole.unionByName(joined.select("file", "block", F.sha2(content, 256).alias("sha256")))


def tree_digests(
    spark: SparkSession,
    path: str,
    block_bytes: int = BLOCK_BYTES,
    broadcast_splits: int = BROADCAST_SPLITS,
    parts: bool = False,
) -> DataFrame:
    """One row per file: its name below ``path``, ``size_bytes``, ``blocks`` and ``sha256``, the digest of its tree.

    Compare two folders with ``operators.checks.manifest_diff``. Files are read as lines, so a line has to fit a task; a
    block holds ``block_bytes`` and the rest of its last line. Spark's listing leaves out files of length 0.

    With ``parts`` the folder is one text that a sorted job wrote as many files, each ending with a line break: they are
    taken in the order of their names, and the one row, named ``path``, is that of the files put together.
    """
    blocks = block_digests(spark, path, block_bytes, broadcast_splits, parts)
    ordered = F.array_sort(F.collect_list(F.struct("block", "sha256")))
    trees = blocks.groupBy("file").agg(ordered.alias("tree"))
    sizes = text_lines(spark, path).groupBy("file").agg(F.max("file_size").alias("size_bytes"))
    if parts:
        sizes = sizes.groupBy(F.lit(path).alias("file")).agg(F.sum("size_bytes").alias("size_bytes"))
    below = F.substring_index(F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B"))), f"{path.rstrip('/')}/", -1)
    return trees.join(sizes, "file").select(
        (F.col("file") if parts else below).alias("name"),
        "size_bytes",
        F.size("tree").cast("bigint").alias("blocks"),
        F.sha2(F.array_join(F.col("tree.sha256"), ""), 256).alias("sha256"),
    )
