"""Digest trees of files over many splits."""

import hashlib
import os
import random

import pytest

from batchkit.operators.checks import manifest_diff
from batchkit.sources import digests


def tree(data, block_bytes):
    blocks, offset = {}, 0
    for line in data.split(b"\n")[: -1 if data.endswith(b"\n") else None]:
        blocks.setdefault(offset // block_bytes, []).append(line + b"\n")
        offset += len(line) + 1
    hashes = [hashlib.sha256(b"".join(lines)).hexdigest() for _, lines in sorted(blocks.items())]
    return len(hashes), hashlib.sha256("".join(hashes).encode()).hexdigest()


def put(folder, name, data):
    os.makedirs(f"{folder}/{os.path.dirname(name)}", exist_ok=True)
    with open(f"{folder}/{name}", "wb") as file:
        file.write(data)


@pytest.fixture
def splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}

    def setting(size):
        for key in keys:
            spark.conf.set(key, size)

    yield setting
    for key, value in before.items():
        spark.conf.set(key, value)


def test_trees_do_not_depend_on_splits(spark, tmp_path, splits):
    pick = random.Random(8)
    folder = str(tmp_path / "in")
    files = {"a b+c%.txt": b"".join(bytes(pick.choices(b"xy\xff\x00 \r", k=pick.randint(0, 90))) + b"\n" for _ in range(400)),
             "one line.txt": b"z" * 5000, "short": b"\n"}
    for name, data in files.items():
        put(folder, name, data)
    want = {(name, len(data), *tree(data, 700)) for name, data in files.items()}
    for size, broadcast_splits in (("333b", 1 << 19), ("2000b", 0), ("1g", 1 << 19)):
        splits(size)
        got = digests.tree_digests(spark, folder, 700, broadcast_splits)
        assert {(r.name, r.size_bytes, r.blocks, r.sha256) for r in got.collect()} == want


def test_a_changed_byte_is_found(spark, tmp_path, splits):
    data = bytearray(b"".join(b"line %d\n" % n for n in range(2000)))
    put(str(tmp_path / "a"), "big.txt", data)
    put(str(tmp_path / "b"), "big.txt", data)
    splits("1000b")
    trees = lambda name: digests.tree_digests(spark, str(tmp_path / name), 500)
    assert manifest_diff(trees("a"), trees("b")).isEmpty()
    data[9_000] ^= 1
    put(str(tmp_path / "b"), "big.txt", data)
    assert [r.name for r in manifest_diff(trees("a"), trees("b")).collect()] == ["big.txt"]
    put(str(tmp_path / "b"), "big.txt", data[:-1])
    assert manifest_diff(trees("a"), trees("b")).count() == 1
    blocks = [{(r.block, r.sha256) for r in digests.block_digests(spark, str(tmp_path / n), 500).collect()} for n in "ab"]
    assert len(blocks[0] ^ blocks[1]) == 2
