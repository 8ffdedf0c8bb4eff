"""Near copies in large groups: rows that leave a tile stay in proportion to those that enter it."""

import numpy as np
import pyarrow as pa
from test_operators import brute_components

from batchkit.llm import minhash


def half_similar(n, random):
    """Texts of one group, most pairs of which are below 0.8."""
    base = [f"w{i}" for i in range(100)]
    for k in range(n):
        words = list(base)
        for place in random.choice(100, random.integers(1, 7), replace=False):
            words[place] = f"n{k}"
        yield " ".join(words)


def tile_rows(texts):
    shingler = minhash.Shingler(4)
    sets = [shingler.shingles(shingler.words(t.encode())) for t in texts]
    sketches = [minhash.registers(s) for s in sets]
    rows = sorted((bucket, i) for i, s in enumerate(sketches) for bucket in minhash.bands(s).tolist())
    held = [(b, 0, 0, 0, i, i, len(sets[i])) for b, i in rows]
    table = pa.table({c: pa.array([int(r[k]) for r in held]) for k, c in enumerate(minhash._Tiles.COLUMNS)})
    table = table.append_column("registers", pa.array([sketches[i].tobytes() for _, i in rows]))
    return table.append_column("shingles", pa.array([sets[i].view(np.int64) for _, i in rows], pa.list_(pa.int64())))


def joined(n, pairs):
    comp = list(range(n))
    for a, b in pairs:
        low, high = sorted((comp[a], comp[b]))
        comp = [low if c == high else c for c in comp]
    return comp


def test_tiles_let_no_more_rows_out_than_in():
    texts = list(half_similar(150, np.random.default_rng(5)))
    table = tile_rows(texts)
    want = brute_components(dict(enumerate(texts)), 4)
    for size in (11, len(table)):
        needed = list(minhash._TileRows(80)(iter(table.to_batches(size))))
        assert sum(b.num_rows for b in needed) <= len(table)
        links = [p for out in minhash._TileLinks(80)(iter(table.to_batches(size))) for p in zip(*(out.column(c).to_pylist() for c in "ab"))]
        pairs = [p for out in minhash._Tiles(80)(iter(table.to_batches(size))) for p in zip(*(out.column(c).to_pylist() for c in "ab"))]
        assert len(links) < len(table) < len(pairs)
        assert joined(len(texts), links) == [want[i] for i in range(len(texts))]


def test_large_groups_in_small_tiles(spark, monkeypatch):
    random = np.random.default_rng(6)
    texts = dict(enumerate(half_similar(120, random)))
    want = brute_components(texts, 4)
    assert len(set(want.values())) > 1
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for tile, shingles in ((16, 1 << 22), (2048, 2000)):
        monkeypatch.setattr(minhash, "TILE", tile)
        monkeypatch.setattr(minhash, "TILE_SHINGLES", shingles)
        got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, shingle_words=4).collect()}
        assert got == want


def test_bands_borrow_as_before():
    random = np.random.default_rng(7)
    for n in (1, 40, 2000):
        sketched = minhash.registers(np.unique(random.integers(0, 1 << 63, n, np.uint64) * np.uint64(2)))
        empty = sketched == minhash.EMPTY
        lent = [next((sketched[k] for k in row if not empty[k]), None) for row in minhash._LENDERS]
        filled = np.where(empty, np.array(lent), sketched).astype(np.uint16)
        assert (minhash.bands(filled) == minhash.bands(sketched)).all()
