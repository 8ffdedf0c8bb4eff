"""Operators on odd rows against the libraries and brute force, and every query with SQL against DuckDB."""

import hashlib
import itertools
import math
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from batchkit.llm import bpe, exact, html, lines, minhash, mixing, quality, tokens, warc, wavelet
from batchkit.llm.queries import QUERIES, SQL
from oracle import assert_same, connect

SF = "/root/testdata/sf0.01"
ODD = [
    (1, "a b c d e f g", "s1"),
    (2, "a b c d e f g", "s1"),
    (2, "a b c d e f g", "s1"),
    (3, None, None),
    (4, "", "s2"),
    (None, "no id at all", "s2"),
    (None, None, None),
    (5, "word " * 30_000, "s1"),
    (6, " \n\n \x1c é 日本語 😀 <|endoftext|>x. İ. it's\tok  ", "s2"),
    (7, "line one of it\n" * 9, "s3"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame(ODD, "doc_id long, text string, source string")
    # Names that operators use inside.
    clash = ("id", "row", "name", "n", "size", "key", "target", "copies", "kept", "failed", "n_words", "block", "digest", "line")
    return rows.withColumns({c: F.lit("x") for c in clash})


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    assert assert_same(QUERIES[name](spark, SF), connect(SF), SQL[name]) > 0


OPERATORS = {
    "mix": mixing.mix, "count_tokens": tokens.count_tokens, "encode": bpe.encode, "exact": exact.exact_duplicates,
    "near": minhash.near_duplicates, "shards": wavelet.token_shards, "lines": lines.drop_recurring_lines,
    "ledger": quality.ledger,
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_tables_give_no_rows_and_odd_rows_one_each(odd, empty, name):
    assert OPERATORS[name](empty).count() == 0
    assert sorted(repr(r.doc_id) for r in OPERATORS[name](odd).collect()) == sorted(repr(r[0]) for r in ODD)


def test_token_counts(odd):
    library = sentencepiece.SentencePieceProcessor(model_file=tokens.MODEL)
    want = [(i, len((t or "").encode()), len(library.encode(t or "")), len(library.encode(t or "")) > 4096) for i, t, _ in ODD]
    for chars in (5, 1 << 20):
        assert rows_of(tokens.count_tokens(odd, chunk_chars=chars)) == sorted(want, key=repr)


def test_byte_bpe(odd):
    library = bpe.encoding(bpe.RANKS, bpe.PATTERN)
    want = []
    for i, t, _ in ODD:
        ids = library.encode_ordinary(t or "")
        data = np.array(ids, "<u4").tobytes()
        want.append((i, len(ids), hashlib.sha256(data).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    for size in (10, bpe.BLOCK_BYTES):
        assert rows_of(bpe.encode(odd, block_bytes=size)) == sorted(want, key=repr)


def test_token_shards(odd):
    tokenizer = wavelet.load_tokenizer(wavelet.TOKENIZER)
    got = sorted((tuple(r) for r in wavelet.token_shards(odd, shard_tokens=50).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((r[0] for r in ODD), key=lambda i: (i is not None, i))
    assert [r[1] for r in got] == [0, *itertools.accumulate(r[2] for r in got)][:-1]
    want = []
    for i, t, _ in ODD:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((repr(i), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted((repr(a), c, d) for a, _, c, d in got) == sorted(want)


def test_wavelet_matrix():
    ids = np.random.default_rng(1).integers(0, 40, 3000).astype(np.uint16)
    matrix = wavelet.WaveletMatrix.build(ids, 6)
    assert (matrix.ids(np.uint16) == ids).all()
    assert [matrix.access(i) for i in range(0, 3000, 71)] == ids[::71].tolist()
    assert matrix.occurrences(7) == np.flatnonzero(ids == 7).tolist()
    assert matrix.rank(9, 1500) == (ids[:1500] == 9).sum()
    with pytest.raises(IndexError):
        matrix.select(41, 0)


def test_exact_copies_over_many_blocks(odd):
    got = exact.exact_duplicates(odd, block_bytes=7).collect()
    kept = sorted(repr(r.doc_id) for r in got if r.kept)
    assert kept == sorted(map(repr, [2, 4, None, 5, 6, 7]))
    assert {r.doc_id: (r.keep_id, r.group_size) for r in got if r.doc_id in (1, 3)} == {1: (2, 3), 3: (4, 3)}
    assert all(r.text_sha256 == hashlib.sha256(b"").hexdigest() for r in got if r.doc_id in (3, 4))
    assert exact.drop_copies(odd).count() == 6


def test_rows_that_stay_keep_their_columns(spark):
    rows = [(1, None), (1, ""), (1, "a"), (1, "a"), (2, "a"), (None, "b"), (None, "b"), (3, "b")]
    clash = ("row", "id", "sha", "stay_id", "stay_sha", "n", "_stay_id", "_quality_m", "_m", "_row", "failed")
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(c) for c in clash})
    got = exact.drop_copies(df)
    assert got.columns == df.columns and sorted((r.doc_id, r.text or "", r.sha) for r in got.collect()) == [
        (1, "", "sha"), (2, "a", "sha"), (3, "b", "sha")]
    long = " ".join(f"word{k}" for k in range(40))
    named = df.limit(1).withColumn("text", F.lit(long)).unionByName(df)
    assert [r["_quality_m"] for r in quality.keep_documents(named).collect()] == ["_quality_m"]


def brute_components(texts, width):
    sets = {}
    for i, t in texts.items():
        w = minhash.Shingler.words(t.encode())
        sets[i] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    comp = {i: i for i in texts}
    for a, b in itertools.combinations(sorted(texts), 2):
        shared = len(sets[a] & sets[b])
        if sets[a] and 100 * shared >= 80 * len(sets[a] | sets[b]):
            low, high = sorted((comp[a], comp[b]))
            comp = {i: low if c == high else c for i, c in comp.items()}
    return comp


def test_near_copies_against_brute_force(spark):
    random = np.random.default_rng(2)
    base = [f"w{i}" for i in range(120)]
    texts = {0: " ".join(base), 1: "", 2: "one two", 3: "ONE two", 4: "x " + " ".join(base[:60])}
    for i in range(5, 60):
        words = list(base)
        for _ in range(random.integers(1, 9)):
            words[random.integers(len(words))] = f"n{i}"
        texts[i] = " ".join(words)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, shingle_words=4).collect()}
    assert got == brute_components(texts, 4)


def test_tiles_give_each_plausible_pair_once():
    random = np.random.default_rng(4)
    base = [minhash.registers(np.unique(random.integers(0, 1 << 63, 300, np.uint64) * np.uint64(2))) for _ in range(3)]
    sketches = []
    for i in range(60):
        own = base[i % 3].copy()
        changed = random.choice(256, random.integers(0, 90), replace=False)
        own[changed] = random.integers(0, 5000, len(changed))
        sketches.append(own)
    comp, part = random.integers(0, 4, 60), random.integers(0, 3, 60)
    banded = [minhash.bands(s) for s in sketches]
    rows = []
    for i in range(60):
        for bucket in banded[i].tolist():
            rows += [(bucket, min(part[i], t), max(part[i], t), part[i], i, comp[i], 300) for t in range(3)]
    rows.sort(key=lambda r: r[:3])
    table = pa.table({c: pa.array([int(r[k]) for r in rows]) for k, c in enumerate(minhash._Tiles.COLUMNS)})
    table = table.append_column("registers", pa.array([sketches[r[4]].tobytes() for r in rows]))
    want = []
    for a, b in itertools.combinations(range(60), 2):
        pair = [np.array([x]) for x in (sketches[a], sketches[b])]
        if comp[a] != comp[b] and (banded[a] == banded[b]).any():
            want += [(a, b)] * bool(minhash.can_reach(*pair, np.array([300.0]), np.array([300.0]), 0.8)[0])
    for size in (7, 1000, len(rows)):
        got = [p for out in minhash._Tiles(80)(iter(table.to_batches(size))) for p in zip(*(out.column(c).to_pylist() for c in "ab"))]
        assert sorted(got) == want and want


def test_mix_keeps_to_its_targets(spark, odd):
    mixed = mixing.mix(spark.read.parquet(f"{SF}/documents.parquet"))
    for r in mixed.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.max("size").alias("size")).collect():
        assert abs(r.taken - r.target) <= 2 * r.size
    assert mixed.filter("taken > 2 * size").isEmpty()
    assert mixing.mix_documents(odd).columns == odd.columns


def test_mixed_rows_are_whole_copies(odd):
    clash = odd.withColumns({c: F.lit("y") for c in ("_mix_id", "_mix_n", "own_id", "rows", "copies", "order", "nth")})
    planned = {}
    for r in mixing.mix(odd).collect():
        key = r.doc_id, r.source
        planned[key] = planned.get(key, 0) + r.copies
    got = {}
    for r in mixing.mix_documents(clash).collect():
        key = r.doc_id, r.source
        assert r["_mix_id"] == "y" and (*key[:1], r.text, key[1]) in ODD
        got[key] = got.get(key, 0) + 1
    assert got == {k: n for k, n in planned.items() if n} and got


def test_quality_ledger_and_ablation(odd):
    ledger = quality.ledger(odd)
    for r in quality.ablation(ledger).collect():
        bit = 1 << quality.RULE_NAMES.index(r.rule)
        assert r.n_failed == ledger.filter(F.col("failed").bitwiseAND(F.lit(bit)) != 0).count()
    assert quality.keep_documents(odd).columns == odd.columns


def test_archives_round_trip_and_reject_damage(spark, tmp_path):
    big = "x" * 1200
    pages = [(1, "http://a b/\n", big), (2, None, big), (2, "u", big), (3, "u", None), (None, "u", big), (4, "u", "small"), (5, "u", "small")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.archive_pages(df, archive_bytes=300).collect()}
    assert got == {(1, 1200, "revisit", 2), (2, 1200, "response", None), (3, 0, "response", None), (None, 1200, "revisit", 2),
                   (4, 5, "response", None), (5, 5, "response", None)}
    assert warc.archive_pages(df.limit(0)).count() == 0
    record = warc.make_record(1, None, b"body", hashlib.sha1(b"body").hexdigest(), None)
    with pytest.raises(warc.BrokenArchive):
        warc.parse_record(record[:-1])
    with pytest.raises(warc.BrokenArchive):
        warc.facts_of(*warc.parse_record(record.replace(b"body", b"bodX")))


def test_main_text_on_held_out_layouts(spark):
    sample = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    network = html.Labeller(html.PATH_SIZE + html.WORD_SIZE + html.MEASURES).fit(*html.training_pages(sample[:100], 300))
    pages, labels = html.training_pages(sample[150:], 200, seed=77)
    wrong = sum(int((a != (b > 0)).sum()) for a, b in zip(network.label(pages), labels))
    assert wrong <= 0.01 * sum(map(len, labels))
    odd = [(1, None, None), (1, "u", ""), (None, "u", "<p>"), (2, "u", "<a href='x" + "<div>" * 3000)]
    got = html.extract(spark.createDataFrame(odd, "page_id long, url string, html string"), network=network)
    assert got.count() == 4


def test_line_templates(spark):
    rows = [(i, f"own words of text {'abcdefghij'[i]} here {'klmnopqrst'[i]}\nSession 4{i} opened for user bob{i}\nend") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = lines.drop_recurring_lines(docs, least_tokens=5).collect()
    assert all(r.n_lines == 3 and "Session" not in r.clean_text and r.clean_text.endswith("end") for r in got)
    # Short lines recur by themselves and go unless a caller spares them.
    got = lines.drop_recurring_lines(docs).collect()
    assert len(got) == 10 and all("end" not in r.clean_text.split("\n") for r in got)


def sampled(docs):
    """The mixing stage by plain systematic sampling: how often each document is taken."""
    sizes = {i: len(quality.WORD.findall(t)) for i, (t, _) in docs.items()}
    sources = sorted({s for _, s in docs.values()}, key=lambda s: (s is None, s))
    total = {s: sum(sizes[i] for i, (_, own) in docs.items() if own == s) for s in sources}
    weight = {s: (3, 1, 2)[n % 3] for n, s in enumerate(sources)}
    target, left, free = {}, 1.5 * sum(total.values()), list(sources)
    while True:
        level = left / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if level * weight[s] > 2 * total[s]]
        if not over:
            return sizes, {**target, **{s: level * weight[s] for s in free}}
        for s in over:
            target[s] = 2.0 * total[s]
            left -= target[s]
            free.remove(s)


def test_pipeline_against_brute_force(spark, tmp_path):
    """Every stage on texts of the given table; the mix is held to its targets and to whole copies."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(260).collect()
    copied = [(r.doc_id + 10_000, r.text, r.lang, r.source, r.n_chars) for r in rows[:20]]
    near = [(r.doc_id + 20_000, f"{r.text} and", r.lang, r.source, r.n_chars) for r in rows[:20]]
    docs = spark.createDataFrame([tuple(r) for r in rows] + copied + near, spark.read.parquet(f"{SF}/documents.parquet").schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept = {r[0]: (r[1], r[3]) for r in [tuple(r) for r in rows] + copied + near if keeps(r[1])}
    last = {}
    for i, (t, _) in kept.items():
        last[t] = max(i, last.get(t, i))
    comp = brute_components({i: t for t, i in last.items()}, 5)
    stay = {i: kept[i] for i, c in comp.items() if i == c}
    assert 0 < len(stay) < len(last) < len(kept) < len(rows) + 40
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "ids").collect()
    assert {r.doc_id for r in got} <= set(stay)
    library = bpe.encoding(bpe.RANKS, bpe.PATTERN)
    assert all(r.ids == library.encode_ordinary(stay[r.doc_id][0]) for r in got)
    sizes, target = sampled(stay)
    times = {i: sum(r.doc_id == i for r in got) for i in stay}
    for s, wanted in target.items():
        own = [i for i in stay if stay[i][1] == s]
        rate = wanted / max(1, sum(sizes[i] for i in own))
        assert all(math.floor(rate) <= times[i] <= min(2, math.ceil(rate)) for i in own)
        assert abs(sum(times[i] * sizes[i] for i in own) - wanted) <= 2 * max(sizes[i] for i in own)


def keeps(text):
    m = dict(zip(quality.MEASURES, quality.measure(text)))
    n = m["n_words"]
    return not (
        n < 20 or 100 * m["n_repeat_words"] > 30 * n or 100 * m["n_symbols"] > 10 * n or 100 * m["n_dup_line_words"] > 30 * n
        or m["word_chars"] < 2 * n or m["spaced_chars"] > 15 * m["n_spaced_words"] or 100 * m["n_alpha_words"] < 70 * n
    )
