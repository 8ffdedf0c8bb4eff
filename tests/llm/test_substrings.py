"""Removal of repeated passages against brute force, and the suffix automaton against plain search."""

import random

import pytest
from pyspark.sql import functions as F

from batchkit.llm import substrings


def brute(rows, window):
    """(id, number of words, kept words, ranges removed) of each row."""
    texts = [(i, (t or "").encode().split()) for i, t in rows]
    held = {}
    for i, words in texts:
        for k in range(len(words) - window + 1):
            held.setdefault(tuple(words[k : k + window]), []).append(i)
    out = []
    for i, words in texts:
        gone = [False] * len(words)
        for k in range(len(words) - window + 1):
            if any(j is not None and (i is None or j < i) for j in held[tuple(words[k : k + window])]):
                gone[k : k + window] = [True] * window
        edges = [k for k in range(len(words) + 1) if (k > 0 and gone[k - 1]) != (k < len(words) and gone[k])]
        kept = b" ".join(w for w, g in zip(words, gone) if not g).decode()
        out.append((i, len(words), sum(gone), list(zip(edges[::2], edges[1::2])), kept))
    return out


def rows_of(df):
    return sorted(((r.doc_id, r.n_words, r.n_removed, [tuple(x) for x in r.removed], r.kept_text) for r in df.collect()), key=repr)


def corpus(seed):
    pick = random.Random(seed)
    word = lambda: "".join(pick.choices("abé日", k=pick.randint(1, 2)))
    passages = [[word() for _ in range(pick.randint(3, 30))] for _ in range(12)]
    rows = []
    for _ in range(90):
        parts = [pick.choice(passages) if pick.random() < 0.6 else [word() for _ in range(pick.randint(0, 12))] for _ in range(pick.randint(0, 6))]
        rows.append((pick.choice([None, *range(60)]), pick.choice([" ", "\n", "\t\x0b "]).join(w for p in parts for w in p)))
    return [*rows, (3, None), (None, None), (4, ""), (5, " \n"), (61, "same " * 300), (62, "same " * 400), (62, "same " * 400)]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("settings", [{}, {"block_bytes": 200, "shard_words": 64}, {"block_bytes": 1, "frequent": 2, "shard_words": 100}])
def test_against_brute_force(spark, seed, settings):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    clash = ("id", "block", "path", "anchor", "n", "total", "frequent", "shard", "words", "first", "hits", "n_words")
    df = df.withColumns({c: F.lit("x") for c in clash})
    got = substrings.drop_repeated_passages(df, window_words=6, anchor_words=3, **settings)
    assert rows_of(got) == sorted(brute(rows, 6), key=repr)


def test_registered_settings_on_long_texts(spark):
    pick = random.Random(9)
    long = " ".join(f"w{pick.randint(0, 999)}" for _ in range(30_000))
    shared = " ".join(f"s{k}" for k in range(60))
    rows = [(k, f"{k}a {k}b {shared} {k}c") for k in range(40)] + [(50, long), (51, "x " + long), (52, long[:9000] + " y " + long[9000:])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert rows_of(substrings.drop_repeated_passages(df)) == sorted(brute(rows, 13), key=repr)


def test_empty_table_and_bad_settings(spark):
    none = spark.createDataFrame([], "doc_id string, text string")
    assert substrings.drop_repeated_passages(none).count() == 0
    with pytest.raises(ValueError):
        substrings.drop_repeated_passages(none, window_words=3, anchor_words=4)
    named = spark.createDataFrame([("b", "a b c d"), ("a", "a b c d")], "doc_id string, text string")
    got = substrings.drop_repeated_passages(named, window_words=3, anchor_words=2)
    assert rows_of(got) == [("a", 4, 0, [], "a b c d"), ("b", 4, 4, [(0, 4)], "")]


def test_matching_statistics():
    pick = random.Random(1)
    for _ in range(200):
        automaton = substrings.SuffixAutomaton()
        held = [[pick.randint(0, 2) for _ in range(pick.randint(0, 12))] for _ in range(4)]
        for sequence in held:
            automaton.add(sequence)
        runs = {tuple(s[a:b]) for s in held for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
        asked = [pick.randint(0, 3) for _ in range(25)]
        want = [max((n for n in range(1, e + 2) if tuple(asked[e + 1 - n : e + 1]) in runs), default=0) for e in range(25)]
        assert automaton.matching_statistics(asked) == want
