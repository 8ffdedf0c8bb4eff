"""Lexical search against brute force on odd rows; the query is held against SQL with the other operators."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from batchkit.llm import search

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_documents, n_terms = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in held:
            m = 100 - 25 + (25 * c.total() * n_documents) // n_terms
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_documents + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scored)[:top], 1):
            out.append((item, rank, i, -score))
    return out


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def tables(spark, docs, items):
    clash = ("id", "item", "text_", "n", "terms", "counts", "hash", "m", "first", "class", "score", "rank", "name")
    columns = {c: F.lit("x") for c in clash}
    return (
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumns(columns),
        spark.createDataFrame(items, "item_id long, text string").withColumns(columns),
    )


def corpus(seed):
    pick = random.Random(seed)
    words = ["the", "The", "été", "Été", "a1", "x_y", "日本", "rare", *(f"w{k}" for k in range(30))]
    text = lambda n: pick.choice([" ", "-", "\n"]).join(pick.choices(words, k=n))
    docs = [(pick.choice([None, *range(200)]), text(pick.randint(1, 40))) for _ in range(150)]
    docs += [(300 - k, "same words w1 w2 w2 in all") for k in range(60)] + [(7, None), (8, ""), (9, "!?"), (400, "w3 " * 20_000)]
    items = [(k, text(pick.randint(1, 12))) for k in range(20)] + [(3, "w1 w2"), (None, "w1 w1 same"), (50, None), (51, ""), (52, "unseen")]
    return docs, items


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("top, block_terms", [(20, search.BLOCK_TERMS), (3, 40)])
def test_against_brute_force(spark, seed, top, block_terms):
    docs, items = corpus(seed)
    got = search.rank_documents(*tables(spark, docs, items), top=top, block_terms=block_terms)
    assert rows_of(got) == sorted(brute(docs, items, top), key=repr)


def test_empty_tables(spark):
    docs, items = tables(spark, *corpus(1))
    assert search.rank_documents(docs.limit(0), items).count() == 0
    assert search.rank_documents(docs, items.limit(0)).count() == 0
    assert search.rank_documents(docs, items.filter("item_id in (50, 51)")).count() == 0


def test_classes_beyond_the_broadcast_bound(spark, monkeypatch):
    docs, items = corpus(3)
    monkeypatch.setattr(search, "BROADCAST_BYTES", -1)
    assert rows_of(search.rank_documents(*tables(spark, docs, items))) == sorted(brute(docs, items, 20), key=repr)
