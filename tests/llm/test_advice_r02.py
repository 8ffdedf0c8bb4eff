"""Whole results where an operator once left part of its job out."""

import random
import re
from collections import defaultdict

from batchkit.llm import lines
from batchkit.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def masked_lines(text):
    for at, line in enumerate(text.split("\n")):
        content = re.sub(r"[ \t\r\x0b\f]+", " ", line).strip(" ")
        tokens = ["<*>" if re.search("[0-9]", t) else t for t in content.split(" ")]
        if content:
            yield at, tokens


def brute_template_lines(texts, least_documents, leading, least_tokens):
    """(id, line) of the lines whose name at some level is in enough texts."""
    kinds, leaves, names = defaultdict(set), defaultdict(set), defaultdict(set)
    placed = [(i, at, tuple(w)) for i, t in texts.items() for at, w in masked_lines(t) if len(w) >= least_tokens]
    for i, _, w in placed:
        kinds[w].add(texts[i])
    for w in kinds:
        leaves[len(w), w[:leading]].add(w)
        if len(w) > leading:
            leaves[len(w), -1, w[-leading:]].add(w)
            for k in range(leading):
                leaves[len(w), k, w[:k] + w[k + 1 : leading + 1]].add(w)
        names[w].add(w)
    for members in leaves.values():
        for w in members:
            held = [sum(m[k] == t for m in members) for k, t in enumerate(w)]
            for level in lines.LEVELS:
                name = tuple(t if n >= level else "<*>" for t, n in zip(w, held))
                if 3 * sum(n >= level or t == "<*>" for t, n in zip(w, held)) >= 2 * len(w):
                    names[w].add(name)
    of_name = defaultdict(set)
    for w, own in names.items():
        for name in own:
            of_name[name] |= kinds[w]
    return {(i, at) for i, at, w in placed if any(len(of_name[name]) >= least_documents for name in names[w])}


def test_word_fields_and_mixed_leaves(spark):
    pick = random.Random(5)
    word = lambda: "".join(pick.choices("abcdefghijklmnopqrstuvwxyz", k=8))
    made = {
        "edited": lambda: f"This page was edited by {word()} last week",
        "found": lambda: f"This page was found at {word()} this morning",
        "filed": lambda: f"Report was filed by {word()} {word()}",
        "desk": lambda: f"By {word()} for the daily news desk",
        "pool": lambda: f"The winner of today is {pick.choice('ABCDEFGHIJ')} from our town",
        "own": lambda: " ".join(word() for _ in range(9)),
    }
    rows = [f"{make()}\n{word()}" for make in made.values() for _ in range(40)]
    texts = dict(enumerate(rows))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {(r.id, r.line) for r in lines.template_lines(df, "doc_id", "text", 8, 3, 5).collect()}
    assert got == brute_template_lines(texts, 8, 3, 5)
    assert got == {(i, 0) for i, t in texts.items() if i < 200}


def shared_lines(texts, least_tokens):
    """(id, line) of the lines whose masked content is in two different texts."""
    of = defaultdict(set)
    placed = [(i, at, tuple(w)) for i, t in texts.items() for at, w in masked_lines(t or "") if len(w) >= least_tokens]
    for i, _, w in placed:
        of[w].add(texts[i])
    return {(i, at) for i, at, w in placed if len(of[w]) > 1}


def test_lines_of_two_texts_are_dropped(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    shared = shared_lines({r.doc_id: r.text for r in docs.collect()}, 5)
    found = lines.template_lines(docs, "doc_id", "text", lines.LEAST_DOCUMENTS, lines.LEADING, 5)
    assert shared and shared <= {(r.id, r.line) for r in found.collect()}


def test_query_drops_short_lines(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    least = defaultdict(int)
    for i, _ in shared_lines(texts, 1):
        least[i] += 1
    got = {r.doc_id: r.n_dropped for r in QUERIES["op9_line_templates"](spark, SF).collect()}
    assert least and all(got[i] >= n for i, n in least.items())
