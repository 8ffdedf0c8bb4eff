"""Token alignment against brute force on odd and given texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from batchkit.llm import align
from batchkit.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ODD = [
    (1, "the same words"), (1, "the same words"), (2, None), (3, ""), (None, "no id"), (None, None), (4, " "),
    (5, "word " * 30_000), (6, "\n\n x\t\x1c é 日本語 😀 <|endoftext|> <s></s> İ. it's  "), (7, "a ▁ b"), (8, "\x00\x01 ü"),
]


def libraries():
    byte = Tokenizer.from_file(align.BYTE_VOCABULARY)
    byte.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=align.PIECE_MODEL)
    alphabet = align.byte_alphabet()
    table_a = lambda i: bytes(alphabet[c] for c in byte.id_to_token(i))

    def table_b(i):
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    return lambda t: byte.encode(" " + t, add_special_tokens=False).ids, model.encode, table_a, table_b


def ends_of(tokens):
    ends, at = [], 0
    for token in tokens:
        at += len(token)
        ends.append(at)
    return ends


def brute(rows):
    encode_a, encode_b, table_a, table_b = libraries()
    aligned = []
    for doc_id, text in rows:
        a, b = (encode_a(text), encode_b(text)) if text else ([], [])
        bytes_a, bytes_b = [table_a(i) for i in a], [table_b(i) for i in b]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            aligned.append((doc_id, [], [], [], []))
            continue
        ends_a, ends_b = ends_of(bytes_a), ends_of(bytes_b)
        held = dict(zip(ends_b, b))
        links = [(i, held[e]) for i, e in zip(a, ends_a) if e in held]
        both, groups = sorted(set(ends_a) & set(ends_b)), []
        start = 0
        for end in both:
            own = [",".join(str(i) for i, e in zip(ids, ends) if start < e <= end) for ids, ends in ((a, ends_a), (b, ends_b))]
            groups.append("|".join(own))
            start = end
        aligned.append((doc_id, a, b, groups, links))
    counts = Counter(pair for row in aligned for pair in row[4])
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(n, highest.get(b, 0))
    return [
        (doc_id, len(a), len(b), len(groups), len(links), sum(counts[x] == highest[x[1]] for x in links),
         sum(counts[x] for x in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
        for doc_id, a, b, groups, links in aligned
    ]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block_bytes", [1, align.BLOCK_BYTES])
def test_odd_rows_against_brute_force(spark, block_bytes):
    rows = [r for r in ODD if r[0] != 5]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    clash = ("id", "block", "path", "pair", "n", "count", "best", "piece", "links", "n_a")
    got = align.align_tokens(df.withColumns({c: F.lit("x") for c in clash}), block_bytes=block_bytes)
    assert rows_of(got) == sorted(brute(rows), key=repr)


def test_groups_as_text(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    for r in align.align_tokens(df, keep_groups=True).collect():
        want = hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else ""
        assert r.groups_sha256 == want and r.n_groups == (r.groups.count(";") + 1 if r.groups else 0)


def test_very_long_text_and_empty_table(spark):
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    got = {r.doc_id: r for r in align.align_tokens(df).collect()}
    encode_a, encode_b, *_ = libraries()
    assert (got[5].n_a, got[5].n_b) == (len(encode_a(ODD[7][1])), len(encode_b(ODD[7][1])))
    assert align.align_tokens(df.limit(0)).count() == 0


def test_whole_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text if r.text is None else r.text[:1500]) for r in docs.collect()]
    short = docs.withColumn("text", F.substring("text", 1, 1500))
    assert rows_of(align.align_tokens(short, block_bytes=50_000)) == sorted(brute(rows), key=repr)
    assert QUERIES["op11_token_alignment"](spark, SF).count() == len(rows)


def test_ranks_give_the_ids_of_the_library():
    pick = random.Random(3)
    encode_a, *_ = libraries()
    engine = align.ByteTokens(align.BYTE_VOCABULARY)
    for _ in range(3000):
        text = "".join(pick.choices("aAbeé ß\n\t'sdn  日0٣½.,!<|>_\x1c\x85😀", k=pick.randint(1, 40)))
        assert engine.encode(text).tolist() == encode_a(text)


def test_pointers_lead_to_the_last_token_of_each_component():
    pick = np.random.default_rng(5)
    for _ in range(200):
        ends = [np.unique(np.append(pick.integers(1, 60, pick.integers(1, 50)), 60)) for _ in range(2)]
        label = align.terminals(*ends)
        both = np.intersect1d(*ends)
        want = np.concatenate([len(ends[0]) + np.searchsorted(ends[1], both[np.searchsorted(both, e)]) for e in ends])
        assert (label == want).all()
