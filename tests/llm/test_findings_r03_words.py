"""Token shards look different words up once per call and keep parts of words only."""

import random

import numpy as np
import pyarrow as pa

from batchkit.llm import wavelet
from batchkit.llm.wavelet import TOKENIZER, WordEncoder


def ids_of(encode, texts):
    return [encode.tokenizer.encode(text, add_special_tokens=False).ids for text in texts]


def test_words_with_symbols_are_not_kept_beside_their_parts():
    encode = WordEncoder(TOKENIZER)
    texts = [f"Harbour{mark} ünïted{mark}" for mark in ",.;:!?)"] * 3
    assert [found.tolist() for found in encode(texts)] == ids_of(encode, texts)
    # A word per mark was cut, encoded and kept again before.
    assert set(encode.known) == {"", "Harbour", "harbour", "ünïted", *",.;:!?)"}


def test_calls_of_slices_long_words_and_a_full_cache(monkeypatch):
    draw = random.Random(8)
    marks = ["", ",", ".", "'s", "<|endoftext|>", "\n", "É", "İ", "Ǆa", "9"]
    word = lambda: "".join(draw.choices("abcAÉß", k=draw.randint(1, 9))) + draw.choice(marks)
    texts = [" ".join(word() for _ in range(draw.randint(0, 30))) for _ in range(300)] + ["", "\n", " ", "Ab" * 5000, "Ü" * 90 + "!"]
    wanted, column = ids_of(WordEncoder(TOKENIZER), texts), pa.array(texts)
    for cached, joined in ((1 << 20, 4096), (50, 7)):
        monkeypatch.setattr(wavelet, "CACHED_WORDS", cached)
        monkeypatch.setattr(wavelet, "JOINED_WORDS", joined)
        encode = WordEncoder(TOKENIZER)
        for turn in range(2):
            found = [own for start in range(0, len(texts), 64) for own in encode(column.slice(start, 64))]
            assert [own.tolist() for own in found] == wanted and all(own.dtype == np.uint16 for own in found)
            assert all(len(name) <= wavelet.CACHED_CHARS for name in encode.known)
    assert encode(column.slice(0, 0)) == []


def test_texts_below_and_above_the_size_of_a_call(spark):
    texts = [(i, f"words of text {i}, " * (i % 40)) for i in range(200)] + [(200, None)]
    sizes = [len(ids) + 1 for ids in ids_of(WordEncoder(TOKENIZER), [text or "" for _, text in texts])]
    count = wavelet.CALL_BYTES // 2 + 10
    texts += [(201, "x " * count), (202, "end")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    once = sorted(map(tuple, wavelet.token_shards(docs).collect()))
    assert [row[2] for row in once] == [*sizes, count + 1, 2]
    many = wavelet.token_shards(docs.filter("doc_id < 201"), shard_tokens=300)
    assert sorted(map(tuple, many.collect())) == once[:201]
