"""Words encoded part by part give the ids of the whole text; plane counts agree with a sum of bits."""

import random

import numpy as np

from batchkit.llm.wavelet import STEP, TOKENIZER, WaveletMatrix, WordEncoder

PIECES = list("abzAZ'smtdrelv<|>!.,#~`^[]{}@:\t\n  0129") + [
    "é", "É", "ß", "İ", "ı", "ŉ", "Ǆ", "ƻ", "Σ", "ς", "́", "̸", " ", " ", "中", "ﬁ", "\x1c", "×",
    "<|endoftext|>", "<|startoftext|>",
]


def test_parts_of_words_against_the_library():
    draw = random.Random(5)
    texts = ["".join(draw.choices(PIECES, k=draw.randint(0, 40))) for _ in range(4000)]
    texts += ["x" * 100_000 + "'s.", "é," * 20_000, "", "word" + "#" * 300 + "word"]
    encode = WordEncoder(TOKENIZER)
    for start in range(0, len(texts), 500):
        part = texts[start : start + 500]
        for text, found in zip(part, encode(part)):
            assert found.tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids, repr(text[:60])


def test_counts_of_planes():
    for size in (0, 1, STEP - 1, STEP, STEP + 1, 5 * STEP + 7):
        ids = np.random.default_rng(size).integers(0, 1 << 9, size).astype(np.uint16)
        matrix = WaveletMatrix.build(ids, 9)
        assert matrix.ids(np.uint16).tolist() == ids.tolist()
        for plane, counts in zip(matrix.planes, matrix.counts):
            ones = np.unpackbits(plane, count=size, bitorder="little")
            assert counts.tolist() == [int(ones[: i * STEP].sum()) for i in range(-(-size // STEP) + 1)]
        for position in range(0, size, 97):
            assert matrix.access(position) == ids[position]
