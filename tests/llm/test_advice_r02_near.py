"""Near copies whose ids repeat."""

from batchkit.llm import minhash


def test_near_copies_with_repeated_ids(spark):
    base = [f"w{i}" for i in range(100)]
    near = [*base[:99], "other"]
    far = [f"z{i}" for i in range(100)]
    far_near = [*far[:99], "other"]
    texts = [(1, base), (2, near), (2, far), (1, far_near), (1, near), (None, [f"q{i}" for i in range(50)]),
             (None, [*[f"q{i}" for i in range(49)], "x"]), (9, []), (9, [])]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in texts], "doc_id long, text string")
    stay = [(r.doc_id, r.text[:1]) for r in minhash.drop_near_copies(df, shingle_words=4).collect()]
    assert sorted(stay, key=repr) == sorted([(1, "w"), (1, "z"), (None, "q"), (9, "")], key=repr)
