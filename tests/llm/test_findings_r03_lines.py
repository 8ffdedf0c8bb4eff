"""Line templates: what is sent stays small, and leaves of any size give the same names."""

import random

import pyarrow as pa

from batchkit.llm import lines

SETTINGS = ("doc_id", "text", lines.LEAST_DOCUMENTS, lines.LEADING, lines.LEAST_TOKENS)


def made(spark):
    pick = random.Random(3)
    word = lambda: "".join(pick.choices("abcdefghij", k=5))
    forms = (
        lambda: f"Session\topened for  user {word()} today",
        lambda: f"The  winner is {word()} from our town {pick.randrange(9)}",
        lambda: f"Request {pick.randrange(99)} of {word()} was served to {pick.choice('ABC')}",
        lambda: " ".join(word() for _ in range(7)),
        lambda: pick.choice(["end", "", " ", "12 34", "12 ab", "über <*> ñ"]),
    )
    texts = ["\n".join(pick.choice(forms)() for _ in range(6)) for _ in range(150)]
    rows = [*enumerate(texts), (1000, None), (1001, ""), (None, "a b\nSession opened for user xx today"), (3, texts[3]), (3, "end")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def plans_of(monkeypatch, run):
    plans, land = [], lines.land

    def kept(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return land(df, label)

    monkeypatch.setattr(lines, "land", kept)
    return run(), plans


def test_tokens_are_not_sent_one_by_one(spark, monkeypatch):
    """A row per token and leaf took ten times the input; texts are not shuffled either, to be cut or to be joined."""
    result, plans = plans_of(monkeypatch, lambda: lines.drop_recurring_lines(made(spark)))
    plans.append(result._jdf.queryExecution().executedPlan().toString())
    assert not any("Generate" in plan for plan in plans)


def test_leaves_of_any_size_give_the_same_names(spark, monkeypatch):
    docs = made(spark)
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    small = rows(lines.template_lines(docs, *SETTINGS)), rows(lines.drop_recurring_lines(docs))
    monkeypatch.setattr(lines, "LEAF_TOKENS", 0)
    large, plans = plans_of(monkeypatch, lambda: rows(lines.template_lines(docs, *SETTINGS)))
    assert any("posexplode" in plan for plan in plans)
    assert (large, rows(lines.drop_recurring_lines(docs))) == small
    found = {r[3] for r in small[0]}
    assert "Session opened for user <*> today" in found and "The winner is <*> from our town <*>" in found


def test_many_blocks_give_the_same_lines(spark, monkeypatch):
    docs = made(spark)
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    one = rows(lines.template_lines(docs.coalesce(1), *SETTINGS))
    assert one and rows(lines.template_lines(docs.repartition(40), *SETTINGS)) == one
    for least in (1, 3, 200):
        settings = (*SETTINGS[:2], least, *SETTINGS[3:])
        assert rows(lines.template_lines(docs.coalesce(1), *settings)) == rows(lines.template_lines(docs.repartition(40), *settings))
    assert lines.drop_recurring_lines(docs.limit(0)).count() == 0


def test_odd_rows(spark):
    got = {(r[0], *r[1:]) for r in lines.drop_recurring_lines(made(spark)).collect()}
    assert (1000, 1, 0, "") in got and (1001, 1, 0, "") in got and (3, 1, 1, "") in got
    assert (None, 2, 1, "a b") in got


def test_leaves_of_the_same_lines_are_sent_once(spark, monkeypatch):
    """Lines that differ in the middle went to five leaves each, to be named there five times alike."""
    sent, members = [], lines._members

    def counted(*args):
        rows = members(*args)
        sent.append(sorted((r.content, r.block) for r in rows.collect()))
        return rows

    monkeypatch.setattr(lines, "_members", counted)
    one, two, head = (f"one two three four {w} and so on" for w in ("five", "six", "seven"))
    head = head.replace("so on", "not so")
    docs = spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string").coalesce(1)
    assert {r.n_dropped for r in lines.drop_recurring_lines(docs).collect()} == {1}
    assert [content for content, _ in sent[0]] == [one, two]
    # Its first tokens lead to leaves with the others, its last ones do not. Each block knows both kinds of leaves.
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([one, two, head, one, two, head])], "doc_id long, text string")
    lines.drop_recurring_lines(docs.repartition(3, "doc_id")).collect()
    places = {(content, block) for content, block in sent[1]}
    assert sent[1] == sorted([*places, *(p for p in places if p[0] != head)])


def test_lines_together_are_masked_as_one_by_one():
    odd = ["", " ", "a", "a  b", " a", "a ", "\ta", "a\r", "a\x0bb\x0cc", "a1 b", "x 12", "é  9", " a  ", "٣ a", "<*> a", "a\x00 1"]
    assert lines._masked(pa.array(odd)).to_pylist() == [lines.masked(line) for line in odd]


def test_names_of_a_leaf_are_those_of_its_counts():
    pick = random.Random(5)
    for size, kinds in ((1, 3), (4, 2), (6, 9), (9, 40)):
        for _ in range(30):
            rows = {tuple(pick.choice(["a", "b", lines.VARIABLE, str(pick.random())]) for _ in range(size)) for _ in range(kinds)}
            held = [[row[i] for row in rows] for i in range(size)]
            expected = {}
            for row in rows if 3 * sum(len(set(place)) < len(rows) for place in held) >= 2 * size else ():
                own = expected[row] = set()
                for level in (n for n in lines.LEVELS if n < 4 * len(rows) + 8):
                    name = [t if t == lines.VARIABLE or place.count(t) >= level else None for t, place in zip(row, held)]
                    if 3 * sum(t is not None for t in name) >= 2 * size:
                        own.add(" ".join(t or lines.VARIABLE for t in name))
            assert lines.leaf_names({row: " ".join(row) for row in rows}) == expected
