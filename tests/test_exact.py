"""Exact sums against Python's decimal and integer arithmetic."""

import random
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from batchkit.functions import exact
from batchkit.operators import orders


def number(pick):
    digits = "".join(pick.choices("0123456789", k=pick.choice([1, 3, 9, 17, 30])))
    kind = pick.random()
    if kind < 0.3:
        return digits[:12] + "." + digits[:2]
    if kind < 0.5:
        return "0." + "0" * pick.randint(0, 8) + digits[:15]
    if kind < 0.7:
        return digits[:3] + pick.choice(["e", "E"]) + pick.choice(["", "+", "-"]) + str(pick.randint(0, 20))
    return digits + pick.choice(["", ".", ".5", ".005", "e10"])


def rounded(total):
    with localcontext() as context:
        context.prec = 200
        return format(total.quantize(Decimal("0.01"), rounding="ROUND_HALF_EVEN"), "f")


def exact_sum(texts):
    with localcontext() as context:
        context.prec = 200
        return rounded(sum((Decimal(t) for t in texts), Decimal(0)))


def summed(df, columns):
    rows = df.withColumn("x", columns).select("g", "x.*")
    totals = rows.groupBy("g").agg(F.sum("plain").alias("plain"), *exact.sum_limbs(F.col("wide"), ""))
    shown = totals.select("g", exact.joined_text(F.col("plain"), [F.col(c) for c in exact.LIMBS]).alias("total"))
    return {r.g: r.total for r in shown.collect()}


def test_sums_of_texts(spark):
    pick = random.Random(4)
    groups = {g: [pick.choice(["", "-", "+"]) + number(pick) for _ in range(pick.randint(1, 12))] for g in range(120)}
    groups[500] = ["1e30", "0.000000000000005", "-1e30"]
    groups[501] = ["9" * 60, "0.999"]
    groups[502] = ["0.125", "1e30"]
    groups[503] = ["0.135000000000000000000000001"]
    groups[504] = ["-0.0000000000001", "-0"]
    groups[505] = ["-1e60", "1", "-0.005"]
    df = spark.createDataFrame([(g, t) for g, own in groups.items() for t in own], "g int, t string").repartition(5)
    got = summed(df, exact.from_text(F.col("t")))
    want = {g: exact_sum(own).replace("-0.00", "0.00") if exact_sum(own) == "-0.00" else exact_sum(own) for g, own in groups.items()}
    assert got == want


def test_doubles_read_back(spark):
    pick = random.Random(5)
    values = [float(pick.choice(["", "-"]) + number(pick)) for _ in range(400)]
    df = spark.createDataFrame([(x,) for x in values], "x double").withColumn("e", exact.from_double(F.col("x")))
    with localcontext() as context:
        context.prec = 200
        for r in df.collect():
            limbs = r.e.wide and sum(Decimal(n).scaleb(exact.LIMB_DIGITS * (k - 1)) for k, n in enumerate(r.e.wide))
            value = r.e.plain if r.e.wide is None else limbs
            assert float(value) == r.x and len(value.normalize().as_tuple().digits) <= 18 and r.e.negative == (r.x < 0)


@pytest.mark.parametrize(
    "text, fault",
    [("abc", "invalid"), ("", "invalid"), (None, "invalid"), ("1_000", "invalid"), ("1,000", "invalid"), ("NaN", "invalid"),
     ("Infinity", "invalid"), ("0x10", "invalid"), ("1e", "invalid"), (".", "invalid"), ("1e81", "out_of_range"),
     ("1e99999999999", "out_of_range"), ("1e-28", "too_fine"), ("1e-99999999999", "too_fine"), ("0e99999999999", None),
     ("9" * 81, None), ("1e-27", None), (" 5 ", None), ("+5", None), ("5.", None), (".5", None), ("1e80", None)],
)
def test_faults(spark, text, fault):
    row = spark.createDataFrame([(text,)], "t string").select(exact.from_text(F.col("t")).alias("x")).first().x
    assert row.fault == fault and (row.plain is None and row.wide is None) == (fault is not None)


def test_products(spark):
    pick = random.Random(6)
    some = lambda: f"{pick.randint(0, 10 ** pick.randint(1, 9))}.{pick.randint(0, 10**8)}{pick.choice(['', 'e3', 'E-4'])}"
    pairs = [(g, some(), pick.choice(["", "-"]) + some()) for g in range(60) for _ in range(4)]
    pairs += [(900, "1e12", "0.1234567891"), (901, "200000000000", "3"), (902, "0", "1e70"), (903, "-0.000001", "0.00000001")]
    df = spark.createDataFrame(pairs, "g int, a string, b string").withColumn("x", exact.product(F.col("a"), F.col("b")))
    df = df.select("g", "x.*")
    assert df.filter("fault is not null").isEmpty()
    bad = [("1234567890123456789", "1", exact.OUT_OF_RANGE), ("x", "1", exact.INVALID), (None, "1", exact.INVALID),
           ("1e-20", "1e-20", exact.TOO_FINE), ("1e60", "1e60", exact.OUT_OF_RANGE)]
    told = spark.createDataFrame(bad, "a string, b string, why string").withColumn("x", exact.product(F.col("a"), F.col("b")))
    assert [r.x.fault for r in told.collect()] == [why for *_, why in bad]
    totals = df.groupBy("g").agg(*exact.sum_limbs(F.col("wide"), ""))
    got = totals.select("g", exact.joined_text(F.lit(None).cast("decimal(38,10)"), [F.col(c) for c in exact.LIMBS]).alias("t"))
    with localcontext() as context:
        context.prec = 200
        want = {}
        for g, a, b in pairs:
            want[g] = want.get(g, Decimal(0)) + Decimal(a) * Decimal(b)
        want = {g: "0.00" if rounded(t) == "-0.00" else rounded(t) for g, t in want.items()}
    assert {r.g: r.t for r in got.collect()} == want


def test_reasons_and_totals_of_orders(spark):
    rows = [("o1", "u1", "1e30"), ("o2", "u1", "0.000000000000005"), ("o3", "u1", "1e99"), ("o4", "u2", "1e-40"),
            ("o5", "u2", "-1e50"), ("o6", "u2", "1e40"), ("o7", "u2", "1e40"), ("o7", "u2", "1e40")]
    tagged = orders.tag_rejects(spark.createDataFrame(rows, "order_id string, user_id string, amount string"))
    reasons = {r.order_id: r.reason for r in orders.rejects(tagged).collect()}
    assert reasons == {"o3": orders.OUT_OF_RANGE, "o4": orders.TOO_FINE, "o5": orders.NEGATIVE}
    text = {r.user_id: r.total_amount for r in orders.totals_text(orders.order_rollup(tagged)).collect()}
    assert text == {"u1": "1" + "0" * 30 + ".00", "u2": "3" + "0" * 40 + ".00"}
    first = orders.user_summary(tagged.filter("user_id = 'u1'"), dedup=True).first()
    assert (first.order_count, first.total_amount) == (2, Decimal("1" + "0" * 30 + ".00"))
    with pytest.raises(Exception, match="NUMERIC_"):
        orders.user_summary(tagged).collect()


def test_typed_amounts(spark):
    rows = [(1, 1, 1e30), (2, 1, 0.1234567890123), (3, 1, float("inf")), (4, 1, float("nan")), (5, 1, -1.0), (6, 1, 1e90), (7, 1, 1e-30), (8, 1, None)]
    tagged = orders.tag_rejects(spark.createDataFrame(rows, "order_id int, user_id int, amount double"))
    reasons = {r.order_id: r.reason for r in tagged.collect()}
    bad = orders.BAD_AMOUNT
    assert reasons == {1: None, 2: None, 3: bad, 4: bad, 5: orders.NEGATIVE, 6: orders.OUT_OF_RANGE, 7: orders.TOO_FINE, 8: bad}
    first = orders.user_summary(tagged).first()
    assert (first.order_count, first.total_amount) == (2, Decimal("1" + "0" * 30 + ".12"))
