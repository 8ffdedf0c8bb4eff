"""Numbers from text, exact money text, shares and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from batchkit.functions.text import strip_ws

AMOUNT_TYPE = "decimal(38,10)"
MONEY_TYPE = "decimal(38,2)"

# The texts of an infinite number, in lower case.
INFINITE = ("inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")


def to_number(text: Column) -> Column:
    """Text to double; NULL (never NaN) where the text is no number.

    Java's parser also takes a type suffix (5d, 5f) and hexadecimals. A text that ends in a digit or a
    point and has no x is neither.
    """
    trimmed = strip_ws(text)
    last = F.substring(text, -1, 1)
    # The last character of the trimmed text is only looked for where the text as it is has no digit there.
    digit = F.when((last >= "0") & (last <= "9"), F.lit(True)).otherwise(
        F.substring(trimmed, -1, 1).between("0", "9") | trimmed.endswith(".")
    )
    decimal = digit & ~F.contains(trimmed, F.lit("x")) & ~F.contains(trimmed, F.lit("X"))
    return F.when(decimal | F.lower(trimmed).isin(*INFINITE), trimmed.try_cast("double"))


def _plausible(trimmed: Column, *never: str) -> Column:
    """False for texts that are surely no number: a failing cast costs far more than this test.

    Digits outside ASCII are left to the cast.
    """
    last = F.substring(trimmed, -1, 1)
    result = last.between("0", "9") | (last == ".") | (last > "~")
    for char in never:
        result = result & ~F.contains(trimmed, F.lit(char))
    return result


def to_amount(text: Column) -> Column:
    """Text to exact decimal; NULL where it is no finite decimal number."""
    trimmed = strip_ws(text)
    return F.when(_plausible(trimmed, ",", "_"), trimmed.try_cast(AMOUNT_TYPE))


def to_count(text: Column) -> Column:
    """Text to a whole number; NULL where it is none."""
    trimmed = strip_ws(text)
    return F.when(_plausible(trimmed, ",", "_", "."), trimmed.try_cast("bigint"))


def to_money(amount: Column) -> Column:
    """An exact amount with two places, ties to the even digit."""
    return F.bround(amount, 2).cast(MONEY_TYPE)


def money_text(amount: Column) -> Column:
    """``to_money`` as text."""
    return to_money(amount).cast("string")


def share(part: Column, total: Column) -> Column:
    """``part / total`` as a double; NULL where the total is 0."""
    return F.try_divide(part.cast("double"), total.cast("double"))


def two_places(x: Column) -> Column:
    """Text of a double in [0, 1e12] with two places, rounded as C's ``%.2f``.

    ``format_string`` rounds the shortest decimal form half up. C, Python and SQL engines round the
    binary value itself, ties to even, so 2.675 gives 2.67 and 0.125 gives 0.12. The product with 100
    can look like a tie only by rounding; its exact error, from the two halves of ``x``, decides then.
    """
    product = x * F.lit(100.0)
    high = x.cast("float").cast("double")
    error = (high * F.lit(100.0) - product) + (x - high) * F.lit(100.0)
    false_tie = (product - F.floor(product) == F.lit(0.5)) & (error != 0)
    cents = F.when(false_tie, F.floor(product) + F.when(error > 0, 1).otherwise(0)).otherwise(
        F.rint(product).cast("bigint")
    )
    return (cents.cast("decimal(20,0)") / F.lit(100)).cast("decimal(20,2)").cast("string")


def percent_text(part: Column, total: Column) -> Column:
    """``part`` of ``total`` in percent with two places; ``0.00%`` where the total is 0."""
    percent = part.cast("double") / F.nullif(total.cast("double"), F.lit(0.0)) * F.lit(100.0)
    return F.when(total == 0, F.lit("0.00%")).otherwise(F.concat(two_places(percent), F.lit("%")))


def round_nearest(x: Column) -> Column:
    """The nearest whole number, ties towards plus infinity."""
    return F.floor(x + F.lit(0.5)).cast("bigint")


def number_text(x: Column) -> Column:
    """The shortest plain text of a number: 12.0 gives ``12``, 12.50 gives ``12.5``; NULL stays NULL."""
    text = F.regexp_replace(F.format_string("%.17f", x.cast("double")), r"\.?0+$", "")
    return F.when(x.isNotNull(), text)


def with_unit(text: Column, unit: str) -> Column:
    """A number's text followed by its unit; NULL where there is no number."""
    return F.concat(text, F.lit(unit))
