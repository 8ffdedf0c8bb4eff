"""Exact sums of decimal numbers of any usual size, from text or from doubles.

A number below 10**15 with at most ten decimals is ``plain``, a ``decimal(38,10)``. Any other below 10**81 with at most 27 decimals is
``wide``: four limbs of 27 digits, the least first, of which the first holds the decimals. Limbs are summed like any
other columns, on the map side too, and joined with their carries at the end. Nothing is rounded before that.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from batchkit.functions.numbers import AMOUNT_TYPE, MONEY_TYPE, _plausible
from batchkit.functions.text import strip_ws

LIMB_DIGITS = 27
WHOLE_LIMBS = 3
LIMBS = tuple(f"limb_{n}" for n in range(WHOLE_LIMBS + 1))
BOUND = 1e81  # 10 ** (LIMB_DIGITS * WHOLE_LIMBS)

INVALID = "invalid"
OUT_OF_RANGE = "out_of_range"
TOO_FINE = "too_fine"

_NUMBER = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
_PLAIN_DIGITS, _PLAIN_DECIMALS = 15, 10


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body has it."""
    return F.transform(F.array(value), body)[0]


def _power(n: int) -> Column:
    """10 ** n as an exact decimal."""
    return F.lit(Decimal(10**n))


def _digits(trimmed: Column) -> Column:
    """A text as a number: whether it is one, its significant digits, how many of them are decimals (below 0: zeros
    follow; NULL: the exponent is beyond all bounds), its sign and its exponent."""
    decimals = F.regexp_extract(trimmed, r"\.([0-9]*)", 1)
    exponent = F.regexp_extract(trimmed, "[eE]([+-]?[0-9]+)$", 1)
    power = F.when(exponent == "", F.lit(0)).otherwise(exponent.try_cast("int"))
    written = F.ltrim(F.concat(F.regexp_extract(trimmed, "^[+-]?([0-9]*)", 1), decimals), F.lit("0"))

    def shortened(written: Column) -> Column:
        return _let(
            F.rtrim(written, F.lit("0")),
            lambda digits: F.struct(
                F.coalesce(F.rlike(trimmed, F.lit(_NUMBER)), F.lit(False)).alias("number"),
                digits.alias("digits"),
                (F.length(decimals) - power - (F.length(written) - F.length(digits))).alias("scale"),
                (trimmed.startswith("-") & (digits != "")).alias("negative"),
                exponent.startswith("-").alias("small"),
            ),
        )

    return _let(written, shortened)


def _limbs(digits: Column, scale: Column, negative: Column) -> Column:
    """Signed limbs of a number whose size has been looked at."""
    size = LIMB_DIGITS * len(LIMBS)
    fixed = F.when(digits == "", F.repeat(F.lit("0"), size)).otherwise(
        F.lpad(F.concat(digits, F.repeat(F.lit("0"), LIMB_DIGITS - scale)), size, "0")
    )
    sign = F.when(negative, F.lit(-1)).otherwise(F.lit(1)).cast("decimal(1,0)")

    def cut(fixed: Column) -> Column:
        parts = [F.substring(fixed, size - LIMB_DIGITS * (n + 1) + 1, LIMB_DIGITS) for n in range(len(LIMBS))]
        return F.struct(
            *[(part.cast("decimal(27,0)") * sign).cast("decimal(28,0)").alias(c) for part, c in zip(parts, LIMBS)]
        )

    return _let(fixed, cut)


def _sized(number: Column, digits: Column, scale: Column, negative: Column, small: Column) -> Column:
    """(wide, fault, negative) of a number's parts."""
    fault = (
        F.when(~number, F.lit(INVALID))
        .when(digits == "", F.lit(None))
        .when(scale.isNull(), F.when(small, F.lit(TOO_FINE)).otherwise(F.lit(OUT_OF_RANGE)))
        .when(F.length(digits) - scale > LIMB_DIGITS * WHOLE_LIMBS, F.lit(OUT_OF_RANGE))
        .when(scale > LIMB_DIGITS, F.lit(TOO_FINE))
    )
    return _let(
        fault,
        lambda why: F.struct(
            F.when(why.isNull(), _limbs(digits, scale, negative)).alias("wide"),
            why.alias("fault"),
            negative.alias("negative"),
        ),
    )


def _wide(trimmed: Column) -> Column:
    """(wide, fault, negative) of any text."""
    return _let(_digits(trimmed), lambda d: _sized(d["number"], d["digits"], d["scale"], d["negative"], d["small"]))


def _chosen(plain: Column, text: Column) -> Column:
    """The struct of a number whose text is looked at only if it is not plain.

    Each part is computed once, and as the whole is no plain struct, Spark does not work it out again for every field.
    """

    def parts(plain: Column, wide: Column) -> Column:
        return F.struct(
            plain.alias("plain"),
            wide["wide"].alias("wide"),
            F.when(plain.isNull(), wide["fault"]).alias("fault"),
            F.coalesce(plain < 0, wide["negative"], F.lit(False)).alias("negative"),
        )

    def known(plain: Column) -> Column:
        wide = F.when(plain.isNull(), _let(F.coalesce(text, F.lit("")), _wide))
        return _let(wide, lambda wide: parts(plain, wide))

    return _let(plain, known)


def is_short(trimmed: Column, digits: int, places: int) -> Column:
    """Whether a text, if it is a number, has no exponent and no more digits before and behind the point."""
    point = F.instr(trimmed, ".")
    whole = F.when(point == 0, F.length(trimmed)).otherwise(point - 1)
    fits = (whole <= digits) & ((point == 0) | (F.length(trimmed) - point <= places))
    exponent = F.contains(trimmed, F.lit("e")) | F.contains(trimmed, F.lit("E"))
    return fits & ~exponent & _plausible(trimmed, ",", "_")


def from_text(text: Column) -> Column:
    """A number's text as a struct: ``plain`` or ``wide`` is set, or ``fault`` says why neither is; ``negative``.

    The text is trimmed; a short one without exponent goes through a cast.
    """

    def parsed(trimmed: Column) -> Column:
        return _chosen(F.when(is_short(trimmed, _PLAIN_DIGITS, _PLAIN_DECIMALS), trimmed.try_cast(AMOUNT_TYPE)), trimmed)

    return _let(strip_ws(text), parsed)


def from_double(number: Column) -> Column:
    """The same of a double, which stands for a short decimal that is read back as it."""
    plain = number.try_cast(AMOUNT_TYPE)
    same = (plain.cast("double") == number) & (F.abs(number) < 10.0**_PLAIN_DIGITS)
    return _chosen(F.when(same, plain), number.cast("string"))


def product(left: Column, right: Column) -> Column:
    """The product of two texts as the same struct, never plain. Each may have 18 significant digits."""

    def multiplied(a: Column, b: Column) -> Column:
        fits = F.greatest(F.length(a["digits"]), F.length(b["digits"])) <= 18
        factors = [F.when(fits, F.concat(F.lit("0"), x["digits"])).cast("decimal(19,0)") for x in (a, b)]
        digits = F.ltrim((factors[0] * factors[1]).cast("string"), F.lit("0"))
        scale = F.when(fits, a["scale"] + b["scale"])
        both = F.struct(digits.alias("digits"), scale.alias("scale"))
        known = a["number"] & b["number"]
        sign = a["negative"] != b["negative"]
        return _let(
            both,
            lambda p: _sized(
                known, F.coalesce(p["digits"], F.lit("1")), p["scale"], sign & (F.coalesce(p["digits"], F.lit("1")) != ""),
                fits & (a["small"] | b["small"]),
            ),
        )

    texts = [_digits(F.coalesce(strip_ws(text), F.lit(""))) for text in (left, right)]
    return _let(texts[0], lambda a: _let(texts[1], lambda b: multiplied(a, b)))


def sum_limbs(wide: Column, prefix: str) -> list[Column]:
    """Aggregates: the sums of the limbs, exact for up to 10**11 numbers."""
    return [F.sum(wide[c]).alias(f"{prefix}{c}") for c in LIMBS]


_WHOLE = "decimal(38,0)"


def _carried(parts: Column) -> Column:
    """An array of limbs from 0 up to the base, and what is carried out of the last."""
    base = _power(LIMB_DIGITS)

    def step(state: Column, part: Column) -> Column:
        def add(total: Column) -> Column:
            return _let(
                F.pmod(total, base).cast(_WHOLE),
                lambda rest: F.struct(
                    F.array_append(state["limbs"], rest).alias("limbs"),
                    F.floor((total - rest) / base).cast(_WHOLE).alias("carry"),
                ),
            )

        return _let((state["carry"] + part).cast(_WHOLE), add)

    start = F.struct(F.array().cast(f"array<{_WHOLE}>").alias("limbs"), F.lit(0).cast(_WHOLE).alias("carry"))
    return F.aggregate(parts, start, step)


def _limbs_of_plain(plain: Column, places: int) -> Column:
    base = _power(LIMB_DIGITS)

    def split(whole: Column) -> Column:
        # Of these types the difference is exact; of wider ones it would lose decimals.
        decimals = plain.cast(f"decimal(37,{places})") - whole.cast(f"decimal({37 - places},0)")
        decimals = (decimals.cast(f"decimal({places + 1},{places})") * _power(places)).cast(f"decimal({places + 1},0)")
        return _let(
            F.pmod(whole, base).cast(_WHOLE),
            lambda low: F.array(
                (decimals * _power(LIMB_DIGITS - places)).cast(_WHOLE), low, F.floor((whole - low) / base).cast(_WHOLE)
            ),
        )

    return _let(F.floor(plain).cast(_WHOLE), split)


def _shown(limbs: Column, top: Column, negative: Column) -> Column:
    """The text of limbs, rounded to two places."""
    cent, half = _power(LIMB_DIGITS - 2), F.lit(Decimal(5 * 10 ** (LIMB_DIGITS - 3)))

    def text(cents: Column) -> Column:
        over = (cents == 100).cast(_WHOLE)
        integers = _carried(F.concat(F.array((limbs[1] + over).cast(_WHOLE)), F.slice(limbs, 3, WHOLE_LIMBS - 1), F.array(top)))
        padded = F.transform(F.reverse(integers["limbs"]), lambda x: F.lpad(x.cast("string"), LIMB_DIGITS, "0"))
        digits = F.ltrim(F.array_join(padded, ""), F.lit("0"))
        shown = F.concat(digits, F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))
        return _let(
            F.when(shown.startswith("."), F.concat(F.lit("0"), shown)).otherwise(shown),
            lambda whole: F.when(negative & (whole != "0.00"), F.concat(F.lit("-"), whole)).otherwise(whole),
        )

    def rounded(rest: Column) -> Column:
        return _let(
            ((limbs[0] - rest) / cent).cast("int"),
            lambda cents: _let(cents + ((rest > half) | ((rest == half) & (cents % 2 == 1))).cast("int"), text),
        )

    return _let(F.pmod(limbs[0], cent), rounded)


def joined_text(plain: Column, sums: list[Column], places: int = _PLAIN_DECIMALS) -> Column:
    """The text, with two places and ties to the even digit, of a sum of plain numbers and of limbs.

    ``plain`` has ``places`` decimals.
    """
    zero = F.lit(0).cast(_WHOLE)
    own = F.concat(_limbs_of_plain(F.coalesce(plain, F.lit(0).cast(f"decimal(38,{places})")), places), F.array(zero))
    given = F.array(*[F.coalesce(x, zero).cast(_WHOLE) for x in sums])
    totals = F.zip_with(own, given, lambda x, y: (x + y).cast(_WHOLE))

    def signed(total: Column) -> Column:
        return _let(
            _carried(total)["carry"] < 0,
            lambda negative: _let(
                _carried(F.transform(total, lambda x: F.when(negative, -x).otherwise(x))),
                lambda carried: _shown(carried["limbs"], carried["carry"], negative),
            ),
        )

    return _let(totals, signed)


def joined_money(plain: Column, sums: list[Column], places: int = _PLAIN_DECIMALS) -> Column:
    """The same as ``decimal(38,2)``; a sum of 10**36 or more raises."""
    return joined_text(plain, sums, places).cast(MONEY_TYPE)
