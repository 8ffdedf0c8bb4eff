"""Quotes of delimited text: which of them open and close cells.

A quote opens a cell only where the cell begins. Inside it a doubled quote stands for one, and any other quote ends the
quoted part; what follows up to the separator belongs to the cell. A quote elsewhere is an ordinary character.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

QUOTE = '"'

BEGIN, OUTSIDE, INSIDE, AFTER = 0, 1, 2, 3  # AFTER: behind a quote that ends the quoted part, unless another follows


def inside_after(line: bytes, inside: bool, sep: bytes = b",") -> bool:
    """Whether a line ends in a quoted cell, given whether it begins in one."""
    state = INSIDE if inside else BEGIN
    *before, _ = line.split(b'"')
    for part in before:
        if state == INSIDE:
            state = AFTER
        elif part.endswith(sep) or (not part and state != OUTSIDE):
            state = INSIDE
        else:
            state = OUTSIDE
    return state == INSIDE


def _walk(record: Column, sep: str) -> Column:
    """The state behind the last quote, and the separators outside quoted cells up to it."""
    parts = F.split(record, QUOTE)

    def step(seen: Column, part: Column) -> Column:
        state = seen["state"]
        opens = F.endswith(part, F.lit(sep)) | ((part == "") & (state != OUTSIDE))
        following = F.when(state == INSIDE, F.lit(AFTER)).when(opens, F.lit(INSIDE)).otherwise(F.lit(OUTSIDE))
        found = F.when(state == INSIDE, F.lit(0)).otherwise(_count(part, sep))
        return F.struct(following.alias("state"), (seen["seps"] + found).alias("seps"))

    start = F.struct(F.lit(BEGIN).alias("state"), F.lit(0).alias("seps"))
    return F.aggregate(F.slice(parts, 1, F.size(parts) - 1), start, step)


def _count(text: Column, sep: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sep), F.lit("")))


def ends_inside(line: Column, sep: str = ",") -> Column:
    """Whether a line that begins a record ends in a quoted cell: the record goes on in the next line."""
    return F.contains(line, F.lit(QUOTE)) & (_walk(line, sep)["state"] == INSIDE)


def cell_count(record: Column, sep: str = ",") -> Column:
    """The number of cells of a record; separators in quoted cells do not count."""
    walked = _walk(record, sep)
    rest = F.when(walked["state"] == INSIDE, F.lit(0)).otherwise(_count(F.substring_index(record, QUOTE, -1), sep))
    return F.when(F.contains(record, F.lit(QUOTE)), walked["seps"] + rest).otherwise(_count(record, sep)) + 1
