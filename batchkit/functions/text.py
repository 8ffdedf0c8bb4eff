"""Text columns: trimming, missing-value tokens, prefixes, labels, digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Python's str.strip removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The tokens that pandas.read_csv takes for a missing value.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def _printable(char: Column) -> Column:
    return (char > " ") & (char <= "~")


def strip_ws(text: Column) -> Column:
    """Remove whitespace of every kind from both ends (Spark's ``trim`` removes spaces only).

    Most texts begin and end with a printable ASCII character; testing that is far cheaper than the
    search in the list of whitespace characters.
    """
    bare = _printable(F.substring(text, 1, 1)) & _printable(F.substring(text, -1, 1))
    return F.when(bare, text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def strip_or_empty(text: Column) -> Column:
    """Trimmed text, with a missing value as the empty string."""
    return F.coalesce(strip_ws(text), F.lit(""))


def na_to_null(text: Column) -> Column:
    """NULL where the whole cell is a missing-value token."""
    return F.when(~text.isin(*NA_TOKENS), text)


def has_mark(text: Column, mark: str = "C") -> Column:
    """True where the trimmed, upper-cased text starts with ``mark``; a missing text is false."""
    bare = _printable(F.substring(text, 1, 1))
    begin = F.when(bare, text).otherwise(F.ltrim(text, F.lit(WHITESPACE)))
    return F.coalesce(F.startswith(F.upper(F.substring(begin, 1, len(mark))), F.lit(mark)), F.lit(False))


def or_label(text: Column, label: str) -> Column:
    """A constant label in place of a missing value."""
    return F.coalesce(text, F.lit(label))


def join_parts(*parts: Column, sep: str = ", ") -> Column:
    """The non-blank parts joined by ``sep``."""
    return F.concat_ws(sep, *[F.nullif(part, F.lit("")) for part in parts])


def digest(content: Column) -> Column:
    """SHA-256 of a text or binary column, in hexadecimal."""
    return F.sha2(content, 256)
