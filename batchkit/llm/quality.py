"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one ``failed`` word whose bit i is
set where rule i failed; a policy is a mask of bits, so another version of a policy, or the effect of leaving a rule
out, is read from the ledger by bitwise operations without touching a text again.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
WINDOW = 8

# Characters of scripts written without spaces: Thai to Myanmar, Khmer, kana, Bopomofo, Han.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u312f\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_repeat_words",
    "n_alpha_words",
    "n_dup_line_words",
    "n_spaced_words",
    "spaced_chars",
)
MEASURE_TYPE = T.StructType([T.StructField(name, T.LongType()) for name in MEASURES])


@dataclass(frozen=True)
class Rule:
    """A test on the measurements; its place in ``RULES`` is its bit and must never change."""

    name: str
    fails: Column


def _rules() -> tuple[Rule, ...]:
    words, symbols = F.col("n_words"), F.col("n_symbols")
    return (
        Rule("few_words", words < 20),
        Rule("repeated_windows", 100 * F.col("n_repeat_words") > 30 * words),
        Rule("many_symbols", 100 * symbols > 10 * words),
        Rule("repeated_lines", 100 * F.col("n_dup_lines") > 30 * F.col("n_lines")),
        Rule("short_words", F.col("word_chars") < 2 * words),
        Rule("long_words", F.col("word_chars") > 15 * words),
        Rule("few_letters", 100 * F.col("n_alpha_words") < 70 * words),
        Rule("repeated_line_words", 100 * F.col("n_dup_line_words") > 30 * words),
        Rule("long_spaced_words", F.col("spaced_chars") > 15 * F.col("n_spaced_words")),
    )


RULE_NAMES = (
    "few_words",
    "repeated_windows",
    "many_symbols",
    "repeated_lines",
    "short_words",
    "long_words",
    "few_letters",
    "repeated_line_words",
    "long_spaced_words",
)


def mask_of(*names: str) -> int:
    return sum(1 << RULE_NAMES.index(name) for name in names)


BASE = mask_of("few_words", "repeated_windows")
# Versions are never changed, only added.
POLICIES = {
    "base": BASE,
    "v1": BASE | mask_of("many_symbols", "repeated_lines", "short_words", "long_words", "few_letters"),
    # Repeated lines by their share of words, long words only in scripts written with spaces.
    "v2": BASE | mask_of("many_symbols", "repeated_line_words", "short_words", "long_spaced_words", "few_letters"),
}
CURRENT = "v2"


def _names(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """An integer for each pair, equal for equal pairs only."""
    return np.unique(left.astype(np.int64) << 32 | right, return_inverse=True)[1]


def repeated_words(words: list[str]) -> int:
    """Words inside ``WINDOW``-word windows that the text holds twice or more.

    Windows get exact names: those of 2, 4 and 8 words from the pairs of names of half the length.
    """
    if len(words) <= WINDOW:
        return 0
    seen: dict[str, int] = {}
    names = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    width = 1
    while width < WINDOW:
        names = _names(names[:-width], names[width:])
        width *= 2
        if names.max() == len(names) - 1:  # all different: so are all longer windows
            return 0
    starts = np.flatnonzero(np.bincount(names)[names] > 1)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(change)))


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``; a null text counts as empty."""
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    again = [line for line, n in Counter(lines).items() for _ in range(n - 1)]
    spaced = words if text.isascii() else [w for w in words if not UNSPACED.search(w)]
    return (
        len(words),
        sum(map(len, words)),
        sum(map(text.count, SYMBOLS)),
        len(lines),
        len(again),
        repeated_words(words),
        sum(1 for w in words if w[0].isalpha() or w[-1].isalpha()),
        sum(len(WORD.findall(line)) for line in again),
        len(spaced),
        sum(map(len, spaced)),
    )


@F.pandas_udf(MEASURE_TYPE)
def _measures(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame([measure(t) for t in texts], columns=list(MEASURES), dtype="int64")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, measurements and ``failed``, the bits of the rules it breaks.

    No shuffle: each text is read once where it lies, whole. Null and empty texts have no words and fail
    ``few_words`` alone. Repeated rows and ids give a row each; other columns are not read.
    """
    measured = docs.select(F.col(id_col), _measures(F.col(text_col)).alias("_m")).select(id_col, "_m.*")
    return measured.withColumn("failed", failed_bits())


def failed_bits() -> Column:
    bits = [F.when(rule.fails, F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(_rules())]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return total.cast("bigint")


def breaks(policy: str) -> Column:
    """Whether a ledger row breaks a rule of the policy."""
    return F.col("failed").bitwiseAND(F.lit(POLICIES[policy])) != 0


def apply_policy(ledger_rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` under the policy."""
    return ledger_rows.withColumns({"base_failed": breaks("base"), "kept": ~breaks(policy) & ~breaks("base")})


def keep_documents(docs: DataFrame, policy: str = CURRENT, text_col: str = "text") -> DataFrame:
    """The rows the policy keeps, with all their columns as they were, whatever their names.

    Null and empty texts have no words and go. Rows that repeat an id or a text are judged one by one; an empty table
    gives no rows.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    measured = docs.select(row, _measures(F.col(f"`{text_col}`")).alias("_m")).select("_row", "_m.*")
    kept = apply_policy(measured.withColumn("failed", failed_bits()), policy).filter("kept")
    return kept.select("_row.*")


def ablation(ledger_rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of the policy: documents that break it, and those that only it rejects.

    One pass over the ledger with sums that combine on the map side; an empty ledger gives zeros.
    """
    mask = POLICIES[policy]
    within = F.col("failed").bitwiseAND(F.lit(mask))
    bits = [(i, name) for i, name in enumerate(RULE_NAMES) if mask >> i & 1]
    counts = ledger_rows.agg(
        *[F.count_if(within.bitwiseAND(F.lit(1 << i)) != 0).alias(f"any{i}") for i, _ in bits],
        *[F.count_if(within == F.lit(1 << i)).alias(f"only{i}") for i, _ in bits],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                F.col(f"any{i}").alias("n_failed"),
                F.col(f"only{i}").alias("n_only"),
            )
            for i, name in bits
        ]
    )
    return counts.select(F.inline(rows))
