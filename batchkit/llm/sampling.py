"""A bounded sample of texts for a fit, the same on every run, without whole rows on the way to the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_texts(rows: DataFrame, id_col: str, text: Column, most: int) -> list[str]:
    """The different texts of the ``most`` rows that come first in order of a hash of their id, then of the text's.

    Tasks offer pairs of hashes only; the texts of the pairs that win are fetched by them. Null texts are left out.
    """
    hashed = rows.select(F.xxhash64(F.col(f"`{id_col}`")).alias("place"), text.alias("text"))
    hashed = hashed.filter(F.col("text").isNotNull()).withColumn("digest", F.xxhash64("text"))
    won = hashed.select("place", "digest").orderBy("place", "digest").limit(most).collect()
    if not won:
        return []
    pairs = F.array(*[F.struct(F.lit(r.place).alias("place"), F.lit(r.digest).alias("digest")) for r in won])
    near = hashed.filter(F.col("place") <= won[-1].place)
    chosen = near.filter(F.array_contains(pairs, F.struct("place", "digest"))).dropDuplicates(["place", "digest"])
    return [r.text for r in sorted(chosen.collect(), key=lambda r: (r.place, r.digest))]
