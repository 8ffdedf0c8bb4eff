"""Exact deduplication by deterministic block naming.

Texts are cut into blocks of a fixed number of bytes. The distinct blocks are sorted and numbered; then the names of
adjacent blocks are paired and the distinct pairs numbered again, level by level, until one name is left per document.
Documents with the same number of blocks carry the same last name exactly if their texts are equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchkit.errors import DataError
from batchkit.session import land

BLOCK_BYTES = 16_384


def blocks_of(text: Column, block_bytes: int) -> Column:
    """The text's UTF-8 bytes in blocks; a null or empty text is one empty block."""
    data = F.coalesce(text, F.lit("")).cast("binary")
    last = F.greatest(F.octet_length(data) - 1, F.lit(0))
    starts = F.sequence(F.lit(0), (last / block_bytes).cast("int"))
    return F.transform(starts, lambda i: F.substring(data, i * block_bytes + 1, F.lit(block_bytes)))


def numbered(distinct: DataFrame, *keys: str) -> DataFrame:
    """Distinct rows with an integer ``name`` each.

    Rows are sorted inside their partition before they are numbered, so a task that runs again gives the same names.
    """
    return distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def block_names(docs: DataFrame, text_col: str, block_bytes: int) -> DataFrame:
    """(digest, name) of the distinct blocks.

    Only here whole blocks are shuffled, and copies inside one task only once. Later steps find a block's name by its
    SHA-256, which is checked to differ for all blocks: names stay free of collisions.
    """
    blocks = docs.select(F.explode(blocks_of(F.col(f"`{text_col}`"), block_bytes)).alias("block"))
    named = numbered(blocks.distinct(), "block")
    names = land(named.select(F.unhex(F.sha2("block", 256)).alias("digest"), "name"), "blocks")
    if not names.groupBy("digest").count().filter("count > 1").isEmpty():
        raise DataError("two different blocks have the same SHA-256")
    return names


def _pair_up(parts: DataFrame) -> DataFrame:
    """One level: (row, n, pos, name) with half as many parts; an odd last part is paired with nothing."""
    half = F.col("pos") % 2
    pairs = parts.groupBy("row", "n", F.shiftright("pos", 1).alias("pos")).agg(
        F.max(F.when(half == 0, F.col("name"))).alias("left"),
        F.coalesce(F.max(F.when(half == 1, F.col("name"))), F.lit(-1)).alias("right"),
    )
    names = land(numbered(pairs.select("left", "right").distinct(), "left", "right"), "pairs")
    named = pairs.join(names, ["left", "right"])
    return land(named.select("row", F.shiftright(F.col("n") + 1, 1).alias("n"), "pos", "name"), "parts")


def name_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per input row: ``row`` (a key of its own), ``id``, ``n_blocks``, ``name``, ``sha256`` of the text.

    (n_blocks, name) identifies the text.
    """
    names = block_names(docs, text_col, block_bytes)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    digests = F.transform(blocks_of(text, block_bytes), lambda block: F.unhex(F.sha2(block, 256)))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").alias("id"),
        F.unhex(F.sha2(text, 256)).alias("sha256"),
        digests.alias("digests"),
    )
    occurrences = rows.select(
        "row", "id", "sha256", F.size("digests").alias("n_blocks"), F.posexplode("digests").alias("pos", "digest")
    )
    named = land(occurrences.join(names, "digest").drop("digest"), "named")

    long = named.filter("n_blocks > 1")
    parts = long.select("row", F.col("n_blocks").alias("n"), "pos", "name")
    most = long.agg(F.max("n_blocks")).first()[0] or 1
    last = []
    for _ in range((most - 1).bit_length()):
        parts = _pair_up(parts)
        last.append(parts.filter("n = 1").select("row", "name"))
        parts = parts.filter("n > 1")
    whole = named.filter("n_blocks = 1").select("row", "id", "n_blocks", "name", "sha256")
    if last:
        tops = last[0]
        for level in last[1:]:
            tops = tops.unionByName(level)
        firsts = long.filter("pos = 0").select("row", "id", "n_blocks", "sha256")
        whole = whole.unionByName(firsts.join(tops, "row").select(*whole.columns))
    return land(whole, "identities")


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Per row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Of equal texts the row with the largest id stays; if rows repeat that id, one of them. A null text equals an empty
    one, a null id is smaller than any other. Columns besides the two named ones are not read. An empty table gives no
    rows. Group sizes and keepers combine on the map side, and the joins are plain equi-joins of small rows that AQE
    can split, so a group with a third of all rows is no hot spot.
    """
    named = name_documents(docs, id_col, text_col, block_bytes)
    identity = ["n_blocks", "name"]
    groups = land(
        named.groupBy(*identity).agg(
            F.max(F.struct("id", "row")).alias("keeper"), F.count(F.lit(1)).alias("group_size")
        ),
        "groups",
    )
    return named.join(groups, identity).select(
        F.col("id").alias(id_col),
        F.col("keeper.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keeper.row")).alias("kept"),
        F.lower(F.hex("sha256")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns, whatever their names; rows that repeat id and text leave one.

    A null text equals an empty one, a null id is larger than none. An empty table gives no rows.
    """
    decided = land(exact_duplicates(docs, id_col, text_col), "decided")
    stays = decided.filter("kept").select(F.col(f"`{id_col}`").alias("stay_id"), F.col("text_sha256").alias("stay_sha"))
    counted = decided.groupBy(F.col(f"`{id_col}`").alias("stay_id")).agg(F.count(F.lit(1)).alias("n"))
    repeated = land(counted.filter("n > 1").select("stay_id"), "repeated")
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, F.col(f"`{id_col}`").alias("id"), F.sha2(text, 256).alias("sha"))
    own = F.col("id").eqNullSafe(F.col("stay_id"))
    rest = rows.join(stays, own & (F.col("sha") == F.col("stay_sha")), "left_semi")
    if not repeated.isEmpty():
        once = rest.join(repeated, own, "left_semi").dropDuplicates(["id", "sha"])
        rest = rest.join(repeated, own, "left_anti").unionByName(once)
    return rest.select("row.*")
