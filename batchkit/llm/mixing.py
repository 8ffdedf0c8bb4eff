"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected ``target / source size`` times. The expected copies are summed along the source
in order of size, a random offset is added, and a document is taken once for each whole number its part of the sum
crosses. In that order the words taken differ from the target by little more than one long document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchkit.session import land

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """(source, source_size, target): ``share`` of all sizes by weight, no target above ``most`` times its source.

    Sources are weighed in code-point order, null last, the weights repeating. What a full source cannot take goes to
    the others by weight. In order of limit per weight the full sources come first, so one pass finds the level at
    which the others stand. The pass runs over one row per source.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy(F.lit(0))
    place = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place - 1) % len(weights) + 1)
    scale = 1
    for w in weights:
        scale *= w
    listed = sources.withColumns(
        {"place": place, "weight": weight, "limit": most * F.col("source_size"), "total": F.sum("source_size").over(everything)}
    )
    order = everything.orderBy(F.expr(f"limit * ({scale} div weight)"), "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (share * F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0))) / F.sum("weight").over(onward)
    found = listed.withColumns({"nth": F.row_number().over(order), "level": level})
    fits = F.col("level") * F.col("weight") <= F.col("limit")
    first = F.min(F.when(fits, F.struct("nth", "level"))).over(everything)
    return found.withColumn("first", first).select(
        "source",
        "source_size",
        F.when(F.col("first").isNull() | (F.col("nth") < F.col("first.nth")), F.col("limit").cast("double"))
        .otherwise(F.col("first.level") * F.col("weight"))
        .alias("target"),
    )


def _before(keys: list[str], order: str) -> Column:
    window = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("n").over(window), F.lit(0))


def positions_before(sized: DataFrame) -> DataFrame:
    """Per (source, size, part): rows of the source that come before it.

    Counts are summed by size range, by size and by hash part, each window over a bounded number of sums: a source with
    a third of all rows is never sorted in one task.
    """
    parts = land(
        sized.groupBy("source", F.shiftright("size", 8).alias("range"), "size", "part").agg(F.count(F.lit(1)).alias("n")),
        "parts",
    )
    sizes = parts.groupBy("source", "range", "size").agg(F.sum("n").alias("n"))
    ranges = parts.groupBy("source", "range").agg(F.sum("n").alias("n"))
    in_size = parts.withColumn("in_size", _before(["source", "size"], "part")).drop("n").alias("p")
    in_range = sizes.withColumn("in_range", _before(["source", "range"], "size")).drop("n").alias("s")
    in_source = ranges.withColumn("in_source", _before(["source"], "range")).drop("n").alias("r")
    by_size = F.col("p.source").eqNullSafe(F.col("s.source")) & (F.col("p.size") == F.col("s.size"))
    by_range = F.col("p.source").eqNullSafe(F.col("r.source")) & (F.col("p.range") == F.col("r.range"))
    return (
        in_size.join(in_range, by_size)
        .join(in_source, by_range)
        .select("p.source", "p.size", "p.part", (F.col("in_size") + F.col("in_range") + F.col("in_source")).alias("before"))
    )


def offset_of(source: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the source and the seed alone, so reruns agree."""
    text = F.concat(F.lit(seed), F.coalesce(F.concat(F.lit("/"), source), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: str = "mix",
) -> DataFrame:
    """Per row: id, ``size`` (words), ``source_size``, ``target``, ``taken`` (words, repeats counted), ``copies``, source.

    A null text has no words, a null source is a source of its own; a source without words has target 0 and nothing is
    taken. Rows that repeat an id are rows of their own. No row is taken more than ``most`` times. Other columns are not
    read. An empty table gives no rows.
    """
    key = F.md5(F.col("id").cast("string"))
    sized = land(
        docs.select(
            F.col(f"`{id_col}`").alias("id"),
            F.col(f"`{source_col}`").alias("source"),
            word_count(F.col(f"`{text_col}`")).alias("size"),
        ).withColumns(
            {"part": F.coalesce(F.conv(F.substring(key, 1, 3), 16, 10).cast("int"), F.lit(-1))}
        ),
        "sized",
    )
    targets = land(source_targets(sized, weights, share, most), "targets")
    place = land(positions_before(sized), "places")
    nth = F.row_number().over(Window.partitionBy("source", "size", "part").orderBy(key, "id"))
    ranked = sized.withColumn("nth", nth).alias("d")
    same = (
        F.col("d.source").eqNullSafe(F.col("q.source"))
        & (F.col("d.size") == F.col("q.size"))
        & (F.col("d.part") == F.col("q.part"))
    )
    facts = place.alias("p").join(targets.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source")))
    facts = facts.select("p.source", "p.size", "p.part", "before", "source_size", "target").alias("q")
    rows = ranked.join(facts, same).select(
        "d.id", "d.source", "d.size", "source_size", "target", (F.col("before") + F.col("nth")).alias("rank")
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = offset_of(F.col("source"), seed)
    crossed = F.floor(offset + F.col("rank") * rate) - F.floor(offset + (F.col("rank") - 1) * rate)
    copies = F.least(crossed, F.ceil(rate)).cast("bigint")
    return rows.withColumn("copies", copies).select(
        F.col("id").alias(id_col),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "copies",
        F.col("source").alias(source_col),
    )


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: every row as often as it is taken, with all its columns, whatever their names.

    Rows that repeat id and source share the copies of their group; null ids and null sources are equal to each other
    here. A null text has no words and is never taken. An empty table gives no rows.
    """
    plan = mix(docs, id_col, text_col, source_col, **options)
    shares = land(
        plan.groupBy(F.col(f"`{id_col}`").alias("own_id"), F.col(f"`{source_col}`").alias("own_source"))
        .agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
        .filter("copies > 0"),
        "shares",
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keys = [F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source")]
    packed = docs.select(row, *keys, F.xxhash64(F.col(f"`{text_col}`")).alias("order"))
    same = F.col("id").eqNullSafe(F.col("own_id")) & F.col("source").eqNullSafe(F.col("own_source"))
    # Merged at every size: the shares grow with the corpus, and so small input shows the plan and the disk of large.
    joined = packed.join(shares.hint("merge"), same)
    every = joined.filter("rows = 1").select("row", F.col("copies").alias("n"))
    if not shares.filter("rows > 1").isEmpty():
        nth = F.row_number().over(Window.partitionBy("id", "source").orderBy("order"))
        several = joined.filter("rows > 1").withColumn("nth", nth)
        part = F.expr("copies * nth div rows - copies * (nth - 1) div rows").alias("n")
        every = every.unionByName(several.select("row", part))
    copied = every.filter("n > 0").select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), "n")))
    return copied.select("row.*")
