"""Data-quality profile of a table: few passes, each reading only its columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchkit.functions.numbers import percent_text, share
from batchkit.functions.text import has_mark, or_label


# Fixed value: the label under which missing values are counted.
MISSING_LABEL = "缺失"


def _long(row: DataFrame, names: Sequence[str], label: str, value: str) -> DataFrame:
    """One row per name from the one-row table ``row``; other columns are repeated."""
    ids = [c for c in row.columns if c not in names]
    return row.unpivot(ids, list(names), label, value)


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: missing values and their share in percent (NULL on an empty table). One pass."""
    columns = list(columns or df.columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    return _long(counted, columns, "column_name", "null_count").select(
        "column_name",
        "null_count",
        (share(F.col("null_count"), F.col("_total")) * 100).alias("null_rate"),
        percent_text(F.col("null_count"), F.col("_total")).alias("null_percent"),
    )


def missing_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the missing values of each of the columns."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in columns])


def anomaly_exprs(measures: Sequence[str]) -> list[Column]:
    """Per measure: how many are below, equal to, and not above zero. A missing value is none of them."""
    exprs = []
    for c in measures:
        exprs += [
            F.count_if(F.col(c) < 0).alias(f"negative_{c}"),
            F.count_if(F.col(c) == 0).alias(f"zero_{c}"),
            F.count_if(F.col(c) <= 0).alias(f"invalid_{c}"),
        ]
    return exprs


def anomaly_counts(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """One row: total rows, the counts of ``anomaly_exprs`` and the share of invalid values as text."""
    counted = df.agg(F.count(F.lit(1)).alias("row_count"), *anomaly_exprs(measures))
    return counted.withColumns(
        {f"invalid_{c}_share": percent_text(F.col(f"invalid_{c}"), F.col("row_count")) for c in measures}
    )


def marked_share(df: DataFrame, column: str, mark: str = "C") -> DataFrame:
    """One row: rows, rows whose text carries the mark, and their share as text."""
    counted = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(has_mark(F.col(column), mark)).alias("marked_count"),
    )
    return counted.withColumn("marked_share", percent_text(F.col("marked_count"), F.col("row_count")))


def value_range(df: DataFrame, column: str) -> DataFrame:
    """One row: the smallest and the largest value."""
    return df.agg(F.min(column).alias(f"min_{column}"), F.max(column).alias(f"max_{column}"))


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """One row: the number of different values per column, missing ones left out.

    Exact counts copy each row once per column before the partial aggregation; ``approximate``
    is a single pass with about 1 % error.
    """
    if approximate:
        return df.agg(*[F.approx_count_distinct(c, 0.01).alias(f"distinct_{c}") for c in columns])
    return df.agg(*[F.count_distinct(c).alias(f"distinct_{c}") for c in columns])


def _row_key(df: DataFrame, wide: Sequence[str]) -> list[Column]:
    return [
        F.unhex(F.sha2(F.col(c), 256)).alias(c) if c in wide else F.col(c) for c in df.columns
    ]


def duplicate_count(df: DataFrame, wide: Sequence[str] = ()) -> DataFrame:
    """One row: rows and the number of them that repeat an earlier, fully equal row.

    Missing equals missing. The long text columns named in ``wide`` are compared by SHA-256, so the
    shuffle carries 32 bytes instead of the text. Counts combine on the map side.
    """
    copies = df.select(*_row_key(df, wide)).groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    zero = F.lit(0).cast("bigint")
    return copies.agg(
        F.coalesce(F.sum("_copies"), zero).alias("row_count"),
        F.coalesce(F.sum(F.col("_copies") - 1), zero).alias("duplicate_count"),
    )


def collapse_duplicates(df: DataFrame, alias: str = "extra_copies") -> DataFrame:
    """Every different row once, with the number of further copies it had."""
    return df.groupBy(*df.columns).agg((F.count(F.lit(1)) - 1).alias(alias))


def repeat_copies(counted: DataFrame, alias: str = "extra_copies", chunk: int = 10_000) -> DataFrame:
    """Each row ``extra_copies`` times, the inverse of ``collapse_duplicates``.

    The copies are produced in chunks that are spread over the tasks, so that a row with very many
    copies is neither one array nor one task.
    """
    columns = [c for c in counted.columns if c != alias]
    # A fixed number of partitions: a chunk is small now and large once expanded, so adaptive
    # coalescing by size would put all of them together.
    partitions = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = F.col(alias) - F.col("_chunk") * chunk
    chunks = counted.filter(F.col(alias) > 0).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(alias) - 1) / chunk)))
    )
    return (
        chunks.repartition(partitions, *columns, "_chunk")
        .select(*columns, F.explode(F.sequence(F.lit(1), F.least(left, F.lit(chunk)).cast("int"))).alias("_i"))
        .drop("_i")
    )


def top_values(df: DataFrame, column: str, n: int = 10, missing: str = MISSING_LABEL) -> DataFrame:
    """The ``n`` most frequent values with rank and count; missing ones under a label, ties by label."""
    counted = df.groupBy(or_label(F.col(column), missing).alias("label")).agg(F.count(F.lit(1)).alias("row_count"))
    return ranked_values(counted, n)


def ranked_values(counted: DataFrame, n: int) -> DataFrame:
    """The ``n`` first of (label, row_count) by count, ties by label, with their rank."""
    counted = counted.orderBy(F.desc("row_count"), "label").limit(n)
    # At most n rows are left: rank them as the positions of one sorted array.
    ranked = counted.agg(
        F.sort_array(F.collect_list(F.struct((-F.col("row_count")).alias("_k"), "label", "row_count"))).alias("_top")
    )
    return ranked.select(F.posexplode("_top").alias("_pos", "_v")).select(
        (F.col("_pos") + 1).cast("bigint").alias("rank"), "_v.label", "_v.row_count"
    )


def _second(time: Column) -> Column:
    return F.substring(time.cast("string"), 1, 19)


def _text(section: str, metric: str, value: Column) -> Column:
    """A line of the report whose value is ready."""
    return _line(section, metric, value.cast("string"), F.lit(None), F.lit(None))


def _share(section: str, metric: str, part: Column, total: Column) -> Column:
    """A line of the report whose value is ``part`` of ``total`` in percent."""
    return _line(section, metric, F.lit(None), part, total)


def _line(section: str, metric: str, text: Column, part: Column, total: Column) -> Column:
    return F.struct(
        F.lit(section).alias("section"),
        F.lit(metric).alias("metric"),
        text.cast("string").alias("text"),
        part.cast("bigint").alias("part"),
        total.cast("bigint").alias("total"),
    )


def _lines(row: DataFrame, lines: Sequence[Column]) -> DataFrame:
    """The lines taken from a one-row table, as (section, metric, value) rows."""
    return row.select(F.inline(F.array(*lines))).select(
        "section",
        "metric",
        F.coalesce("text", percent_text(F.col("part"), F.col("total"))).alias("value"),
    )


def quality_report(
    df: DataFrame,
    distinct: Mapping[str, str],
    mark: str,
    measures: Sequence[str],
    core: Sequence[str],
    time: str,
    top: str,
    wide: Sequence[str] = (),
) -> DataFrame:
    """The whole profile as (section, metric, value) rows, all values as text.

    Four aggregations: all plain metrics in one pass, the distinct counts, the duplicates and the
    most frequent values.
    """
    return report_of(
        df.agg(*plain_metrics(df.columns, mark, measures, time)),
        distinct_counts(df, list(distinct.values())),
        duplicate_count(df, wide),
        top_values(df, top),
        df.columns,
        distinct,
        measures,
        core,
    )


def plain_metrics(columns: Sequence[str], mark: str, measures: Sequence[str], time: str) -> list[Column]:
    """The aggregates of one pass: counts, and the first and last time."""
    return [
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(has_mark(F.col(mark))).alias("marked"),
        *anomaly_exprs(measures),
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
    ]


def report_of(
    plain: DataFrame,
    distinct_row: DataFrame,
    duplicates: DataFrame,
    top: DataFrame,
    columns: Sequence[str],
    distinct: Mapping[str, str],
    measures: Sequence[str],
    core: Sequence[str],
) -> DataFrame:
    """The lines of the report from its four parts."""
    total = F.col("row_count")
    lines = [
        _text("file", "row_count", total),
        _text("file", "column_count", F.lit(len(columns))),
        _text("size", "first_time", _second(F.col("first_time"))),
        _text("size", "last_time", _second(F.col("last_time"))),
        _text("cancelled", "count", F.col("marked")),
        _share("cancelled", "share", F.col("marked"), total),
    ]
    for c in measures:
        lines += [_text(c, kind, F.col(f"{kind}_{c}")) for kind in ("negative", "zero", "invalid")]
        lines.append(_share(c, "invalid_share", F.col(f"invalid_{c}"), total))
    lines += [_text("core_missing", c, F.col(f"null_{c}")) for c in core]
    for c in columns:
        lines += [_text("null_count", c, F.col(f"null_{c}")), _share("null_share", c, F.col(f"null_{c}"), total)]
    repeats = F.col("duplicate_count")
    parts = [
        _lines(plain, lines),
        _lines(
            distinct_row,
            [_text("size", name, F.col(f"distinct_{c}")) for name, c in distinct.items()],
        ),
        _lines(
            duplicates,
            [_text("duplicates", "count", repeats), _share("duplicates", "share", repeats, total)],
        ),
        top.select(
            F.lit("top").alias("section"),
            F.concat(F.col("rank").cast("string"), F.lit(" "), F.col("label")).alias("metric"),
            F.col("row_count").cast("string").alias("value"),
        ),
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def report_markdown(report: DataFrame, title: str) -> str:
    """The report as a document. Collects it: its rows are as many as metrics, not as the data."""
    lines, sections = [f"# {title}"], {}
    for row in report.collect():
        sections.setdefault(row["section"], []).append((row["metric"], row["value"]))
    for section, metrics in sections.items():
        lines += ["", f"## {section}", "", "| metric | value |", "|---|---:|"]
        lines += [f"| {metric} | {value} |" for metric, value in metrics]
    return "\n".join(lines) + "\n"
