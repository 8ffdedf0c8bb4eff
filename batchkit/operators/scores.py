"""Student scores: cleaning, the survivor of repeated rows, sums per student."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The column names of the score files and of the result.
SCORE_SCHEMA = (
    T.StructType().add("学号", "string").add("姓名", "string").add("科目", "string").add("分数", "integer").add("班级", "string")
)


@dataclass(frozen=True)
class ScoreNames:
    """Column names of a score table and of its summary."""

    student: str = "学号"
    name: str = "姓名"
    subject: str = "科目"
    score: str = "分数"
    group: str = "班级"
    average: str = "平均分"
    total: str = "总分"
    highest: str = "最高分"
    subjects: str = "科目数"


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per key: the first by ``order_by``, which must leave no ties among unequal rows.

    The filter on the row number lets Spark keep one row per key in every map task before the
    shuffle, so a key with most of the rows sends a single row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_n", F.row_number().over(window)).filter(F.col("_n") == 1).drop("_n")


def score_clean(
    df: DataFrame,
    names: ScoreNames = ScoreNames(),
    low: int = 0,
    high: int = 100,
    order_by: Sequence[Column] | None = None,
) -> DataFrame:
    """Scores present and within [low, high], one row per student and subject.

    Of repeated rows the highest score survives unless ``order_by`` says otherwise; the remaining
    columns decide ties, so the survivor does not depend on how the data is partitioned.
    """
    keys = (names.student, names.subject)
    if order_by is None:
        rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in (*keys, names.score)]
        order_by = [F.col(names.score).desc(), *rest]
    valid = df.filter(F.col(names.score).isNotNull() & F.col(names.score).between(low, high))
    return first_per_key(valid, keys, order_by)


def score_summary(clean: DataFrame, names: ScoreNames = ScoreNames()) -> DataFrame:
    """Per student, name and class: average with one decimal, sum, maximum and number of subjects."""
    return clean.groupBy(names.student, names.name, names.group).agg(
        F.round(F.avg(names.score), 1).alias(names.average),
        F.sum(names.score).alias(names.total),
        F.max(names.score).alias(names.highest),
        F.count(F.lit(1)).alias(names.subjects),
    )


def by_total(summary: DataFrame, names: ScoreNames = ScoreNames()) -> DataFrame:
    """The summary by descending total; student, name and class break ties."""
    return summary.orderBy(F.desc(names.total), names.student, names.name, names.group)


def output_stats(summary: DataFrame, average: str = ScoreNames.average) -> DataFrame:
    """One row: the number of result rows and the mean of their averages, ``N/A`` for no rows.

    The averages have one decimal, so they are summed exactly, as whole tenths.
    """
    tenths = F.sum(F.round(F.col(average) * 10).cast("bigint"))
    mean = F.round(tenths.cast("double") / F.count(average) / 10, 1)
    return summary.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.when(F.count(average) > 0, mean.cast("decimal(20,1)").cast("string"))
        .otherwise("N/A")
        .alias("mean_average"),
    )


def class_counts(df: DataFrame, by: str = ScoreNames.group) -> DataFrame:
    """Rows per group."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("row_count"))
