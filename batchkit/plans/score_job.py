"""Scores: typed scan, clean, summarise, write, verify by reading back."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from batchkit.operators.checks import require_rows
from batchkit.operators.scores import SCORE_SCHEMA, ScoreNames, by_total, output_stats, score_clean, score_summary
from batchkit.session import land
from batchkit.sources.csv import typed_scan, write_csv
from batchkit.sources.versions import commit, new_version


@dataclass(frozen=True)
class ScoreResult:
    students: int
    mean_average: str
    path: str = field(default="", compare=False)


def run_scores(
    spark: SparkSession,
    source: str,
    target: str,
    strict: bool = False,
    single_file: bool = False,
    names: ScoreNames = ScoreNames(),
) -> ScoreResult:
    """Write the score summary of the CSV at ``source`` as a new version of the result at ``target``.

    The source is read once and its result set aside. The version becomes the current one when it was read back and has
    rows: see ``sources.versions``. The statistics come from what was written.
    """
    summary = land(score_summary(score_clean(typed_scan(spark, source, SCORE_SCHEMA, strict), names), names), "scores")
    require_rows(summary, source)
    version = new_version(target)
    write_csv(by_total(summary, names), version, single_file)
    written = typed_scan(spark, version, _text_with_average(summary.schema, names), strict=True)
    require_rows(written, version)
    stats = output_stats(written, names.average).first()
    commit(spark, target, version)
    return ScoreResult(stats["row_count"], stats["mean_average"], version)


def _text_with_average(schema: T.StructType, names: ScoreNames) -> T.StructType:
    return T.StructType(
        [T.StructField(f.name, f.dataType if f.name == names.average else T.StringType()) for f in schema.fields]
    )
