"""CSV scans, from strictly typed to plain text, and CSV sinks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from batchkit.errors import DataError
from batchkit.functions.dates import TIME_FORMAT
from batchkit.functions.quotes import cell_count, ends_inside
from batchkit.functions.text import na_to_null, strip_or_empty
from batchkit.operators.checks import require_columns
from batchkit.sources.records import FILE, LINE, RECORD, head_records, record_scan

EXTRA_CELLS = "_extra_cells"
SOURCE_FILE = FILE


def _reader(spark: SparkSession):
    # A quote inside a quoted cell is doubled, as spreadsheet and Python writers do.
    return spark.read.option("header", True).option("escape", '"')


def header(spark: SparkSession, path: str) -> list[str]:
    """The column names of the first file, as written, without names of folders. They may hold line breaks."""
    return _reader(spark).option("multiLine", True).option("recursiveFileLookup", True).csv(path).columns


def _multiline_rows(
    records: DataFrame, schema: T.StructType, names: Sequence[str] | None, corrupt: str | None = None
) -> DataFrame:
    """The cells of records that may hold line breaks, with ``_file`` and ``_line``, parsed as Spark's reader parses.

    With ``names``, a file whose header has others raises. ``corrupt`` keeps the text of records that do not fit.
    """
    fields = [T.StructField(f"c{n}", field.dataType) for n, field in enumerate(schema)]
    options = {"escape": '"', "multiLine": "true", "timestampNTZFormat": TIME_FORMAT}
    if corrupt is not None:
        fields.append(T.StructField(RECORD, T.StringType()))
        options["columnNameOfCorruptRecord"] = RECORD
    data = F.col(LINE) > 1
    if names is not None:
        text = ", ".join(f"c{n} string" for n in range(len(names)))
        bare = F.regexp_replace(F.col(RECORD), "^\ufeff", "")
        own = F.from_csv(bare, text, {"escape": '"', "multiLine": "true"})
        same = [own[f"c{n}"].eqNullSafe(F.lit(name)) for n, name in enumerate(names)]
        message = F.concat(F.col(FILE), F.lit(f" has another header than {', '.join(names)}"))
        fits = reduce(lambda x, y: x & y, same)
        data = F.when(data, F.lit(True)).when(fits, F.lit(False)).otherwise(F.raise_error(message).cast("boolean"))
    ddl = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in fields)
    cells = records.filter(data).withColumn("cells", F.from_csv(F.col(RECORD), ddl, options))
    columns = [F.col(f"cells.c{n}").alias(field.name) for n, field in enumerate(schema)]
    if corrupt is not None:
        columns.append(F.col(f"cells.{RECORD}").alias(corrupt))
    return cells.select(*columns, FILE, LINE)


def typed_scan(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    strict: bool = False,
    corrupt_column: str | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Scan with a fixed schema.

    A malformed value is NULL, a short row ends in NULLs and extra cells are dropped. Header names
    are compared with the schema only if ``strict``. ``corrupt_column`` keeps the text of rows that
    did not fit. Cells may hold line breaks with ``multiline``; see ``sources.records``.
    """
    if multiline:
        rows = _multiline_rows(record_scan(spark, path), schema, schema.names if strict else None, corrupt_column)
        return rows.drop(FILE, LINE)
    reader = _reader(spark).option("enforceSchema", not strict).option("timestampNTZFormat", TIME_FORMAT)
    if corrupt_column is not None:
        schema = T.StructType([*schema.fields, T.StructField(corrupt_column, T.StringType())])
        # Malformed rows are only seen by a parser that reads every column.
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column).option("columnPruning", False)
    return reader.schema(schema).csv(path)


def head_scan(spark: SparkSession, path: str, schema: T.StructType, n: int) -> DataFrame:
    """The first ``n`` rows in the order of file names and lines, with ``_file`` and ``_line``; other files are not read."""
    return _multiline_rows(head_records(spark, path, n), schema, None)


def inferred_scan(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> DataFrame:
    """Scan with inferred types. Inference is a pass of its own: prefer ``typed_scan`` on large input."""
    return _reader(spark).option("inferSchema", True).option("samplingRatio", sampling_ratio).csv(path)


def _text_rows(spark: SparkSession, path: str, names: Sequence[str], multiline: bool, corrupt: str | None = None) -> DataFrame:
    """The cells as text, under the names as written."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    if multiline:
        return _multiline_rows(record_scan(spark, path), schema, names, corrupt)
    reader = _reader(spark).option("enforceSchema", False)
    if corrupt is not None:
        schema = schema.add(corrupt, T.StringType())
        reader = reader.option("columnNameOfCorruptRecord", corrupt).option("columnPruning", False)
    return reader.schema(schema).csv(path).select("*", F.col("_metadata.file_path").alias(FILE))


def text_scan(
    spark: SparkSession,
    path: str,
    required: Sequence[str] = (),
    flag_extra: bool = False,
    name_file: bool = False,
    multiline: bool = False,
    name_line: bool = False,
) -> DataFrame:
    """Scan every column as text: header names and values trimmed, a missing cell as ``""``.

    ``flag_extra`` adds the boolean ``_extra_cells``: the row has more cells than the header.
    ``name_file`` adds ``_file``, the path of the file the row is from. ``name_line`` adds ``_line``, the ordinal of the
    record in its file, the header being 1 and empty lines not counted; it needs ``multiline``.
    """
    if name_line and not multiline:
        raise DataError("ordinals of records are only known to a scan with multiline=True")
    names = header(spark, path)
    trimmed = [name.strip() for name in names]
    require_columns(trimmed, required)
    df = _text_rows(spark, path, names, multiline, RECORD if flag_extra else None)
    columns = [strip_or_empty(F.col(f"`{raw}`")).alias(name) for raw, name in zip(names, trimmed)]
    columns += [F.col(c) for c, wanted in ((FILE, name_file), (LINE, name_line)) if wanted]
    if flag_extra:
        # The record is kept only where the number of cells is off.
        columns.append(F.coalesce(cell_count(F.col(RECORD)) > len(trimmed), F.lit(False)).alias(EXTRA_CELLS))
    return df.select(*columns)


def require_whole_lines(spark: SparkSession, path: str) -> None:
    """Raise if a line ends in a quoted cell: its record goes on in the next line, and needs ``multiline``.

    Scans without ``multiline`` would take its lines for records of their own.
    """
    if not spark.read.text(path).filter(ends_inside(F.col("value"))).isEmpty():
        raise DataError(f"{path} has cells with line breaks: read it with multiline=True")


def untouched_scan(
    spark: SparkSession, path: str, required: Sequence[str], multiline: bool = False
) -> tuple[DataFrame, list[str]]:
    """The required columns as text exactly as written, and the names of the other columns."""
    names = header(spark, path)
    trimmed = [name.strip() for name in names]
    require_columns(trimmed, required)
    df = _text_rows(spark, path, names, multiline)
    rows = df.select(*[F.col(f"`{raw}`").alias(name) for raw, name in zip(names, trimmed) if name in required])
    return rows, [name for name in trimmed if name not in required]


def na_scan(spark: SparkSession, path: str, expected: Sequence[str], multiline: bool = False) -> DataFrame:
    """Scan the expected columns as text, in that order, with missing-value tokens as NULL.

    Identifiers stay text, so leading zeros and letter prefixes survive.
    """
    names = header(spark, path)
    require_columns(names, expected)
    df = _text_rows(spark, path, names, multiline)
    return df.select(*[na_to_null(F.col(f"`{name}`")).alias(name) for name in expected])


def write_csv(df: DataFrame, path: str, single_file: bool = False, partition_by: Sequence[str] = ()) -> None:
    """Write CSV with a header, replacing what is at ``path``.

    The part files keep the order of a sorted ``df``. ``single_file`` is for results known to be
    small: it makes the last step one task.
    """
    if single_file:
        df = df.coalesce(1)
    (
        df.write.mode("overwrite")
        .partitionBy(*partition_by)
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("encoding", "UTF-8")
        .option("timestampNTZFormat", TIME_FORMAT)
        .csv(path)
    )
