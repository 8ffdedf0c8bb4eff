"""Daily orders: read the date's slice, tag, aggregate, write, read back, upsert, reconcile."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from batchkit.functions.dates import biz_date_key
from batchkit.operators.checks import require_clean, require_readback, require_rows, summary_violations
from batchkit.operators.keyed import ensure_table, replace_slices, require_slice, user_stat_rows
from batchkit.operators.orders import (
    REQUIRED,
    counts_of,
    order_rollup,
    rejects,
    totals_text,
    tag_rejects,
)
from batchkit.session import land
from batchkit.sources.csv import EXTRA_CELLS, SOURCE_FILE, require_whole_lines, text_scan, write_csv
from batchkit.sources.records import LINE
from batchkit.sources.versions import commit, new_version


@dataclass(frozen=True)
class DailyResult:
    valid_rows: int
    skipped_rows: int
    users: int
    summary_path: str
    other_columns: tuple[str, ...] = ()
    rejects_path: str | None = None


def run_daily(
    spark: SparkSession,
    base: str,
    biz_date: str,
    update_time: str,
    table: str,
    table_path: str,
    keep_rejects: bool = True,
    single_file: bool = False,
    multiline: bool = False,
) -> DailyResult:
    """Summarise ``<base>/raw/<YYYYMMDD>`` into ``<base>/result/<YYYYMMDD>`` and the keyed table.

    The result is a version with the folders ``user_summary`` and ``rejects``: see ``sources.versions``. It becomes the
    current one after it was checked, so a run that stops leaves the earlier result in place.

    The orders are parsed once into a rollup per user and reject reason, which is written aside;
    the summary and all counts come from it. The rejected records take a second scan, left out
    with ``keep_rejects=False``. A rerun of a date replaces its result, in files and table; the result
    is checked before anything is replaced. Cells with line breaks need ``multiline`` and raise without;
    with it, rejected records carry their ordinal in the file. Columns that no step needs are named in the result.
    """
    key = biz_date_key(biz_date)
    source, result = f"{base}/raw/{key}", f"{base}/result/{key}"
    version = new_version(result)
    target, rejected = f"{version}/user_summary", f"{version}/rejects"
    if not multiline:
        require_whole_lines(spark, source)
    scanned = text_scan(spark, source, REQUIRED, flag_extra=True, name_file=True, multiline=multiline, name_line=multiline)
    place = [SOURCE_FILE, *([LINE] if multiline else [])]
    tagged = tag_rejects(scanned)
    rollup = land(order_rollup(tagged), "rollup")
    text = totals_text(rollup)
    require_rows(text, f"orders of {biz_date}")
    counts = counts_of(rollup).first()

    require_clean(summary_violations(text))
    write_csv(text, target, single_file)
    if keep_rejects:
        write_csv(
            rejects(tagged).select("order_id", "user_id", "amount_source", "reason", *place),
            rejected,
        )

    written = text_scan(spark, target, ("user_id", "order_count", "total_amount"))
    require_clean(summary_violations(written))
    require_readback(text, written)
    commit(spark, result, version)

    rows = user_stat_rows(text, biz_date, update_time)
    ensure_table(spark, table, rows.schema, table_path)
    replace_slices(rows, table)
    require_slice(spark, table, biz_date, counts["users"])
    other = tuple(c for c in scanned.columns if c not in (*REQUIRED, *place, EXTRA_CELLS))
    return DailyResult(
        counts["valid_rows"], counts["skipped_rows"], counts["users"], target, other, rejected if keep_rejects else None
    )
