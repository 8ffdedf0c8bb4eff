"""Data-quality queries over the typed retail table and the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from batchkit.catalog.registry import query, table
from batchkit.catalog.retail import TYPED, typed_rows
from batchkit.functions.numbers import percent_text as percent
from batchkit.operators import profile as ops
from batchkit.operators import profile_slices
from batchkit.operators.retail import COLUMNS
from batchkit.plans.retail_job import PROFILE
from batchkit.plans.retail_job import profile as retail_profile
from batchkit.session import land, scratch_path
from batchkit.sources.layers import BIZ_DATE

CORE = ("invoice_no", "description", "customer_id", "invoice_date")
MEASURES = ("quantity", "unit_price")


def _percent(part: str, total: str = "count(*)") -> str:
    return f"CASE WHEN {total} = 0 THEN '0.00%' ELSE printf('%.2f%%', {part} / {total} * 100) END"


def _null_rows(template: str) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in COLUMNS)


@query(
    f"WITH {TYPED} "
    + _null_rows(
        "SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count,"
        " (count(*) - count({c})) / count(*) * 100 AS null_rate,"
        " printf('%.2f%%', (count(*) - count({c})) / count(*) * 100) AS null_percent FROM retail"
    )
)
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.null_profile(typed_rows(spark, sf_dir))


@query(
    f"WITH {TYPED} SELECT "
    + ", ".join(f"count(*) - count({c}) AS missing_{c}" for c in CORE)
    + " FROM retail"
)
def core_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.missing_counts(typed_rows(spark, sf_dir), CORE)


_ANOMALIES = ", ".join(
    f"count(*) FILTER ({c} < 0) AS negative_{c}, count(*) FILTER ({c} = 0) AS zero_{c}, "
    f"count(*) FILTER ({c} <= 0) AS invalid_{c}, "
    f"{_percent(f'(count(*) FILTER ({c} <= 0))')} AS invalid_{c}_share"
    for c in MEASURES
)


@query(f"WITH {TYPED} SELECT count(*) AS row_count, {_ANOMALIES} FROM retail")
def anomaly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.anomaly_counts(typed_rows(spark, sf_dir), MEASURES)


_MARKED = "(count(*) FILTER (starts_with(upper(trim(coalesce(invoice_no, ''))), 'C')))"


@query(
    f"""
    WITH {TYPED}
    SELECT count(*) AS row_count, {_MARKED} AS marked_count, {_percent(_MARKED)} AS marked_share FROM retail
    """
)
def cancelled_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.marked_share(typed_rows(spark, sf_dir), "invoice_no")


@query(
    """
    SELECT user_id, count(*) FILTER (event_type = 'purchase') AS purchases, count(*) AS events,
           printf('%.2f%%', (count(*) FILTER (event_type = 'purchase')) / count(*) * 100) AS purchase_share
    FROM events GROUP BY user_id
    """
)
def percent_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of purchases in each user's events, as text."""
    counted = table(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "purchase").alias("purchases"), F.count(F.lit(1)).alias("events")
    )
    return counted.withColumn("purchase_share", percent(F.col("purchases"), F.col("events")))


@query(
    """
    SELECT count(*) AS row_count, count(*) - count(DISTINCT (text, lang, n_chars)) AS duplicate_count FROM documents
    """
)
def duplicate_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("text", "lang", "n_chars")
    return ops.duplicate_count(documents, wide=["text"])


@query(
    """
    SELECT text, lang, n_chars, row_number() OVER (PARTITION BY text, lang, n_chars) > 1 AS quarantined FROM documents
    """
)
def duplicate_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document row, the first of equal rows kept and the others quarantined."""
    documents = table(spark, sf_dir, "documents").select("text", "lang", "n_chars")
    counted = land(ops.collapse_duplicates(documents), "collapsed")
    kept = counted.drop("extra_copies").withColumn("quarantined", F.lit(False))
    return kept.unionByName(ops.repeat_copies(counted).withColumn("quarantined", F.lit(True)))


@query(f"WITH {TYPED} SELECT min(invoice_date) AS min_invoice_date, max(invoice_date) AS max_invoice_date FROM retail")
def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.value_range(typed_rows(spark, sf_dir), "invoice_date")


_DISTINCT = {"invoices": "invoice_no", "products": "stock_code", "customers": "customer_id", "countries": "country"}


@query(
    f"WITH {TYPED} SELECT "
    + ", ".join(f"count(DISTINCT {c}) AS distinct_{c}" for c in _DISTINCT.values())
    + " FROM retail"
)
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.distinct_counts(typed_rows(spark, sf_dir), list(_DISTINCT.values()))


_TOP = """
top AS (
    SELECT row_number() OVER (ORDER BY count(*) DESC, coalesce(country, '缺失')) AS rank,
           coalesce(country, '缺失') AS label, count(*) AS row_count
    FROM retail GROUP BY 2 ORDER BY rank LIMIT 10
)"""


@query(f"WITH {TYPED}, {_TOP} SELECT rank, label, row_count FROM top")
def top_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.top_values(typed_rows(spark, sf_dir), "country")


def _report_sql() -> str:
    def row(section: str, metric: str, value: str) -> str:
        return f"SELECT '{section}' AS section, '{metric}' AS metric, cast({value} AS varchar) AS value FROM retail"

    def null(c: str) -> str:
        return f"(count(*) - count({c}))"

    different = "(SELECT count(*) FROM (SELECT DISTINCT * FROM retail))"
    rows = [
        row("file", "row_count", "count(*)"),
        row("file", "column_count", str(len(COLUMNS))).replace("FROM retail", ""),
        row("size", "first_time", "min(invoice_date)"),
        row("size", "last_time", "max(invoice_date)"),
        row("cancelled", "count", _MARKED),
        row("cancelled", "share", _percent(_MARKED)),
        row("duplicates", "count", f"count(*) - {different}"),
        row("duplicates", "share", _percent(f"(count(*) - {different})")),
    ]
    for c in MEASURES:
        for name, test in (("negative", "< 0"), ("zero", "= 0"), ("invalid", "<= 0")):
            rows.append(row(c, name, f"count(*) FILTER ({c} {test})"))
        rows.append(row(c, "invalid_share", _percent(f"(count(*) FILTER ({c} <= 0))")))
    rows += [row("core_missing", c, null(c)) for c in CORE]
    for c in COLUMNS:
        rows += [row("null_count", c, null(c)), row("null_share", c, _percent(null(c)))]
    rows += [row("size", name, f"count(DISTINCT {c})") for name, c in _DISTINCT.items()]
    rows.append("SELECT 'top', rank || ' ' || label, cast(row_count AS varchar) FROM top")
    return f"WITH {TYPED}, {_TOP} " + " UNION ALL ".join(rows)


@query(_report_sql())
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed table is landed once; each of the four aggregations reads only its columns."""
    return retail_profile(land(typed_rows(spark, sf_dir), "typed"))


@query(_report_sql())
def quality_report_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report from summaries per date: all dates but the newest first, then the newest, written twice."""
    dated = land(typed_rows(spark, sf_dir).withColumn(BIZ_DATE, F.to_date("invoice_date")), "dated")
    newest = dated.agg(F.max(BIZ_DATE).alias("day")).first()["day"]
    path = scratch_path(spark, "profile")
    last = F.coalesce(F.col(BIZ_DATE) == F.lit(newest), F.lit(False))
    for rows in (dated.filter(~last), dated.filter(last), dated.filter(last)):
        profile_slices.update(rows, path, PROFILE)
    return profile_slices.merged_report(spark, path, COLUMNS, PROFILE)
