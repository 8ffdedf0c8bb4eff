"""Business dates, compact date keys, row keys and strict timestamps."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from batchkit.errors import DataError

DATE_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TIME_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# The weekday labels, the week starting on Sunday.
WEEKDAY_LABELS = ("周日", "周一", "周二", "周三", "周四", "周五", "周六")


def biz_date_key(biz_date: str) -> str:
    """``2026-07-18`` to ``20260718``; raises unless it is a real date in exactly that form."""
    if not re.match(DATE_SHAPE, biz_date):
        raise DataError(f"business date must be YYYY-MM-DD: {biz_date!r}")
    try:
        date.fromisoformat(biz_date)
    except ValueError as exc:
        raise DataError(f"no such date: {biz_date}") from exc
    return biz_date.replace("-", "")


def is_biz_date(text: Column) -> Column:
    """True where the text has the form YYYY-MM-DD and names a real date; never NULL."""
    return F.coalesce(text.rlike(DATE_SHAPE) & text.try_cast("date").isNotNull(), F.lit(False))


def date_key(day: Column) -> Column:
    """A date or zone-free timestamp as ``YYYYMMDD``."""
    return F.replace(day.cast("date").cast("string"), F.lit("-"), F.lit(""))


def row_key(day: Column, entity: Column) -> Column:
    """``YYYYMMDD#entity``: keys of one date sort together."""
    return F.concat(date_key(day), F.lit("#"), entity.cast("string"))


def to_time(text: Column) -> Column:
    """Text ``yyyy-MM-dd HH:mm:ss`` to a zone-free timestamp; NULL for any other form."""
    return F.when(text.rlike(TIME_SHAPE), text.try_cast("timestamp_ntz"))


def weekday_label(day: Column) -> Column:
    """The label of the day of the week."""
    return F.element_at(F.array(*[F.lit(label) for label in WEEKDAY_LABELS]), F.dayofweek(day))
