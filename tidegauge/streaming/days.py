"""Dates as event times.

A watermark starts at 1970-01-01, so earlier event times would count as late from the
start. Dates therefore lie a fixed number of days further on as event times, and are taken
back before anybody sees them.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_SECONDS = 86400
# Fixed value: days from 0001-01-01, the first DATE, to 1970-01-01, and one more.
SHIFT_DAYS = 719_163
_WATERMARK = "spark.watermarkDelayMs"


def event_time(day: Column) -> Column:
    """Midnight UTC of the shifted date; the session time zone has no part in it."""
    return F.timestamp_seconds((F.unix_date(day).cast("bigint") + F.lit(SHIFT_DAYS)) * F.lit(DAY_SECONDS))


def day_of_millis(millis: int) -> date:
    """The date whose event time is the last one not after ``millis``."""
    return date(1970, 1, 1) + timedelta(days=millis // (DAY_SECONDS * 1000) - SHIFT_DAYS)


def watermarked(df: DataFrame) -> str | None:
    """The column of ``df`` that already carries a watermark."""
    return next((f.name for f in df.schema if _WATERMARK in (f.metadata or {})), None)
