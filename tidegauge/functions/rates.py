"""Rates of change."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_change_of(current: Column, previous: Column) -> Column:
    """``(current - previous) / previous * 100``.

    NULL where the previous value is NULL or zero, with ANSI mode on or off.
    """
    return F.try_divide(current - previous, previous) * F.lit(100.0)
