"""Day-window arithmetic.

A window is the half-open day range ``[start, start + window_days)``. Starts are
the multiples of ``slide_days`` counted from 1970-01-01. Everything is integer
arithmetic on day numbers, so a session time zone cannot move a label.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column
from pyspark.sql import functions as F


def check_window(window_days: int, slide_days: int, strict: bool = False) -> int:
    """Validate a window and return the divisor of its average.

    The divisor is the whole number of slides per window: an average is the mean
    per slide period. Where the slide does not divide the window the quotient is
    truncated; ``strict`` refuses that case instead of warning about it.
    """
    for name, days in (("window_days", window_days), ("slide_days", slide_days)):
        if isinstance(days, bool) or not isinstance(days, int) or days < 1:
            raise ValueError(f"{name} must be a whole number of days >= 1, got {days!r}")
    if slide_days > window_days:
        raise ValueError(
            f"slide_days ({slide_days}) must not exceed window_days ({window_days})"
        )
    if window_days % slide_days:
        message = (
            f"slide_days ({slide_days}) does not divide window_days ({window_days}): "
            f"sums are divided by {window_days // slide_days}"
        )
        if strict:
            raise ValueError(message)
        warnings.warn(message, stacklevel=3)
    return window_days // slide_days


def first_window_start(date: Column, window_days: int, slide_days: int) -> Column:
    """Day number of the earliest window start whose window holds ``date``."""
    before = F.unix_date(date) - F.lit(window_days)
    return before - F.pmod(before, F.lit(slide_days)) + F.lit(slide_days)


def last_window_start(date: Column, slide_days: int) -> Column:
    """Day number of the latest window start whose window holds ``date``."""
    day = F.unix_date(date)
    return day - F.pmod(day, F.lit(slide_days))


def date_of_day(day: Column) -> Column:
    """DATE of a day number counted from 1970-01-01."""
    return F.date_from_unix_date(day.cast("int"))
