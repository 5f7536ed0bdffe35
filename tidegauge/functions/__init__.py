"""Column expressions shared by the operators."""

from tidegauge.functions.exact import LIMBS, ExactSum, limb_columns
from tidegauge.functions.rates import percent_change_of
from tidegauge.functions.windows import (
    check_window,
    date_of_day,
    first_window_start,
    last_window_start,
)

__all__ = [
    "LIMBS",
    "ExactSum",
    "check_window",
    "date_of_day",
    "first_window_start",
    "last_window_start",
    "limb_columns",
    "percent_change_of",
]
