"""DataFrame-to-DataFrame operators."""

from tidegauge.operators.change import percent_change
from tidegauge.operators.counters import counter_to_increments
from tidegauge.operators.normalise import normalise
from tidegauge.operators.rank import rank_within
from tidegauge.operators.rolling import (
    change_runs,
    daily_totals,
    expand_changes,
    rolling_average,
    rolling_change,
)
from tidegauge.operators.subsets import date_prefix, date_prefix_buckets, date_prefix_counts

__all__ = [
    "change_runs",
    "counter_to_increments",
    "daily_totals",
    "date_prefix",
    "date_prefix_buckets",
    "date_prefix_counts",
    "expand_changes",
    "normalise",
    "percent_change",
    "rank_within",
    "rolling_average",
    "rolling_change",
]
