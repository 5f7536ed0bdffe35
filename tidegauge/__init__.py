"""Rolling averages, rates of change and rankings of daily series, on Spark."""

from tidegauge.operators import (
    change_runs,
    counter_to_increments,
    daily_totals,
    date_prefix,
    date_prefix_buckets,
    date_prefix_counts,
    expand_changes,
    normalise,
    percent_change,
    rank_within,
    rolling_average,
    rolling_change,
)
from tidegauge.plans import current_report, report_frames, run_report
from tidegauge.sinks import read_date_prefix, read_report, write_date_prefixes, write_report
from tidegauge.sources import (
    Layout,
    count_rejects,
    read_raw,
    read_rejects,
    read_series,
    stream_rejects,
    stream_series,
)
from tidegauge.streaming import (
    read_rank_updates,
    read_replaced,
    read_split,
    read_stream_report,
    read_updates,
    rocksdb_state,
    start_rank,
    start_rank_updates,
    start_replace,
    start_report,
    start_split,
    start_table,
    start_updates,
    stream_counter_to_increments,
    stream_in_time,
    stream_percent_change,
    stream_rolling_average,
    stream_rolling_updates,
)
from tidegauge.workspace import work_dir

__all__ = [
    "Layout",
    "change_runs",
    "count_rejects",
    "counter_to_increments",
    "current_report",
    "daily_totals",
    "date_prefix",
    "date_prefix_buckets",
    "date_prefix_counts",
    "expand_changes",
    "normalise",
    "percent_change",
    "rank_within",
    "read_date_prefix",
    "read_raw",
    "read_rejects",
    "read_rank_updates",
    "read_replaced",
    "read_report",
    "read_series",
    "read_split",
    "read_stream_report",
    "read_updates",
    "report_frames",
    "rocksdb_state",
    "rolling_average",
    "rolling_change",
    "run_report",
    "start_rank",
    "start_rank_updates",
    "start_replace",
    "start_report",
    "start_split",
    "start_table",
    "start_updates",
    "stream_counter_to_increments",
    "stream_in_time",
    "stream_percent_change",
    "stream_rejects",
    "stream_rolling_average",
    "stream_rolling_updates",
    "stream_series",
    "work_dir",
    "write_date_prefixes",
    "write_report",
]
