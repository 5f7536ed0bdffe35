"""Fixed-layout CSV sources."""

from tidegauge.sources.layouts import (
    CASE_REPORT_SCHEMA,
    COUNTER_SCHEMA,
    Layout,
)
from tidegauge.sources.rejects import count_rejects, read_rejects, stream_rejects
from tidegauge.sources.reports import read_raw, read_series, stream_series

__all__ = [
    "CASE_REPORT_SCHEMA",
    "COUNTER_SCHEMA",
    "Layout",
    "count_rejects",
    "read_raw",
    "read_rejects",
    "read_series",
    "stream_rejects",
    "stream_series",
]
