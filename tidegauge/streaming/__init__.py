"""Streaming counterparts of the operators."""

from tidegauge.streaming.change import stream_percent_change
from tidegauge.streaming.counters import stream_counter_to_increments
from tidegauge.streaming.late import read_split, start_split, stream_in_time
from tidegauge.streaming.rolling import stream_rolling_average
from tidegauge.streaming.sinks import (
    read_rank_updates,
    read_replaced,
    read_stream_report,
    read_updates,
    start_rank,
    start_rank_updates,
    start_replace,
    start_report,
    start_table,
    start_updates,
)
from tidegauge.streaming.state import rocksdb_state
from tidegauge.streaming.updates import stream_rolling_updates

__all__ = [
    "read_rank_updates",
    "read_replaced",
    "read_split",
    "read_stream_report",
    "read_updates",
    "rocksdb_state",
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
    "stream_rolling_average",
    "stream_rolling_updates",
]
