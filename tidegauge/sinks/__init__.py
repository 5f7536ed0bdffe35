"""Report sinks."""

from tidegauge.sinks.reports import (
    read_date_prefix,
    read_report,
    write_date_prefixes,
    write_report,
)

__all__ = ["read_date_prefix", "read_report", "write_date_prefixes", "write_report"]
