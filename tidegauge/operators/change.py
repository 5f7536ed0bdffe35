"""Percent change of a series against its previous row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.functions import percent_change_of
from tidegauge.operators.keys import key_names


def percent_change(
    df: DataFrame,
    key: str | Sequence[str] = "country",
    order: str = "end_date",
    value: str = "avg",
    output: str = "avg_increase",
) -> DataFrame:
    """Add the percent change of ``value`` against the previous row of its key.

    Previous means the previous existing row: a gap in the series is bridged, unless the
    averages were made with ``fill_gaps``. The first row of a key, and a row after a zero or NULL, get NULL.
    Expects one row per key and period, which bounds a key by the calendar.
    """
    previous = F.lag(value, 1).over(Window.partitionBy(*key_names(key)).orderBy(order))
    return (
        df.withColumn("_previous", previous)
        .withColumn(output, percent_change_of(F.col(value), F.col("_previous")))
        .drop("_previous")
    )
