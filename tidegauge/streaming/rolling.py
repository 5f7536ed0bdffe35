"""Rolling averages of a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions import check_window, date_of_day
from tidegauge.operators.keys import check_dates, key_names
from tidegauge.streaming.days import DAY_SECONDS, SHIFT_DAYS, event_time, watermarked


def stream_rolling_average(
    df: DataFrame,
    key: str | Sequence[str] = "country",
    date: str = "date",
    value: str = "cases",
    window_days: int = 7,
    slide_days: int = 1,
    late_days: int = 0,
    *,
    strict: bool = False,
    complete: bool = False,
) -> DataFrame:
    """``rolling_average`` over a stream, for append mode.

    A window is emitted once, when the newest date seen is at least ``late_days`` past
    its end. A record counts if its day is not closed yet: Spark drops those whose day ended
    ``late_days`` or more before the newest date that was known one trigger ago. Records are summed per key and day first, so that a record is not copied
    into every window that holds it: the state is a sum per key and open day and one per
    key and open window.

    ``complete`` makes the form for complete mode, where every trigger gives the averages of
    everything read so far. Spark chains no aggregates in that mode, so each record is
    copied into its windows before the first sum.

    A stream that already has a watermark, as that of ``stream_counter_to_increments`` has on
    its ``event_time``, keeps it and takes no ``late_days``. Event times are shifted dates (see
    ``days``): any DATE may come, and the session time zone has no part in the labels.
    """
    keys = key_names(key)
    check_dates(df, date)
    divisor = check_window(window_days, slide_days, strict)
    known = watermarked(df)
    if known and late_days:
        raise ValueError(f"{known} already has a watermark; give late_days where it is made")
    at = F.col(known) if known else event_time(F.col(date))
    records = df.where(F.col(date).isNotNull()).select(*keys, F.col(value).alias("_value"), at.alias("_at"))
    if not known:
        records = records.withWatermark("_at", f"{late_days} days")
    if not complete:
        records = (
            records.groupBy(*keys, F.window("_at", "1 day"))
            .agg(F.sum("_value").alias("_value"))
            .select(*keys, "_value", F.window_time("window").alias("_at"))
        )
    # Windows start at multiples of the slide before the shift.
    origin = f"{SHIFT_DAYS % slide_days} days"
    window = F.window("_at", f"{window_days} days", f"{slide_days} days", origin)
    return (
        records.groupBy(*keys, window)
        .agg(F.sum("_value").alias("_sum"))
        .select(
            _label("window.start").alias("start_date"),
            _label("window.end").alias("end_date"),
            *keys,
            (F.col("_sum").cast("double") / F.lit(divisor)).alias("avg"),
        )
    )


def _label(bound: str) -> Column:
    return date_of_day(F.unix_seconds(bound) / F.lit(DAY_SECONDS) - F.lit(SHIFT_DAYS))
