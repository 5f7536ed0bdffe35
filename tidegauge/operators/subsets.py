"""Subsets holding the first dates of a table.

A DATE has fewer than four million values, so a table of the distinct dates is
bounded by the calendar however large the data is. That bound is what allows it
to be numbered in one task and broadcast; columns of other types are refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.operators.keys import check_dates


def date_prefix(df: DataFrame, dates: int, date: str = "date") -> DataFrame:
    """Rows on the first ``dates`` distinct dates, in calendar order.

    The last of those dates is a scalar subquery, so the rows are filtered where
    they are scanned, without a join or a shuffle.
    """
    _check_count("dates", dates)
    check_dates(df, date)
    first = df.select(date).where(F.col(date).isNotNull()).distinct().orderBy(date).limit(dates)
    return df.where(F.col(date) <= first.agg(F.max(date)).scalar())


def date_prefix_buckets(
    df: DataFrame, step: int, date: str = "date", bucket: str = "bucket"
) -> DataFrame:
    """Number each row by the group of ``step`` distinct dates it falls in, from 1.

    The first ``k * step`` dates are the buckets up to ``k``, so one tagged table holds
    every prefix. Rows without a date are in none.
    """
    _check_count("step", step)
    check_dates(df, date)
    days = df.select(date).where(F.col(date).isNotNull()).distinct()
    numbered = F.broadcast(_with_bucket(days, step, date, bucket))
    return df.join(numbered, date).select(*df.columns, bucket)


def date_prefix_counts(
    df: DataFrame, step: int, date: str = "date", bucket: str = "bucket"
) -> DataFrame:
    """Dates and records of each bucket, and records of the prefix it completes."""
    _check_count("step", step)
    check_dates(df, date)
    days = df.where(F.col(date).isNotNull()).groupBy(date).agg(F.count(F.lit(1)).alias("_rows"))
    per_bucket = (
        _with_bucket(days, step, date, bucket)
        .groupBy(bucket)
        .agg(F.count(F.lit(1)).alias("dates"), F.sum("_rows").alias("records"))
    )
    so_far = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_bucket.withColumn("prefix_records", F.sum("records").over(so_far))


def _with_bucket(days: DataFrame, step: int, date: str, bucket: str) -> DataFrame:
    ordinal = F.row_number().over(Window.orderBy(date))
    return days.withColumn(bucket, F.ceil(ordinal / F.lit(step)).cast("int"))


def _check_count(name: str, count: int) -> None:
    if isinstance(count, bool) or not isinstance(count, int) or count < 1:
        raise ValueError(f"{name} must be a whole number >= 1, got {count!r}")
