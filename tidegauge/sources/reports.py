"""Batch and streaming scans of CSV reports.

Schemas are explicit, so no file is read to infer one. Parsing is permissive: a
field that does not parse becomes NULL and the rest of its row survives.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidegauge.operators.counters import counter_to_increments
from tidegauge.operators.normalise import normalise
from tidegauge.sources.layouts import Layout
from tidegauge.sources.rejects import observed_rejects, raw_with_broken
from tidegauge.streaming.counters import stream_counter_to_increments


def read_raw(
    spark: SparkSession, paths: str | Sequence[str], layout: str | Layout = Layout.CASE_REPORT
) -> DataFrame:
    """All columns of one or more CSV files or folders, as one table."""
    layout = Layout.of(layout)
    return spark.read.schema(layout.schema).options(**layout.read_options).csv(_listed(paths))


def read_series(
    spark: SparkSession,
    paths: str | Sequence[str],
    layout: str | Layout = Layout.CASE_REPORT,
    *,
    dedupe: str | None = "max",
    version: str | None = None,
) -> DataFrame:
    """One or more CSV files as the series ``(date, cases, country)``.

    ``dedupe`` and ``version`` (a column of the files) say which of several rows of a key and
    day counts; they are those of ``counter_to_increments`` and only for counter files.
    """
    layout = Layout.of(layout)
    raw = read_raw(spark, paths, layout)
    if layout is Layout.CASE_REPORT:
        return _case_series(raw)
    return counter_to_increments(raw, dedupe=dedupe, version=version)


def stream_series(
    spark: SparkSession,
    path: str,
    layout: str | Layout = Layout.CASE_REPORT,
    max_files_per_trigger: int | None = None,
    *,
    late_days: int = 0,
    dedupe: str | None = "max",
    version: str | None = None,
    rejects: str | None = None,
) -> DataFrame:
    """A folder of CSV files as a stream of the series ``(date, cases, country)``.

    ``late_days``, ``dedupe`` and ``version`` are those of ``stream_counter_to_increments``
    and only for counter files.

    With ``rejects`` every micro-batch reports, in the query's progress and under that name, its
    rows and those with an unreadable field (see ``stream_rejects``), without a second read.
    """
    layout = Layout.of(layout)
    reader = spark.readStream.schema(layout.schema).options(**layout.read_options)
    if rejects is not None:
        reader = raw_with_broken(spark.readStream, layout)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(path)
    if rejects is not None:
        raw = observed_rejects(raw, layout, rejects)
    if layout is Layout.CASE_REPORT:
        return _case_series(raw)
    return stream_counter_to_increments(
        raw, late_days=late_days, dedupe=dedupe, version=version
    )


def _case_series(raw: DataFrame) -> DataFrame:
    return normalise(raw, date="dateRep", cases="cases", country="countriesAndTerritories")


def _listed(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)
