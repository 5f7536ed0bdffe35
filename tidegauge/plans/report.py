"""The report: averages with their change, and the ranking of the changes."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.operators import change_runs, expand_changes, rank_within, rolling_change
from tidegauge.sinks import write_report
from tidegauge.sources import Layout, read_series


def report_frames(
    series: DataFrame,
    window_days: int = 7,
    slide_days: int = 1,
    rank_limit: int = 10,
    *,
    strict: bool = False,
    colocated: bool = False,
    partitions: int | None = None,
    fill_gaps: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Averages with percent change, and their top ranks per window, of a series."""
    changes = rolling_change(
        series,
        window_days=window_days,
        slide_days=slide_days,
        strict=strict,
        colocated=colocated,
        partitions=partitions,
        fill_gaps=fill_gaps,
    )
    return changes, rank_within(changes, limit=rank_limit, key="country", cells=partitions)


def run_report(
    spark: SparkSession,
    paths: str | Sequence[str],
    layout: str | Layout = Layout.CASE_REPORT,
    out_dir: str = "results",
    window_days: int = 7,
    slide_days: int = 1,
    rank_limit: int = 10,
    *,
    strict: bool = False,
    partitions: int | None = None,
    sort_output: bool = False,
    dedupe: str | None = "max",
    version: str | None = None,
    fill_gaps: bool = False,
    versioned: bool = False,
    compression: str | None = None,
) -> tuple[str, str]:
    """Read CSV reports, write ``<out_dir>/avg`` and ``<out_dir>/rank``; returns the two paths.

    Both outputs come from one computation of the averages. What is kept on the executors
    meanwhile are the runs of equal windows, which are expanded again for each output; a
    lost executor's share is recomputed from the source. ``dedupe`` and ``version`` are those
    of ``read_series``, ``fill_gaps`` that of ``rolling_average``, ``compression`` that of
    ``write_report``: of series of many keys the averages are many times as large as the input.

    The outputs replace what is there one after the other, and a failure in between leaves them
    apart. With ``versioned`` they go to a new folder below ``out_dir`` instead, which becomes the
    one that ``current_report`` gives once both are written; earlier ones stay readable.
    """
    layout = Layout.of(layout)
    folder = f"{out_dir}/version-{uuid.uuid4().hex}" if versioned else out_dir
    avg_path, rank_path = f"{folder}/avg", f"{folder}/rank"
    runs = change_runs(
        read_series(spark, paths, layout, dedupe=dedupe, version=version),
        window_days=window_days,
        slide_days=slide_days,
        strict=strict,
        colocated=layout is Layout.COUNTER,
        partitions=partitions,
        fill_gaps=fill_gaps,
    ).persist(StorageLevel.MEMORY_AND_DISK)
    changes = expand_changes(runs, window_days=window_days, slide_days=slide_days)
    try:
        write_report(changes, avg_path, ["end_date", "country"] if sort_output else None, compression)
        ranks = rank_within(changes, limit=rank_limit, key="country", cells=partitions)
        write_report(ranks, rank_path, ["end_date", "rank", "country"] if sort_output else None, compression)
    finally:
        runs.unpersist()
    if versioned:
        _confirm(spark, out_dir, folder)
    return avg_path, rank_path


def current_report(spark: SparkSession, out_dir: str) -> tuple[str, str]:
    """The paths of the newest whole report that ``run_report(versioned=True)`` wrote."""
    newest = _versions(spark, out_dir).orderBy(F.desc("number"), F.desc("folder")).first()
    return f"{newest.folder}/avg", f"{newest.folder}/rank"


def _versions(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.schema("number bigint, folder string").parquet(f"{out_dir}/versions")


def _confirm(spark: SparkSession, out_dir: str, folder: str) -> None:
    """Add a folder to the list of versions: one file, which is there whole or not at all."""
    try:
        before = _versions(spark, out_dir).agg(F.max("number")).first()[0] or 0
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        before = 0
    row = spark.range(1).select(F.lit(before + 1).cast("bigint").alias("number"), F.lit(folder).alias("folder"))
    row.coalesce(1).write.mode("append").parquet(f"{out_dir}/versions")
