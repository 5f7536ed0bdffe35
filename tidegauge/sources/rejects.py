"""Rows of CSV reports that hold fields which can't be read, with their place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidegauge.sources.layouts import Layout

BROKEN = "_broken_record"
#: Columns of each layout that the series is made from.
USED = {
    Layout.CASE_REPORT: ("dateRep", "cases", "countriesAndTerritories"),
    Layout.COUNTER: ("day", "country", "infected"),
}


def raw_with_broken(reader, layout: Layout):
    """A batch or stream reader that also gives the text of rows which don't parse."""
    schema = T.StructType([*layout.schema.fields, T.StructField(BROKEN, T.StringType(), True)])
    return reader.schema(schema).options(**layout.read_options, columnNameOfCorruptRecord=BROKEN)


def is_reject(layout: Layout) -> Column:
    """True for rows with an unreadable field among those the series uses.

    Reading the used columns makes the parser check them, and only them.
    """
    missing = [F.col(name).isNull() for name in USED[layout]]
    some = missing[0]
    for column in missing[1:]:
        some = some | column
    return F.col(BROKEN).isNotNull() & some


def count_rejects(
    spark: SparkSession, paths: str | Sequence[str], layout: str | Layout = Layout.CASE_REPORT
) -> DataFrame:
    """Rows read, and rows with an unreadable field among those the series uses."""
    layout = Layout.of(layout)
    raw = raw_with_broken(spark.read, layout).csv([paths] if isinstance(paths, str) else list(paths))
    return raw.agg(*_counts(layout))


def read_rejects(
    spark: SparkSession, paths: str | Sequence[str], layout: str | Layout = Layout.CASE_REPORT
) -> DataFrame:
    """The rows that ``count_rejects`` counts: ``(file, block_start, record, failing)``.

    ``file`` and ``block_start`` say where the task that read the row began; ``record`` is the row
    as it stands in the file, and ``failing`` names the used columns whose field isn't empty and
    yet gave no value. A row with too few fields is no reject: what it lacks is empty. Nothing is collected: write the
    frame next to the report to keep what the series left out.
    """
    layout = Layout.of(layout)
    raw = raw_with_broken(spark.read, layout).csv([paths] if isinstance(paths, str) else list(paths))
    as_text = ", ".join(f"`{name}` string" for name in layout.schema.names)
    fields = F.from_csv(F.col("record"), F.lit(as_text), {"mode": "PERMISSIVE"})
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block_start")]
    rows = raw.select(*place, F.col(BROKEN).alias("record"), *USED[layout], is_reject(layout).alias("_reject"))
    unread = [
        F.when(F.col(name).isNull() & F.col("_fields")[name].isNotNull(), F.lit(name)) for name in USED[layout]
    ]
    return (
        rows.where("_reject")
        .withColumn("_fields", fields)
        .select("file", "block_start", "record", F.array_compact(F.array(*unread)).alias("failing"))
    )


def observed_rejects(raw: DataFrame, layout: Layout, name: str) -> DataFrame:
    """``raw`` that reports, as the metrics ``name``, its rows and rejects while it is read."""
    return raw.observe(name, *_counts(layout))


def stream_rejects(query: StreamingQuery, name: str) -> list[tuple[int, int, int]]:
    """(batch, records, rejected) of each micro-batch in the query's progress, newest last."""
    counts = []
    for progress in query.recentProgress:
        metrics = progress.observedMetrics.get(name)
        if metrics is not None:
            counts.append((progress.batchId, metrics["records"], metrics["rejected"]))
    return counts


def _counts(layout: Layout) -> list[Column]:
    return [F.count(F.lit(1)).alias("records"), F.count_if(is_reject(layout)).alias("rejected")]
