"""Sinks of the streaming operators.

Each takes the folder of the result and the folder of the query's checkpoint, and
starts the query. By default it runs until everything available is read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StructType

from tidegauge.operators.keys import key_names
from tidegauge.operators.rank import rank_within

AVAILABLE_NOW = {"availableNow": True}


def start_table(
    df: DataFrame, path: str, checkpoint: str, trigger: dict[str, object] | None = None
) -> StreamingQuery:
    """Append the rows of a stream to a Parquet table, each exactly once."""
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def start_replace(
    df: DataFrame, path: str, checkpoint: str, trigger: dict[str, object] | None = None
) -> StreamingQuery:
    """Write the complete result of every trigger; ``read_replaced`` gives the newest.

    Each micro-batch owns a folder and overwrites it when it is run again. Its number goes to
    ``<path>/complete`` once the folder is written, so a reader never sees part of a result.
    """

    def replace(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch-{batch_id}")
        done = batch.sparkSession.range(batch_id, batch_id + 1)
        done.write.mode("append").parquet(f"{path}/complete")

    return (
        df.writeStream.foreachBatch(replace)
        .outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def read_replaced(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The newest complete result that ``start_replace`` wrote."""
    newest = spark.read.schema("id bigint").parquet(f"{path}/complete").agg(F.max("id")).first()[0]
    return spark.read.schema(schema).parquet(f"{path}/batch-{newest}")


def start_rank(
    df: DataFrame,
    path: str,
    checkpoint: str,
    period: str = "end_date",
    by: str = "avg_increase",
    limit: int = 10,
    key: str | Sequence[str] | None = "country",
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Rank the rows of every closed period and write them as Parquet.

    The watermark is the same for all keys, so a period closes for all of them in one
    micro-batch and its rank is final. Each micro-batch owns the folder
    ``batch=<id>`` and overwrites it when it is run again.
    """

    def rank(batch: DataFrame, batch_id: int) -> None:
        # The ranking reads its input twice; the stateful steps before it run once.
        batch.persist()
        try:
            ranked = rank_within(batch, period, by, limit, key=key)
            ranked.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            batch.unpersist()

    return (
        df.writeStream.foreachBatch(rank)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def start_updates(
    df: DataFrame, path: str, checkpoint: str, trigger: dict[str, object] | None = None
) -> StreamingQuery:
    """Write the windows that every trigger of ``stream_rolling_updates`` changed;
    ``read_updates`` gives the newest of each. A micro-batch that is run again overwrites its own
    folder ``batch=<id>``."""

    def update(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        df.writeStream.foreachBatch(update)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def read_updates(
    spark: SparkSession, path: str, schema: StructType, key: str | Sequence[str] = "country"
) -> DataFrame:
    """The newest row of each key and window that ``start_updates`` wrote."""
    return _newest(_batches(spark, path, schema), [*key_names(key), "start_date"], schema)


def _batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What micro-batches wrote to folders of their own, with their numbers."""
    return spark.read.schema(StructType([*schema.fields]).add("batch", LongType())).parquet(path)


def _newest(written: DataFrame, names: list[str], schema: StructType) -> DataFrame:
    """The row of the last micro-batch for each value of ``names``."""
    others = F.struct(*(name for name in schema.names if name not in names)).alias("_newest")
    newest = written.groupBy(*names).agg(F.max_by(others, "batch").alias("_newest"))
    return newest.select(*names, "_newest.*").select(*schema.names)


def start_report(
    df: DataFrame,
    path: str,
    checkpoint: str,
    limit: int = 10,
    key: str | Sequence[str] | None = "country",
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Write averages with their changes and their ranking from one query over one source.

    ``df`` brings closed windows, as ``stream_percent_change(stream_rolling_average(...))`` does.
    A micro-batch writes ``avg/batch=<id>`` and ``rank/batch=<id>`` and then its number to
    ``complete``; ``read_stream_report`` reads only what that confirms. One that failed in between
    is run again from the checkpoint and overwrites both, so the two never tell of different
    periods and nothing is counted twice.
    """

    def report(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            batch.write.mode("overwrite").parquet(f"{path}/avg/batch={batch_id}")
            ranked = rank_within(batch, limit=limit, key=key)
            ranked.write.mode("overwrite").parquet(f"{path}/rank/batch={batch_id}")
            done = batch.sparkSession.range(batch_id, batch_id + 1)
            done.write.mode("append").parquet(f"{path}/complete")
        finally:
            batch.unpersist()

    return (
        df.writeStream.foreachBatch(report)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def read_stream_report(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """Averages and ranks that ``start_report`` wrote, of all micro-batches that are complete.
    ``schema`` is that of the averages."""
    newest = spark.read.schema("id bigint").parquet(f"{path}/complete").agg(F.max("id")).first()[0]
    ranked = StructType([*schema.fields]).add("rank", IntegerType())
    frames = []
    for name, kind in (("avg", schema), ("rank", ranked)):
        written = _batches(spark, f"{path}/{name}", kind)
        frames.append(written.where(F.col("batch") <= newest).select(*kind.names))
    return frames[0], frames[1]


def start_rank_updates(
    df: DataFrame,
    path: str,
    checkpoint: str,
    period: str = "end_date",
    by: str = "avg",
    limit: int = 10,
    key: str | Sequence[str] = "country",
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Rank periods that are still open, each anew when one of its rows changes.

    ``df`` brings changed rows, as ``stream_rolling_updates`` does. A value may fall as well as rise,
    so the best rows alone would not do: every row stays in ``windows/batch=<id>``, sorted by
    period, and a trigger ranks the newest rows of the periods that it changed, with
    ``rank_within``, into ``rank/batch=<id>``. ``read_rank_updates`` gives the newest ranking of
    each period, which is the batch result. The changed periods are broadcast: their number is
    bounded by the calendar. A micro-batch that is run again overwrites both of its folders.
    """
    own = StructType([*df.schema.fields])

    def update(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.sortWithinPartitions(period).write.mode("overwrite").parquet(f"{path}/windows/batch={batch_id}")
        written = _batches(spark, f"{path}/windows", own).where(F.col("batch") <= batch_id)
        changed = written.where(F.col("batch") == batch_id).select(F.col(period).alias("_changed")).distinct()
        rows = written.join(F.broadcast(changed), F.col(period).eqNullSafe(F.col("_changed")), "left_semi")
        ranked = rank_within(_newest(rows, [*key_names(key), period], own), period, by, limit, key=key)
        ranked.write.mode("overwrite").parquet(f"{path}/rank/batch={batch_id}")
        done = spark.range(batch_id, batch_id + 1)
        done.write.mode("append").parquet(f"{path}/complete")

    return (
        df.writeStream.foreachBatch(update)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def read_rank_updates(
    spark: SparkSession, path: str, schema: StructType, period: str = "end_date"
) -> DataFrame:
    """The newest ranking of each period that ``start_rank_updates`` wrote, of all micro-batches
    that are complete. ``schema`` is that of the ranked rows."""
    newest = spark.read.schema("id bigint").parquet(f"{path}/complete").agg(F.max("id")).first()[0]
    ranked = StructType([*schema.fields]).add("rank", IntegerType())
    written = _batches(spark, f"{path}/rank", ranked).where(F.col("batch") <= newest)
    last = written.groupBy(F.col(period).alias("_period")).agg(F.max("batch").alias("_last"))
    met = F.col(period).eqNullSafe(F.col("_period")) & (F.col("batch") == F.col("_last"))
    return written.join(F.broadcast(last), met, "left_semi").select(*ranked.names)
