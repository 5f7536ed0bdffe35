"""Late rows of a stream, kept in a table of their own."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StructType

from tidegauge.operators.keys import check_dates

_BATCH, _LATE = "_batch", "_late"
_MARKS = "id bigint, newest date"


def start_split(
    df: DataFrame,
    path: str,
    checkpoint: str,
    date: str = "date",
    late_days: int = 0,
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Divide the rows of a stream into those in time and those that come too late.

    A row is late if its date lies more than ``late_days`` before the newest date of all earlier
    triggers: it could change only windows that are closed by then. Rows without a date are in
    time, and so are all rows of the first trigger. Every row goes to one of both tables, as it
    is; ``read_split`` reads either, and ``stream_in_time`` carries on with the rows in time,
    none of which ``stream_rolling_average`` with the same ``late_days`` will drop.

    A micro-batch is read once and not shuffled. Both of its parts are written by one job to
    ``rows/_batch=<id>`` and confirmed together, with its newest date, in ``marks``. One that is run
    again after that writes nothing; one that failed before overwrites what it left.
    """
    check_dates(df, date)
    taken = {name.lower() for name in df.columns} & {_BATCH, _LATE}
    if taken:
        raise ValueError(f"column names {sorted(taken)} are those of the written partitions")

    def split(batch: DataFrame, batch_id: int) -> None:
        marks = _marks(batch.sparkSession, path)
        known = marks.agg(F.max(F.when(F.col("id") < batch_id, F.col("newest"))), F.max("id")).first()
        if known[1] is not None and known[1] >= batch_id:
            return
        late = F.lit(False)
        if known[0] is not None:
            late = F.coalesce(F.col(date) < F.lit(known[0] - timedelta(days=late_days)), late)
        seen = Observation()
        rows = batch.observe(seen, F.max(date).alias("newest")).withColumn(_LATE, late)
        rows.write.mode("overwrite").partitionBy(_LATE).parquet(f"{path}/rows/{_BATCH}={batch_id}")
        done = batch.sparkSession.createDataFrame([(batch_id, seen.get["newest"])], _MARKS)
        done.coalesce(1).write.mode("append").parquet(f"{path}/marks")

    # Readers find both folders, whatever the stream brings.
    df.sparkSession.createDataFrame([], _MARKS).write.mode("append").parquet(f"{path}/marks")
    return (
        df.writeStream.foreachBatch(split)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _marks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_MARKS).parquet(f"{path}/marks")


def read_split(spark: SparkSession, path: str, schema: StructType, late: bool) -> DataFrame:
    """The late rows that ``start_split`` wrote, or those in time, of all confirmed micro-batches."""
    newest = _marks(spark, path).agg(F.max("id")).first()[0]
    if newest is None:
        return spark.createDataFrame([], schema)
    parts = StructType([*schema.fields]).add(_BATCH, LongType()).add(_LATE, BooleanType())
    written = spark.read.schema(parts).parquet(f"{path}/rows")
    return written.where((F.col(_BATCH) <= newest) & (F.col(_LATE) == late)).select(*schema.names)


def stream_in_time(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stream of the rows in time that ``start_split`` writes. Each trigger takes all that is
    there, so that a micro-batch is never divided and no row of it is late behind the others."""
    return spark.readStream.schema(schema).parquet(f"{path}/rows/{_BATCH}=*/{_LATE}=false")
