"""CSV reports.

A report is a folder of part files written in parallel, each with a header.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.operators.subsets import date_prefix_buckets

# Fixed value: date pattern of the written reports.
REPORT_DATE_FORMAT = "dd/MM/yyyy"
_OPTIONS = {"header": True, "dateFormat": REPORT_DATE_FORMAT}


def write_report(
    df: DataFrame, path: str, sort_by: Sequence[str] | None = None, compression: str | None = None
) -> None:
    """Write a CSV report, replacing what is there.

    ``compression`` is a codec of Spark's CSV files, as ``gzip``; ``read_report`` needs no word of it.

    With ``sort_by`` the rows are range-partitioned and sorted, so that the part files
    read in name order are one sorted report. Name enough columns to tell rows of
    a crowded period apart, or that period cannot be split between files.
    """
    if sort_by:
        df = df.orderBy(*sort_by)
    df.write.mode("overwrite").options(**_OPTIONS).csv(path, compression=compression)


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a written report back."""
    return spark.read.schema(schema).options(**_OPTIONS).csv(path)


def write_date_prefixes(df: DataFrame, path: str, step: int, date: str = "date") -> None:
    """Write every prefix of ``step, 2 * step, ...`` dates at once.

    Each record is written once, under the first prefix that holds it; prefix ``k`` is
    the folders ``bucket=1`` to ``bucket=k``. The records of a bucket are brought together
    first, and a large bucket is split again, so that the number of files follows the
    size of the data and not the number of tasks.
    """
    tagged = date_prefix_buckets(df, step, date, bucket="bucket")
    together = tagged.hint("rebalance", F.col("bucket"))
    together.write.mode("overwrite").partitionBy("bucket").options(**_OPTIONS).csv(path)


def read_date_prefix(
    spark: SparkSession, path: str, prefix: int, schema: T.StructType
) -> DataFrame:
    """Read prefix ``prefix`` of a written set; later folders are not opened."""
    tagged = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    return read_report(spark, path, tagged).where(F.col("bucket") <= prefix).drop("bucket")
