"""What the operators share on Spark's side: shared folders, free names, measured sizes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.workspace import work_dir

GIVE_BACK_EVERY = 8
# Shuffle files go when a write has ended; Python workers get batches of bounded size.
_WHILE_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def importable(spark: SparkSession) -> None:
    """Let the Python workers of a local session import this package from where it lies, as
    spark.executorEnv.PYTHONPATH would; a cluster gets it by --py-files or an install."""
    context = spark.sparkContext
    if context.master.startswith("local["):
        context.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new shared folder and read it back, which cuts its lineage.

    The shuffle files of the write go as soon as it has ended; what a lost executor held is
    then read from the shared folder and not made again. The folder goes when the driver ends.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    before = {name: spark.conf.get(name) for name in _WHILE_WRITING}
    for name, value in _WHILE_WRITING.items():
        spark.conf.set(name, value)
    try:
        df.write.parquet(path)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
        goes_at_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def goes_at_exit(spark: SparkSession, path: str) -> None:
    """Let Hadoop's file system remove a folder, whole or half written, when the driver's JVM ends."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)


def give_back() -> None:
    """Return memory that is free again to the system. Python workers are kept from one stage to
    the next, and with them all that their allocators hold."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run`` over Arrow batches, giving memory back every few results and at the end."""

    def spared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for nth, made in enumerate(run(batches), 1):
            yield made
            del made
            if nth % GIVE_BACK_EVERY == 0:
                give_back()
        give_back()

    return spared


def free_name(taken: Iterable[str], name: str) -> str:
    """``name``, or with underscores before it until no column has that name."""
    taken = {x.lower() for x in taken}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_bytes_total(df: DataFrame, text: str = "text") -> int:
    """Bytes of all texts: one scan of one column."""
    return df.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0


def parts_for(total_bytes: int, each: int, spark: SparkSession) -> int:
    """So many parts that each has about ``each`` bytes, and no fewer than Spark's setting."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total_bytes // each))


def held_out(doc_id: str, folds: int, fold: int) -> Column:
    """True for rows whose crc32 of the id as text leaves ``fold``; a NULL id is kept for learning."""
    rest = F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds
    return F.coalesce(rest == fold, F.lit(False))
