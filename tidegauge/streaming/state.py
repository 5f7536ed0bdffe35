"""State store selection for queries that need it."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_SETTING = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Start streaming queries on the RocksDB state store.

    A query copies the session's settings when it starts, so the setting is put back
    on leaving the block while started queries keep theirs. The setting is the session's: a
    query that another thread starts in the same session within the block gets it too. Use
    ``spark.newSession()`` there to keep them apart.
    """
    before = spark.conf.get(_SETTING, None)
    spark.conf.set(_SETTING, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SETTING)
        else:
            spark.conf.set(_SETTING, before)
