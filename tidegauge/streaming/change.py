"""Percent change along a stream of closed windows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tidegauge.operators.keys import key_names


def stream_percent_change(
    df: DataFrame,
    key: str | Sequence[str] = "country",
    order: str = "end_date",
    value: str = "avg",
    output: str = "avg_increase",
) -> DataFrame:
    """``percent_change`` over a stream that brings each key's rows in order.

    The state of a key is its last row's value, NULL included, and place in the order. One
    trigger may close several windows of a key; they are put in order before they are
    compared. A row whose place lies before that of an earlier trigger's row ends the query:
    what came out for the later row can't be taken back.

    Runs on the RocksDB state store: start the query inside ``rocksdb_state``, or with
    ``spark.sql.streaming.stateStore.providerClass`` set accordingly.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(output, T.DoubleType(), True)])
    state = T.StructType(
        [
            T.StructField("value", T.DoubleType(), True),
            T.StructField("place", df.schema[order].dataType, True),
        ]
    )
    names = df.columns

    class Compare(StatefulProcessor):
        def init(self, handle: Any) -> None:
            self._last = handle.getValueState("last", state)

        def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
            series = sorted(rows, key=lambda row: row[order])
            before, place = self._last.get() if self._last.exists() else (None, None)
            if place is not None and series[0][order] < place:
                raise ValueError(f"{order} {series[0][order]} came after {place} of the same key")
            for row in series:
                now = None if row[value] is None else float(row[value])
                change = (now - before) / before * 100.0 if now is not None and before else None
                yield Row(**{name: row[name] for name in names}, **{output: change})
                before = now
            self._last.update((before, series[-1][order]))

    return df.groupBy(*key_names(key)).transformWithState(Compare(), schema, "Append", "None")
