"""Daily increments of a stream of levels."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, datetime, timezone
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tidegauge.operators.counters import COUNTER_ANCHOR, check_dedupe
from tidegauge.streaming.days import DAY_SECONDS, SHIFT_DAYS, day_of_millis, event_time
from tidegauge.streaming.partial import reduced

# Types whose order is the same in Arrow and in Python.
_SORTABLE = (T.NumericType, T.StringType, T.DateType, T.TimestampNTZType, T.BooleanType)


def stream_counter_to_increments(
    df: DataFrame,
    key: str = "country",
    day: str = "day",
    level: str = "infected",
    anchor: str = COUNTER_ANCHOR,
    late_days: int = 0,
    *,
    dedupe: str | None = "max",
    version: str | None = None,
) -> DataFrame:
    """``counter_to_increments`` over a stream, by event time.

    The levels of a key are kept by day until the newest day seen is ``late_days`` past
    them, and only then compared with the day before, in the order of the days. Files may
    so come in any order within ``late_days``. A row of a day that is already closed is
    dropped; Spark counts it in ``numRowsDroppedByWatermark`` of the query's progress.

    A day's rows are reduced to the one that counts within the tasks that read them, before they
    are shuffled by key, so a key gets few rows a day however many came; late rows are counted
    after that. A trigger reads and writes the state of a key once for each of its days.

    ``dedupe`` and ``version`` are those of the batch operator, and levels and versions are kept
    in their own types; without ``dedupe`` a second row of an open day ends the query. With
    ``dedupe="last"`` a row without a version counts as a day without a level unless another
    comes. Rows without a day are dropped.

    The result has a column more than that of the batch operator, ``event_time``: the date as
    an event time with the stream's watermark. ``stream_rolling_average`` goes on with it;
    leave it out only where no operator by event time follows.

    Runs on the RocksDB state store: start the query inside ``rocksdb_state``, or with
    ``spark.sql.streaming.stateStore.providerClass`` set accordingly.
    """
    check_dedupe(dedupe, version)
    kind = df.schema[level].dataType
    order = F.col(version if dedupe == "last" else level)
    if isinstance(df.select(order).schema[0].dataType, T.TimestampType):
        # Python's clock times repeat an hour a year; microseconds don't.
        order = F.unix_micros(order)
    order_kind = df.select(order).schema[0].dataType
    schema = T.StructType(
        [
            T.StructField("date", T.DateType(), True),
            T.StructField("cases", df.select(F.col(level) - F.col(level)).schema[0].dataType, True),
            T.StructField("country", T.StringType(), True),
            T.StructField("event_time", T.TimestampType(), True),
        ]
    )
    on = F.date_add(F.lit(anchor).cast("date"), F.col(day))
    levels = df.select(
        on.alias("date"),
        F.col(key).cast("string").alias("country"),
        F.col(level).alias("level"),
        order.alias("version"),
    ).where(F.col("date").isNotNull())
    if dedupe is not None and isinstance(order_kind, _SORTABLE):
        # Without dedupe every row is needed, to tell that a day has several.
        levels = levels.mapInArrow(reduced(_newest_of_days), levels.schema)
    return (
        levels.withColumn("_at", event_time(F.col("date")))
        .withWatermark("_at", f"{late_days} days")
        .groupBy("country")
        .transformWithState(
            _increments(dedupe, kind.simpleString(), order_kind.simpleString()),
            schema,
            "Append",
            "EventTime",
            eventTimeColumnName="event_time",
        )
    )


def _newest_of_days(rows: pa.Table) -> pa.Table:
    """The first of the rows with the highest version, as ``_newer`` has it, of each key and day."""
    version = rows["version"]
    place = pc.if_else(pc.is_valid(version), 1, 0)
    if pa.types.is_floating(version.type):
        place = pc.if_else(pc.fill_null(pc.is_nan(version), False), 2, place)
    nth = np.arange(rows.num_rows)
    order = [("place", "descending"), ("version", "descending"), ("nth", "ascending")]
    sorted_ = pc.sort_indices(pa.table({"place": place, "version": version, "nth": nth}), sort_keys=order)
    by = pa.table({"date": rows["date"], "country": rows["country"]}).take(sorted_).append_column("nth", sorted_)
    firsts = by.group_by(["date", "country"], use_threads=False).aggregate([("nth", "first")])
    return rows.take(firsts["nth_first"])


def _increments(dedupe: str | None, kind: str, order_kind: str) -> StatefulProcessor:
    class Increments(StatefulProcessor):
        def init(self, handle: Any) -> None:
            self._handle = handle
            self._open = handle.getMapState("open", "day date", f"level {kind}, version {order_kind}")
            self._last = handle.getValueState("last", f"level {kind}")

        def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
            newest: dict[date, Row] = {}
            for row in rows:
                held = newest.get(row.date)
                if held is not None and dedupe is None:
                    raise _several(key, row.date)
                if held is None or _newer(row, (held.level, held.version)):
                    newest[row.date] = row
            for when, row in newest.items():
                kept = (when,)
                if self._open.containsKey(kept):
                    if dedupe is None:
                        raise _several(key, when)
                    if not _newer(row, self._open.getValue(kept)):
                        continue
                else:
                    # Just before the day's own time: the timer is due once that is reached.
                    self._handle.registerTimer(_millis(when) - 1)
                known = dedupe != "last" or row.version is not None
                self._open.updateValue(kept, (row.level if known else None, row.version))
            return iter(())

        def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
            reached = day_of_millis(timerValues.getCurrentWatermarkInMs())
            due = sorted(kept[0] for kept in self._open.keys() if kept[0] <= reached)
            for when in due:
                level = self._open.getValue((when,))[0]
                before = self._last.get()[0] if self._last.exists() else 0
                known = level is not None and before is not None
                yield Row(
                    date=when,
                    cases=level - before if known else None,
                    country=key[0],
                    event_time=_time(when),
                )
                self._last.update((level,))
                self._open.removeKey((when,))

    return Increments()


def _several(key: Any, when: date) -> ValueError:
    return ValueError(f"{key[0]} has several levels on {when}; give dedupe")


def _newer(row: Row, held: Any) -> bool:
    """Whether the row replaces the level held for its day: a higher version (in "max", the
    level itself); NULL is the lowest and NaN the highest."""
    if row.version is None or held[1] is None:
        return row.version is not None
    return row.version > held[1] or (row.version != row.version and held[1] == held[1])


def _time(when: date) -> datetime:
    return datetime.fromtimestamp(_millis(when) // 1000, timezone.utc)


def _millis(when: date) -> int:
    return ((when - date(1970, 1, 1)).days + SHIFT_DAYS) * DAY_SECONDS * 1000
