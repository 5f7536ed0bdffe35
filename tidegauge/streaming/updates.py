"""Rolling averages of a stream as they change, from sums by day kept in state."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import date, timedelta
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tidegauge.functions import LIMBS, ExactSum, check_window, limb_columns
from tidegauge.operators.keys import check_dates, key_names
from tidegauge.streaming.partial import reduced

#: Days whose sums are read and written together.
CHUNK_DAYS = 64
_EPOCH = date(1970, 1, 1)
# Ten digits are left for the number of rows.
_SUMMED_DIGITS = 28
_STATE = "sums array<string>, known array<bigint>"


def stream_rolling_updates(
    df: DataFrame,
    key: str | Sequence[str] = "country",
    date: str = "date",
    value: str = "cases",
    window_days: int = 7,
    slide_days: int = 1,
    *,
    strict: bool = False,
) -> DataFrame:
    """``rolling_average`` over a stream, for update mode.

    Every trigger gives the windows that its records have changed, with their averages over all
    that was read so far; a window comes again when later records change it. The newest row of
    each key and window (``read_updates``) is the batch result. No record is late, so the state
    keeps all days: one exact sum per key and day, in chunks of ``CHUNK_DAYS``.

    A record is not copied into its windows. Records are summed per key and day within the
    tasks that read them before they are shuffled by key; a trigger then reads the chunks within
    one window's length of the days that changed, and moves a running sum along them. So a
    trigger's work follows its records and the windows they change, whatever was read before.

    Runs on the RocksDB state store: start the query inside ``rocksdb_state``, or with
    ``spark.sql.streaming.stateStore.providerClass`` set accordingly.
    """
    keys = key_names(key)
    check_dates(df, date)
    divisor = check_window(window_days, slide_days, strict)
    kind = df.schema[value].dataType
    # The state store's names are those of Avro, which allow letters, digits and underscores.
    plain = [f"_key{k}" for k in range(len(keys))]
    by, number = [*plain, "_day"], F.col(value)
    if isinstance(kind, (T.IntegralType, T.DecimalType)):
        # Whole numbers of the last decimal place.
        scale = getattr(kind, "scale", 0)
        whole = number.cast(f"decimal(38,{scale})") * F.lit(str(10**scale)).cast("decimal(38,0)")
        columns, summed = [whole.cast("decimal(38,0)").alias("_whole")], ["_whole"]
    else:
        columns, summed, scale = limb_columns(number), list(LIMBS[1:]), None
        by.append(LIMBS[0])
    known = number.isNotNull().cast("bigint").alias("_known")
    named = [F.col(name).alias(other) for name, other in zip(keys, plain)]
    records = df.where(F.col(date).isNotNull()).select(*named, F.unix_date(date).alias("_day"), *columns, known)
    records = records.select(*by, *summed, "_known")
    # Decimals of more digits could pass 38 in sums of so many rows: those of a batch are all they get.
    held = 0 if isinstance(kind, T.DecimalType) and kind.precision > _SUMMED_DIGITS else None
    partial = records.mapInArrow(reduced(_partial_sums(by, [*summed, "_known"]), held), records.schema)
    dates = [T.StructField(name, T.DateType()) for name in ("start_date", "end_date")]
    schema = T.StructType([*dates, *records.select(*plain).schema, T.StructField("avg", T.DoubleType())])
    processor = _updates(plain, scale, window_days, slide_days, divisor)
    changed = partial.groupBy(*plain).transformWithState(processor, schema, "Update", "None")
    return changed.withColumnsRenamed(dict(zip(plain, keys)))


def _partial_sums(by: list[str], summed: list[str]) -> Callable[[pa.Table], pa.Table]:
    def run(rows: pa.Table) -> pa.Table:
        sums = rows.group_by(by).aggregate([(name, "sum") for name in summed])
        sums = sums.rename_columns([name.removesuffix("_sum") if name not in by else name for name in sums.column_names])
        return sums.select(rows.schema.names).cast(rows.schema)

    return run


def _updates(
    keys: list[str], scale: int | None, window_days: int, slide_days: int, divisor: int
) -> StatefulProcessor:
    class Updates(StatefulProcessor):
        def init(self, handle: Any) -> None:
            self._chunks = handle.getMapState("days", "chunk int", _STATE)

        def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
            chunks: dict[int, tuple[list, list]] = {}
            changed = set()
            for row in rows:
                number, at = divmod(row["_day"], CHUNK_DAYS)
                sums, known = self._chunk(chunks, number)
                held = ExactSum.of_text(sums[at], scale)
                if scale is None:
                    held.add(tuple(row[name] for name in LIMBS))
                else:
                    held.add_whole(int(row["_whole"] or 0))
                sums[at], known[at] = held.text(), (known[at] or 0) + row["_known"]
                changed.add(row["_day"])
            for number in {day // CHUNK_DAYS for day in changed}:
                self._chunks.updateValue((number,), chunks[number])
            yield from self._windows(key, chunks, changed)

        def _chunk(self, chunks: dict, number: int) -> tuple[list, list]:
            if number not in chunks:
                kept = self._chunks.getValue((number,)) if self._chunks.containsKey((number,)) else None
                # A day without a record has no count of known values.
                empty = ([None] * CHUNK_DAYS, [None] * CHUNK_DAYS)
                chunks[number] = empty if kept is None else (list(kept[0]), list(kept[1]))
            return chunks[number]

        def _windows(self, key: Any, chunks: dict, changed: set[int]) -> Iterator[Row]:
            starts = set()
            for day in changed:
                before = day - window_days
                starts.update(range(before - before % slide_days + slide_days, day + 1, slide_days))
            held, known, days, low, high = ExactSum(scale), 0, 0, 0, 0
            for start in sorted(starts):
                if start >= high:
                    held, known, days, low, high = ExactSum(scale), 0, 0, start, start
                for first, last, way in ((low, start, -1), (high, start + window_days, 1)):
                    for day in range(first, last):
                        number, at = divmod(day, CHUNK_DAYS)
                        sums, counts = self._chunk(chunks, number)
                        if counts[at] is not None:
                            held.merge(ExactSum.of_text(sums[at], scale), way)
                            known += way * counts[at]
                            days += way
                low, high = start, start + window_days
                if days:
                    labels = {"start_date": _EPOCH + timedelta(start), "end_date": _EPOCH + timedelta(high)}
                    own = dict(zip(keys, key, strict=True))
                    yield Row(**labels, **own, avg=held.value() / divisor if known else None)

    return Updates()
