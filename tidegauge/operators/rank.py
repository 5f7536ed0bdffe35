"""Top ranks per period, ties kept."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.operators.keys import key_names

#: Values of a period that are ranked in one step.
PERIOD_VALUES = 200_000
#: Values after which a task looks again for the best of its periods, and those it remembers at most.
NEW_VALUES, KNOWN_VALUES = 20_000, 1_000_000

_PERIODS = (T.DateType, T.TimestampType, T.TimestampNTZType, T.IntegralType, T.StringType)
_NUMBERS = (T.IntegralType, T.FloatType, T.DoubleType)
# Types that go through Arrow as they are.
_PLAIN = (T.BooleanType, T.NumericType, T.BinaryType, *_PERIODS)


def rank_within(
    df: DataFrame,
    period: str = "end_date",
    by: str = "avg_increase",
    limit: int = 10,
    output: str = "rank",
    *,
    key: str | Sequence[str] | None = None,
    cells: int | None = None,
) -> DataFrame:
    """Rows whose dense rank by ``by``, descending, is at most ``limit``.

    Equal values share a rank and ranks have no gaps, so a period can hold any
    number of rows per rank. NULLs share one rank after all values. A limit below
    one gives no rows.

    Ties make a period unbounded, so no task ever receives one whole. Its rows are
    divided into cells by a hash of ``key`` (by default all other columns), which should
    tell the rows of a period apart:

    1. each cell keeps its rows of the best ``limit`` values. This shuffle, by cell, is
       the only one that moves rows of the input. Of numbers, a task first drops the rows that
       it has seen ``limit`` better values for, so that it sorts few of its rows;
    2. the distinct values of all cells of a period, at most ``limit`` from each, are
       ranked together. Where these may be many, groups of cells drop all but their own
       best ``limit`` values first;
    3. the ranks return to their cells. A cell's values are in the same order as
       their ranks, so the n-th value of a cell takes the n-th of its ranks.

    Spark may evaluate ``df`` twice, so ``by`` must come out the same both times, as the changes
    of this library do: its sums don't depend on the order of the rows. Persist a frame whose
    ``by`` comes from Spark's own sums of floating-point values.

    Where ``df`` is hash-partitioned by ``key`` into ``cells`` partitions (by default the
    session's shuffle partitions), as the output of ``rolling_change`` is, a cell lies
    in one input partition and all but its best rows are dropped before the shuffle.
    """
    others = [name for name in df.columns if name not in (period, by)]
    spread = others if key is None else key_names(key)
    if cells is None:
        cells = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    highest = F.desc_nulls_last(by)
    cell = ["_period", "_cell"]
    best = (
        _without_surpassed(df, period, by, limit)
        .withColumns(_cell_columns(df, period, spread, cells))
        .withColumn("_place", F.dense_rank().over(Window.partitionBy(*cell).orderBy(highest)))
        .where(F.col("_place") <= limit)
    )
    # The checksum makes this branch read the same columns as the join below, so
    # that Spark computes and shuffles the best rows once and reuses them.
    checksum = F.bit_xor(F.xxhash64(period, *others))
    values = best.groupBy(*cell, by).agg(checksum.alias("_sum")).where(F.col("_sum").isNotNull())
    without_period = F.col("_cell") < 0
    if limit * cells > PERIOD_VALUES:
        group = F.pmod(F.abs("_cell"), F.lit(math.isqrt(cells)))
        near = Window.partitionBy("_period", without_period, group).orderBy(highest)
        values = values.withColumn("_near", F.dense_rank().over(near)).where(F.col("_near") <= limit)
    whole_period = Window.partitionBy("_period", without_period).orderBy(highest)
    ranks = (
        values.withColumn("_rank", F.dense_rank().over(whole_period))
        .where(F.col("_rank") <= limit)
        .groupBy(*cell)
        .agg(F.array_sort(F.collect_list("_rank")).alias("_ranks"))
    )
    return (
        best.join(ranks.hint("merge"), cell)
        .where(F.col("_place") <= F.size("_ranks"))
        .select(*df.columns, F.get("_ranks", F.col("_place") - 1).alias(output))
    )


def _without_surpassed(df: DataFrame, period: str, by: str, limit: int) -> DataFrame:
    """Without rows for which a task has seen ``limit`` better values of their period.

    Sorting is left to what remains: of rows in no order, a number for each period that grows
    with the logarithm of a task's rows, besides ties. Periods, other columns or values of types
    that aren't plain are left as they are.
    """
    kinds = {field.name: field.dataType for field in df.schema}
    plain = all(isinstance(kind, _PLAIN) for kind in kinds.values()) and len(kinds) == len(df.columns)
    if limit < 1 or not plain or not isinstance(kinds[period], _PERIODS) or not isinstance(kinds[by], _NUMBERS):
        return df
    return df.mapInArrow(_best_of_task(df.columns.index(period), df.columns.index(by), limit), df.schema)


def _best_of_task(period: int, by: int, limit: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(limit)
        for batch in batches:
            if batch.num_rows:
                kept = best.among(batch.column(period), batch.column(by))
                yield batch if kept.all() else batch.filter(pa.array(kept))

    return run


class _Best:
    """The best values of each period among those seen. Forgetting some only keeps more rows."""

    def __init__(self, limit: int) -> None:
        self._limit = limit
        self._forget()

    def _forget(self) -> None:
        self._numbers: dict = {}
        self._floors = np.empty(0)
        self._known = self._new = (np.empty(0, np.int64), np.empty(0))

    def among(self, periods: pa.Array, values: pa.Array) -> np.ndarray:
        """Which of the rows have one of the best values so far, or one as good."""
        numbers, values = self._periods(periods), _ordered(values)
        kept = values >= self._floors[numbers]
        new = (numbers[kept], values[kept])
        self._new = tuple(np.concatenate(pair) for pair in zip(self._new, new))
        if len(self._new[0]) >= max(NEW_VALUES, len(self._known[0])):
            self._learn()
        return kept

    def _periods(self, periods: pa.Array) -> np.ndarray:
        """Numbers of the periods, counted as they appear; NULL is a period."""
        if pa.types.is_date32(periods.type):
            periods = periods.cast(pa.int32())
        elif pa.types.is_timestamp(periods.type):
            periods = periods.cast(pa.int64())
        coded = periods.dictionary_encode(null_encoding="encode")
        found = coded.dictionary.to_pylist()
        numbers = np.array([self._numbers.setdefault(x, len(self._numbers)) for x in found], np.int64)
        missing = len(self._numbers) - len(self._floors)
        self._floors = np.concatenate([self._floors, np.full(missing, -np.inf)])
        return numbers[coded.indices.to_numpy(zero_copy_only=False)]

    def _learn(self) -> None:
        numbers, values = (np.concatenate(pair) for pair in zip(self._known, self._new))
        order = np.lexsort((-values, numbers))
        numbers, values = numbers[order], values[order]
        other = np.ones(len(numbers), bool)
        other[1:] = (numbers[1:] != numbers[:-1]) | (values[1:] != values[:-1])
        numbers, values = numbers[other], values[other]
        place = np.arange(len(numbers)) - np.searchsorted(numbers, numbers)
        last = place == self._limit - 1
        self._floors[numbers[last]] = values[last]
        best = place < self._limit
        self._known, self._new = (numbers[best], values[best]), (np.empty(0, np.int64), np.empty(0))
        if len(self._known[0]) > KNOWN_VALUES:
            self._forget()


def _ordered(values: pa.Array) -> np.ndarray:
    """Numbers in Spark's order, which may make equals of near ones: that only keeps more rows."""
    found = values.fill_null(0).to_numpy(zero_copy_only=False).astype(float)
    found = np.where(np.isnan(found), np.inf, found)
    return np.where(values.is_valid().to_numpy(zero_copy_only=False), found, -np.inf)


def _cell_columns(df: DataFrame, period: str, spread: list[str], cells: int) -> dict[str, Column]:
    """Columns that name a row's cell and are never NULL, so that cells can be joined.

    A NULL period takes some value of its type and a negative cell number. The number
    depends on nothing but the row, so that reading the input twice gives the same cells.
    """
    kind = df.schema[period].dataType
    some = [F.lit(text).try_cast(kind) for text in ("1970-01-01", "0")]
    number = F.pmod(F.hash(*spread) if spread else F.lit(0), F.lit(cells))
    # pmod counts as nullable. Left so, the join would add a filter to one of the two
    # branches, and they would no longer share their shuffle.
    number = F.coalesce(number, F.lit(0))
    return {
        "_period": F.coalesce(period, *some),
        "_cell": F.when(F.col(period).isNull(), -1 - number).otherwise(number),
    }
