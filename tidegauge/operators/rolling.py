"""Sliding and tumbling averages of a daily series.

The data is reduced to one row per key and day before anything is shuffled by
key, so a key holding a large share of the rows still contributes no more than
one row per calendar day to the task that owns it.

A window's sum only changes on the days a record enters or leaves it. The operator
therefore sorts two change points per key and day, keeps a running sum over them,
and expands the runs between change points into windows. The work follows the
size of the result, not rows times window length.

Running sums of floating-point values would leave rounding residue behind, and
their last digits would depend on the order of the rows. Such values are added up
exactly instead (see ``functions.exact``): in parts as whole numbers on Spark, and
along a key's days, of which there are no more than the calendar has, as Python
integers. An average is the exact sum rounded once, then divided.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions import (
    LIMBS,
    ExactSum,
    check_window,
    date_of_day,
    first_window_start,
    last_window_start,
    limb_columns,
    percent_change_of,
)
from tidegauge.operators.keys import check_dates, key_names


def daily_totals(
    df: DataFrame,
    key: str | Sequence[str] = "country",
    date: str = "date",
    value: str = "cases",
    total: str = "total",
) -> DataFrame:
    """Sum per key and day; rows without a date are dropped.

    Partial sums are built before the shuffle. A day whose values are all NULL
    keeps its row, with a NULL total. Floating-point totals are exact sums, rounded once.
    """
    keys = key_names(key)
    check_dates(df, date)
    if _is_floating(df, value):
        bins = F.struct(*LIMBS).alias("_limbs")
        totals = _limb_totals(df, keys, date, value).groupBy(*keys, date)
        totals = totals.agg(F.collect_list(bins).alias("_limbs"), F.sum("_known").alias("_known"))
        return totals.select(date, *keys, F.when(F.col("_known") > 0, _exact_total("_limbs")).alias(total))
    return (
        df.where(F.col(date).isNotNull())
        .groupBy(*keys, date)
        .agg(F.sum(value).alias(total))
        .select(date, *keys, total)
    )


def rolling_average(
    df: DataFrame,
    key: str | Sequence[str] = "country",
    date: str = "date",
    value: str = "cases",
    window_days: int = 7,
    slide_days: int = 1,
    *,
    strict: bool = False,
    colocated: bool = False,
    partitions: int | None = None,
    fill_gaps: bool = False,
) -> DataFrame:
    """Sum of ``value`` per key and window over the number of slides per window.

    Windows that hold no record of a key do not exist for that key, unless ``fill_gaps`` asks
    for all windows between a key's first and its last: those without a record then have the
    average zero. They come out of the same runs, without another shuffle or sort.

    The constant divisor spreads a coarse record evenly: a weekly figure counts at a seventh
    in each of the seven daily windows that hold it. Averages are the same however the rows
    are partitioned, those of floating-point values included.

    ``colocated`` says that ``df`` is already hash-partitioned by ``key`` (it comes
    out of a key-partitioned window function, say), which saves both shuffles.
    ``partitions`` fixes the number of key partitions. By default they are the session's
    shuffle partitions, coalesced by the size of the daily totals; a window of many
    slides over sparse keys grows far beyond that size and is better given a number.

    Returns ``start_date, end_date, <key>, avg`` for the range
    ``[start_date, end_date)``.
    """
    keys = key_names(key)
    runs = _window_runs(
        df, keys, date, value, window_days, slide_days, strict, colocated, partitions, fill_gaps
    )
    windows = runs.select(*keys, "avg", F.explode(_run_starts(slide_days)).alias("_start"))
    return windows.select(*_labels(window_days), *keys, "avg")


def rolling_change(
    df: DataFrame,
    key: str | Sequence[str] = "country",
    date: str = "date",
    value: str = "cases",
    window_days: int = 7,
    slide_days: int = 1,
    *,
    strict: bool = False,
    colocated: bool = False,
    partitions: int | None = None,
    fill_gaps: bool = False,
) -> DataFrame:
    """``percent_change(rolling_average(...))`` in one pass over the runs.

    All windows of a run have the same average, so the previous average is looked
    up once per run, in the order the runs are already sorted in. The expanded
    windows are never sorted or shuffled again. With ``fill_gaps`` the windows that
    ``rolling_average`` fills in take part: the first of a gap falls by 100 percent, and what
    follows a zero is NULL.
    """
    runs = change_runs(
        df,
        key,
        date,
        value,
        window_days,
        slide_days,
        strict=strict,
        colocated=colocated,
        partitions=partitions,
        fill_gaps=fill_gaps,
    )
    return expand_changes(runs, key, window_days, slide_days)


def change_runs(
    df: DataFrame,
    key: str | Sequence[str] = "country",
    date: str = "date",
    value: str = "cases",
    window_days: int = 7,
    slide_days: int = 1,
    *,
    strict: bool = False,
    colocated: bool = False,
    partitions: int | None = None,
    fill_gaps: bool = False,
) -> DataFrame:
    """The computed part of ``rolling_change``, before it is expanded into windows.

    Never larger than two rows per key and day, so this is what to persist where the
    changes are read more than once.
    """
    keys = key_names(key)
    runs = _window_runs(
        df, keys, date, value, window_days, slide_days, strict, colocated, partitions, fill_gaps
    )
    if "_before" in runs.columns:
        return runs
    in_order = Window.partitionBy(*keys).orderBy("_start")
    return runs.withColumn("_before", F.lag("avg", 1).over(in_order))


def expand_changes(
    runs: DataFrame,
    key: str | Sequence[str] = "country",
    window_days: int = 7,
    slide_days: int = 1,
) -> DataFrame:
    """Expand ``change_runs`` into the windows of ``rolling_change``, row by row."""
    keys = key_names(key)
    windows = runs.select(
        *keys, "avg", "_before", F.posexplode(_run_starts(slide_days)).alias("_nth", "_start")
    )
    previous = F.when(F.col("_nth") == 0, F.col("_before")).otherwise(F.col("avg"))
    return windows.select(
        *_labels(window_days),
        *keys,
        "avg",
        percent_change_of(F.col("avg"), previous).alias("avg_increase"),
    )


def _labels(window_days: int) -> list[Column]:
    start = F.col("_start")
    return [
        date_of_day(start).alias("start_date"),
        date_of_day(start + F.lit(window_days)).alias("end_date"),
    ]


def _run_starts(slide_days: int) -> Column:
    return F.sequence(F.col("_start"), F.col("_until") - F.lit(slide_days), F.lit(slide_days))


def _window_runs(
    df: DataFrame,
    keys: list[str],
    date: str,
    value: str,
    window_days: int,
    slide_days: int,
    strict: bool,
    colocated: bool,
    partitions: int | None,
    fill_gaps: bool,
) -> DataFrame:
    """Runs of windows with equal content: ``<keys>, _start, _until, avg``.

    A run covers the window starts ``_start, _start + slide, ...`` below ``_until``. With
    ``fill_gaps`` the stretches between a key's runs are runs of zeros. Runs of floating-point
    values come with ``_before``, the average of their key's run before them.
    """
    divisor = check_window(window_days, slide_days, strict)
    check_dates(df, date)
    floating = _is_floating(df, value)
    if floating:
        daily = _limb_totals(df, keys, date, value)
    else:
        daily = (
            df.where(F.col(date).isNotNull())
            .groupBy(*keys, date)
            .agg(F.sum(value).alias("_sum"), F.count(value).alias("_known"))
        )
    if not colocated:
        # Everything below keeps this partitioning, so every step up to the changes
        # stays inside it.
        daily = daily.repartition(*([partitions] if partitions else []), *keys)
    first = first_window_start(F.col(date), window_days, slide_days)
    after_last = last_window_start(F.col(date), slide_days) + F.lit(slide_days)
    if floating:
        return _exact_runs(daily, keys, first, after_last, divisor, fill_gaps)

    entering = (first, F.col("_sum"), F.col("_known"), F.lit(1))
    leaving = (after_last, -F.col("_sum"), -F.col("_known"), F.lit(-1))
    names = ("_start", "_sum", "_known", "_days")
    change_points = F.array(
        *(
            F.struct(*(field.alias(name) for name, field in zip(names, point)))
            for point in (entering, leaving)
        )
    )
    # Rows of one start are summed one after the other; only the last of them, the
    # one with a later start next to it, has the sum of all.
    in_order = Window.partitionBy(*keys).orderBy("_start")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = daily.select(*keys, F.inline(change_points)).select(
        *keys,
        "_start",
        F.lead("_start", 1).over(in_order).alias("_until"),
        *(F.sum(name).over(so_far).alias(name) for name in names[1:]),
    )
    runs = runs.where(F.col("_until") > F.col("_start"))
    average = F.when(F.col("_known") > 0, F.col("_sum")).cast("double") / F.lit(divisor)
    if fill_gaps:
        average = F.when(F.col("_days") > 0, average).otherwise(F.lit(0.0))
    else:
        runs = runs.where(F.col("_days") > 0)
    return runs.select(*keys, "_start", "_until", average.alias("avg"))


def _is_floating(df: DataFrame, value: str) -> bool:
    return not isinstance(df.schema[value].dataType, (T.IntegralType, T.DecimalType))


def _limb_totals(df: DataFrame, keys: list[str], date: str, value: str) -> DataFrame:
    """Exact sums per key, day and bin of floating-point values, and the count of those known."""
    known = F.col(value).isNotNull().cast("bigint").alias("_known")
    limbs = df.where(F.col(date).isNotNull()).select(*keys, date, *limb_columns(F.col(value)), known)
    summed = (F.sum(name).alias(name) for name in (*LIMBS[1:], "_known"))
    return limbs.groupBy(*keys, date, LIMBS[0]).agg(*summed)


@F.pandas_udf(T.DoubleType())
def _exact_total(limbs):
    def total(bins):
        found = ExactSum()
        for row in bins:
            found.add(tuple(None if row[x] is None or row[x] != row[x] else int(row[x]) for x in LIMBS))
        return found.value()

    return limbs.map(total)


def _exact_runs(
    daily: DataFrame, keys: list[str], first: Column, after_last: Column, divisor: int, fill_gaps: bool
) -> DataFrame:
    """The runs of totals in limbs; their rows are in the partitions of their keys."""
    # NaN and NULL are keys too: Spark says where a key starts.
    in_order = Window.partitionBy(*keys).orderBy("_first", "_after")
    rows = daily.select(*keys, first.alias("_first"), after_last.alias("_after"), "_known", *LIMBS)
    rows = rows.withColumn("_place", F.row_number().over(in_order)).sortWithinPartitions(*keys, "_first", "_after")
    fields = [T.StructField("_start", T.IntegerType()), T.StructField("_until", T.IntegerType())]
    averages = [T.StructField(name, T.DoubleType()) for name in ("avg", "_before")]
    schema = T.StructType([*daily.select(*keys).schema, *fields, *averages])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, points = None, []
        for batch in batches:
            given = batch.to_pydict()
            made = []
            for k, place in enumerate(given["_place"]):
                if place == 1:
                    made.append((key, _runs_of(points, divisor, fill_gaps)))
                    key, points = batch.select(keys).slice(k, 1), []
                limbs = tuple(given[x][k] for x in LIMBS)
                points.append((given["_first"][k], limbs, given["_known"][k], 1))
                points.append((given["_after"][k], limbs, given["_known"][k], -1))
            yield from _run_batches(made, schema)
        yield from _run_batches([(key, _runs_of(points, divisor, fill_gaps))], schema)

    return rows.mapInArrow(run, schema)


def _runs_of(points: list[tuple[int, tuple, int, int]], divisor: int, fill_gaps: bool) -> list[tuple]:
    """Start, end, average and average before of the runs between one key's change points."""
    runs, held, known, open_, before = [], ExactSum(), 0, 0, None
    points = sorted(points, key=lambda point: point[0])
    for point, after in zip(points, [*points[1:], None]):
        start, limbs, count, way = point
        held.add(limbs, way)
        known += way * count
        open_ += way
        if after is not None and after[0] > start and (open_ or fill_gaps):
            average = held.value() / divisor if known else None if open_ else 0.0
            runs.append((start, after[0], average, before))
            before = average
    return runs


def _run_batches(
    made: list[tuple[pa.RecordBatch | None, list[tuple]]], schema: T.StructType
) -> Iterator[pa.RecordBatch]:
    made = [(key, runs) for key, runs in made if runs]
    if made:
        at = pa.array([k for k, (_, runs) in enumerate(made) for _ in runs])
        keys = pa.Table.from_batches([key for key, _ in made]).combine_chunks().take(at)
        values = zip(*(run for _, runs in made for run in runs))
        kinds = (pa.int32(), pa.int32(), pa.float64(), pa.float64())
        arrays = [pa.array(column, kind) for column, kind in zip(values, kinds)]
        columns = [column.combine_chunks() for column in keys.columns]
        yield pa.RecordBatch.from_arrays([*columns, *arrays], schema.names)
