"""

The test tables hold no case reports, so each query first maps a table onto the
series ``(date, cases, country)`` or onto the levels ``(day, country, infected)``.
Every query reads its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge import (
    Layout,
    count_rejects,
    counter_to_increments,
    current_report,
    daily_totals,
    date_prefix,
    date_prefix_buckets,
    date_prefix_counts,
    normalise,
    percent_change,
    read_date_prefix,
    read_rejects,
    read_replaced,
    read_rank_updates,
    read_report,
    read_series,
    read_split,
    read_stream_report,
    read_updates,
    report_frames,
    rocksdb_state,
    rolling_average,
    rolling_change,
    run_report,
    start_rank,
    start_rank_updates,
    start_replace,
    start_report,
    start_split,
    start_table,
    start_updates,
    stream_counter_to_increments,
    stream_in_time,
    stream_percent_change,
    stream_rejects,
    stream_rolling_average,
    stream_rolling_updates,
    stream_series,
    work_dir,
    write_date_prefixes,
    write_report,
)
from tidegauge.sources import CASE_REPORT_SCHEMA, COUNTER_SCHEMA

try:
    import corpus_pipeline
    from tidegauge.llm import queries as llm
except ModuleNotFoundError as error:
    # The corpus operators and their pipeline are an extra that may be left out.
    if error.name not in {"corpus_pipeline", "tidegauge.llm"}:
        raise
    llm = corpus_pipeline = None

Query = Callable[[SparkSession, str], DataFrame]


# Brings the days of the events, in January 2024, to both sides of 1970-01-01.
_DAYS_TO_1970 = 19_738
# Type and expression of values with decimal places, and of values that doubles hold exactly.
_DECIMAL = ("decimal(15,2)", "l_extendedprice")
_DOUBLE = ("double", "cast(l_quantity as int) / 4")
# Values whose sums a double can't hold.
_REVENUE = "l_extendedprice * (1 - l_discount) * (1 + l_tax)"

# By so many days a row of the split stream may lie behind the newest date.
_LATE_DAYS = 10

# --- Test tables as series and levels ---------------------------------------


def _events_series(df: DataFrame) -> DataFrame:
    cases = F.col("event_id") % 3 - 1
    return normalise(df, date="ts", cases=cases, country="event_type")


def _conversation_levels(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("turn").cast("int").alias("day"),
        F.col("conv_id").alias("country"),
        F.length("text").alias("infected"),
    )


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events_series(_table(spark, sf_dir, "events"))


def _events_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "events")
    return normalise(
        df,
        date=F.when(F.col("value") >= 5, F.col("ts")),
        cases=F.when(F.col("value") <= 100, F.col("event_id") % 3 - 1),
        country="event_type",
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "orders")
    return normalise(df, date="o_orderdate", cases=F.lit(1), country="o_custkey")


def _orders_by_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    week = F.date_trunc("week", F.col("date").cast("timestamp_ntz")).cast("date")
    by_day = _orders(spark, sf_dir)
    return (
        by_day.groupBy("country", week.alias("date"))
        .agg(F.sum("cases").cast("int").alias("cases"))
        .select("date", "cases", "country")
    )


def _lineitem_series(df: DataFrame, country: str = "l_returnflag") -> DataFrame:
    return normalise(df, date="l_shipdate", cases="l_quantity", country=country)


def _lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineitem_series(_table(spark, sf_dir, "lineitem"))


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineitem_series(_table(spark, sf_dir, "lineitem"), "l_partkey")


def _prices(kind: str, price: str, country: str = "l_returnflag") -> Query:
    """Values that are not whole numbers, which ``normalise`` would cut off."""

    def series(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = _table(spark, sf_dir, "lineitem")
        return df.select(
            F.col("l_shipdate").cast("date").alias("date"),
            F.expr(price).cast(kind).alias("cases"),
            F.col(country).cast("string").alias("country"),
        )

    return series


def _repeated_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels of which every third comes twice, the second time as a correction upwards."""
    levels = _levels(spark, sf_dir)
    again = levels.where("infected % 3 = 0").withColumn("infected", F.col("infected") + 1)
    return levels.unionByName(again)


def _levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conversation_levels(_table(spark, sf_dir, "conversations"))


def _increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counter_to_increments(_levels(spark, sf_dir))


def _table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # A stream's path must be a folder or a pattern; the braces make it a pattern that
    # matches the table whether it is one file or a folder of files.
    schema = _table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{{{name}}}.parquet")


def _events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events_series(_table_stream(spark, sf_dir, "events"))


def _levels_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _conversation_levels(_table_stream(spark, sf_dir, "conversations"))


# --- CSV files made from the test tables ------------------------------------


def _case_report_rows(series: DataFrame) -> DataFrame:
    given = {
        "dateRep": F.date_format("date", "d/M/y"),
        "day": F.dayofmonth("date"),
        "month": F.month("date"),
        "year": F.year("date"),
        "cases": F.col("cases"),
        "countriesAndTerritories": F.col("country"),
    }
    return series.select(
        *(
            given.get(field.name, F.lit(None).cast("string")).alias(field.name)
            for field in CASE_REPORT_SCHEMA
        )
    )


def _write_csv(df: DataFrame, path: str) -> str:
    df.write.option("header", True).csv(path)
    return path


def _events_csv(spark: SparkSession, sf_dir: str) -> str:
    rows = _case_report_rows(_events(spark, sf_dir))
    return _write_csv(rows, work_dir(spark, "case-report"))


def _conversations_csv(spark: SparkSession, sf_dir: str) -> str:
    rows = _levels(spark, sf_dir).withColumns({"susceptible": F.lit(0), "immune": F.lit(0)})
    return _write_csv(rows.select(*COUNTER_SCHEMA.names), work_dir(spark, "counter"))


def _csv_case_report_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_series(spark, _events_csv(spark, sf_dir), "CASE_REPORT")


def _csv_multi_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _case_report_rows(_events(spark, sf_dir))
    paths = [
        _write_csv(rows.where(part), work_dir(spark, "case-report"))
        for part in (F.col("cases") > 0, F.coalesce(F.col("cases") <= 0, F.lit(True)))
    ]
    return read_series(spark, paths)


def _csv_counter_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_series(spark, _conversations_csv(spark, sf_dir), Layout.COUNTER)


def _broken_csv(spark: SparkSession, sf_dir: str) -> str:
    rows = _case_report_rows(_events_with_nulls(spark, sf_dir)).withColumns(
        {
            "dateRep": F.coalesce("dateRep", F.lit("2024-01-01")),
            "cases": F.coalesce(F.col("cases").cast("string"), F.lit("x")),
        }
    )
    return _write_csv(rows, work_dir(spark, "case-report"))


def _csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_rejects(spark, _broken_csv(spark, sf_dir))


def _csv_reject_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejects = read_rejects(spark, _broken_csv(spark, sf_dir))
    placed = F.col("file").endswith(".csv") & (F.col("block_start") >= 0)
    return rejects.select("record", F.array_join("failing", " ").alias("failing"), placed.alias("placed"))


def _stream_csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = stream_series(spark, _broken_csv(spark, sf_dir), rejects="rejects")
    query = start_table(series, work_dir(spark, "stream"), work_dir(spark, "checkpoint"))
    query.awaitTermination()
    counts = spark.createDataFrame(stream_rejects(query, "rejects"), "batch bigint, records bigint, rejected bigint")
    return counts.agg(F.sum("records").alias("records"), F.sum("rejected").alias("rejected"))


def _csv_sink_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    averages = rolling_average(_events(spark, sf_dir))
    path = work_dir(spark, "avg")
    write_report(averages, path)
    return read_report(spark, path, averages.schema)


def _csv_report(layout: Layout, output: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        write = _events_csv if layout is Layout.CASE_REPORT else _conversations_csv
        source = write(spark, sf_dir)
        paths = run_report(spark, source, layout, work_dir(spark, "report"))
        frames = report_frames(read_series(spark, source, layout))
        index = ("avg", "rank").index(output)
        return read_report(spark, paths[index], frames[index].schema)

    return query


def _csv_report_versioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = work_dir(spark, "report")
    source = _events_csv(spark, sf_dir)
    run_report(spark, source, out_dir=out, rank_limit=1, versioned=True)
    run_report(spark, source, out_dir=out, versioned=True)
    ranks = report_frames(read_series(spark, source))[1]
    return read_report(spark, current_report(spark, out)[1], ranks.schema)


def _csv_report_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = _parts(spark, sf_dir)
    source = _write_csv(_case_report_rows(series), work_dir(spark, "case-report"))
    # A window of a part is a row of the averages: as plain text many times the table.
    paths = run_report(spark, source, out_dir=work_dir(spark, "report"), compression="gzip")
    return read_report(spark, paths[1], report_frames(series)[1].schema)


def _csv_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    averages = rolling_average(_events(spark, sf_dir))
    path = work_dir(spark, "avg")
    write_report(averages.where("avg > 0"), path)
    write_report(averages, path)
    return read_report(spark, path, averages.schema)


def _csv_repeated_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _repeated_turns(spark, sf_dir).withColumns({"susceptible": F.lit(0), "immune": F.lit(0)})
    source = _write_csv(rows.select(*COUNTER_SCHEMA.names), work_dir(spark, "counter"))
    return read_series(spark, source, Layout.COUNTER, dedupe="max")


def _csv_date_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = _events(spark, sf_dir)
    path = work_dir(spark, "prefixes")
    write_date_prefixes(series, path, step=5)
    return read_date_prefix(spark, path, 2, series.schema)


# --- Streams, run until everything available is read ------------------------


def _as_table(spark: SparkSession, stream: DataFrame) -> DataFrame:
    path = work_dir(spark, "stream")
    start_table(stream, path, work_dir(spark, "checkpoint")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def _stream_average_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    averages = stream_rolling_average(_events_stream(spark, sf_dir), complete=True)
    path = work_dir(spark, "stream")
    start_replace(averages, path, work_dir(spark, "checkpoint")).awaitTermination()
    return read_replaced(spark, path, averages.schema)


def _stream_average_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_table(spark, stream_rolling_average(_events_stream(spark, sf_dir)))


def _stream_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    averages = stream_rolling_average(_events_stream(spark, sf_dir))
    with rocksdb_state(spark):
        return _as_table(spark, stream_percent_change(averages))


def _stream_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = stream_percent_change(stream_rolling_average(_events_stream(spark, sf_dir)))
    path = work_dir(spark, "stream")
    with rocksdb_state(spark):
        query = start_rank(changes, path, work_dir(spark, "checkpoint"), limit=3)
    query.awaitTermination()
    ranked = changes.schema.add("rank", T.IntegerType())
    return spark.read.schema(ranked).parquet(path).select(*ranked.names)


def _stream_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    increments = stream_counter_to_increments(_levels_stream(spark, sf_dir))
    with rocksdb_state(spark):
        return _as_table(spark, increments).drop("event_time")


def _files_stream(spark: SparkSession, parts: list[DataFrame]) -> DataFrame:
    """The parts as files that a stream takes one after another, one in each trigger."""
    path = work_dir(spark, "files")
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)
    reader = spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1)
    return reader.parquet(path)


def _stream_counter_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Eighths of the days, each two in the wrong order; none is late by more than two eighths.
    levels = _levels(spark, sf_dir)
    span = ((levels.agg(F.max("day")).first()[0] or 0) + 8) // 8
    eighth = F.floor(F.col("day") / span)
    parts = [levels.where(eighth == k) for k in (1, 0, 3, 2, 5, 4, 7, 6)]
    stream = _files_stream(spark, parts)
    with rocksdb_state(spark):
        increments = _as_table(spark, stream_counter_to_increments(stream, late_days=2 * span))
    return increments.drop("event_time")


def _stream_counter_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    increments = stream_counter_to_increments(_levels_stream(spark, sf_dir))
    with rocksdb_state(spark):
        return _as_table(spark, stream_rolling_average(increments))


def _stream_average_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Thirds of the records, by line: nearly all windows change in every trigger. Each third is
    # as many files as its tasks make, and a run of the query, which goes on from the last one.
    lines = _table(spark, sf_dir, "lineitem")
    files, path, checkpoint = (work_dir(spark, name) for name in ("files", "stream", "checkpoint"))
    for k in range(3):
        part = _lineitem_series(lines.where(F.col("l_linenumber") % 3 == k))
        part.write.mode("append").parquet(files)
        averages = stream_rolling_updates(spark.readStream.schema(part.schema).parquet(files), window_days=365)
        with rocksdb_state(spark):
            query = start_updates(averages, path, checkpoint)
        query.awaitTermination()
    return read_updates(spark, path, averages.schema)


def _stream_report(output: int) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        changes = stream_percent_change(stream_rolling_average(_events_stream(spark, sf_dir)))
        path = work_dir(spark, "stream")
        with rocksdb_state(spark):
            started = start_report(changes, path, work_dir(spark, "checkpoint"), limit=3)
        started.awaitTermination()
        return read_stream_report(spark, path, changes.schema)[output]

    return query


def _typed_levels(df: DataFrame) -> DataFrame:
    """Levels that aren't whole numbers, of which a day has many, and the time of each."""
    return df.select(
        F.datediff(F.col("ts").cast("date"), F.lit("2024-01-01").cast("date")).alias("day"),
        F.col("event_type").alias("country"),
        F.col("value").cast("decimal(12,3)").alias("infected"),
        F.col("value").cast("double").alias("fraction"),
        F.col("ts").alias("version"),
    )


def _stream_counter_fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = _typed_levels(_table_stream(spark, sf_dir, "events"))
    with rocksdb_state(spark):
        return _as_table(spark, stream_counter_to_increments(levels, level="fraction")).drop("event_time")


def _stream_counter_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = _typed_levels(_table_stream(spark, sf_dir, "events"))
    with rocksdb_state(spark):
        increments = stream_counter_to_increments(levels, dedupe="last", version="version")
        return _as_table(spark, increments).drop("event_time")


def _stream_csv_case_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = stream_series(spark, _events_csv(spark, sf_dir))
    return _as_table(spark, stream_rolling_average(series))


def _stream_csv_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    increments = stream_series(spark, _conversations_csv(spark, sf_dir), "counter")
    with rocksdb_state(spark):
        return _as_table(spark, increments).drop("event_time")


def _stream_average_around_1970(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = _events_stream(spark, sf_dir)
    moved = series.withColumn("date", F.date_sub("date", _DAYS_TO_1970))
    return _as_table(spark, stream_rolling_average(moved))


def _stream_average_90(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = _lineitem_series(_table_stream(spark, sf_dir, "lineitem"))
    return _as_table(spark, stream_rolling_average(series, window_days=90))


def _stream_average_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The last file's rows of days that the first two have closed are dropped.
    events = _events(spark, sf_dir)
    parts = [events.where(F.col("cases") == k) for k in (1, 0, -1)]
    stream = _files_stream(spark, parts)
    return _as_table(spark, stream_rolling_average(stream))


def _split(spark: SparkSession, sf_dir: str) -> tuple[str, T.StructType]:
    """A stream of three files, of which the later ones hold rows of days long closed."""
    events = _events(spark, sf_dir)
    parts = [events.where(F.col("cases") == k) for k in (1, 0, -1)]
    stream, path = _files_stream(spark, parts), work_dir(spark, "stream")
    start_split(stream, path, work_dir(spark, "checkpoint"), late_days=_LATE_DAYS).awaitTermination()
    return path, stream.schema


def _stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_split(spark, *_split(spark, sf_dir), late=True)


def _stream_average_in_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = stream_in_time(spark, *_split(spark, sf_dir))
    return _as_table(spark, stream_rolling_average(kept, late_days=_LATE_DAYS))


def _stream_rank_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Averages rise and fall with each third of the records, so ranks change.
    events = _events(spark, sf_dir)
    parts = [events.where(F.col("cases") == k) for k in (1, -1, 0)]
    averages = stream_rolling_updates(_files_stream(spark, parts))
    path = work_dir(spark, "stream")
    with rocksdb_state(spark):
        query = start_rank_updates(averages, path, work_dir(spark, "checkpoint"), limit=3)
    query.awaitTermination()
    return read_rank_updates(spark, path, averages.schema)


# --- Batch queries built from one series ------------------------------------


def _average(series: Query, window_days: int, slide_days: int, fill_gaps: bool = False) -> Query:
    return lambda spark, sf_dir: rolling_average(
        series(spark, sf_dir), window_days=window_days, slide_days=slide_days, fill_gaps=fill_gaps
    )


def _filled_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling_change(_orders(spark, sf_dir), window_days=56, slide_days=28, fill_gaps=True)


def _change(series: Query) -> Query:
    return lambda spark, sf_dir: rolling_change(series(spark, sf_dir))


def _change_of_average(series: Query) -> Query:
    return lambda spark, sf_dir: percent_change(rolling_average(series(spark, sf_dir)))


def _rank(series: Query, limit: int) -> Query:
    return lambda spark, sf_dir: report_frames(series(spark, sf_dir), rank_limit=limit)[1]


def _truncated_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    # 7 over 2 is the documented case of a truncated divisor; the warning is expected.
    import warnings

    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return rolling_average(_events(spark, sf_dir), window_days=7, slide_days=2)


def _change_zero_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = percent_change(rolling_average(_events(spark, sf_dir)))
    previous = F.lag("avg", 1).over(Window.partitionBy("country").orderBy("end_date"))
    return changes.withColumn("_previous", previous).where("_previous = 0").drop("_previous")


def _change_one_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rolling_change(_events(spark, sf_dir)).where(F.col("country") == "click")


def _rank_one_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = _events(spark, sf_dir)
    last = series.agg(F.max("date")).scalar()
    return report_frames(series)[1].where(F.col("end_date") == last)


def _rank_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_frames(_events(spark, sf_dir))[1].orderBy("end_date", "rank", "country")


def _counter_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_frames(_increments(spark, sf_dir), colocated=True)[1]


def entry(spark: SparkSession) -> DataFrame:
    """Top ten event types by the change of their seven-day average, per window."""
    return _rank(_events, 10)(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    extra = {} if llm is None else llm.queries() | {"pipeline": corpus_pipeline.run}
    return extra | {
        "normalise_reports_events": _events,
        "daily_totals_lineitem": lambda s, d: daily_totals(_lineitem(s, d)),
        "rolling_avg_7_1_events": _average(_events, 7, 1),
        "rolling_avg_7_1_orders": _average(_orders, 7, 1),
        "rolling_avg_7_1_lineitem": _average(_lineitem, 7, 1),
        "rolling_avg_7_2_events": _truncated_average,
        "rolling_avg_14_7_orders": _average(_orders, 14, 7),
        "rolling_avg_90_1_lineitem": _average(_lineitem, 90, 1),
        "tumbling_avg_7_7_events": _average(_events, 7, 7),
        "tumbling_avg_7_7_orders": _average(_orders, 7, 7),
        "rolling_avg_weekly_grain_orders": _average(_orders_by_week, 7, 1),
        "rolling_avg_null_dates_events": _average(_events_with_nulls, 7, 1),
        "rolling_avg_decimal_lineitem": _average(_prices(*_DECIMAL), 7, 1),
        "rolling_avg_double_lineitem": _average(_prices(*_DOUBLE), 7, 1),
        "rolling_avg_floating_lineitem": _average(_prices("double", _REVENUE), 7, 1),
        "rolling_avg_fill_gaps_orders": _average(_orders, 28, 28, fill_gaps=True),
        "pct_change_fill_gaps_orders": _filled_change,
        "pct_change_7_1_events": _change_of_average(_events),
        "pct_change_7_1_orders": _change(_orders),
        "pct_change_7_1_lineitem": _change(_lineitem),
        "pct_change_null_dates_events": _change(_events_with_nulls),
        "pct_change_zero_base_events": _change_zero_base,
        "pct_change_one_country_events": _change_one_country,
        "rank_top10_events": _rank(_events, 10),
        "rank_top3_events": _rank(_events, 3),
        "rank_top10_orders": _rank(_orders, 10),
        "rank_top3_orders": _rank(_orders, 3),
        "rank_top10_lineitem": _rank(_lineitem, 10),
        "rank_top10_lineitem_parts": _rank(_parts, 10),
        "rank_top3_floating_lineitem_suppliers": _rank(_prices("double", _REVENUE, "l_suppkey"), 3),
        "rank_one_period_events": _rank_one_period,
        "rank_sorted_events": _rank_sorted,
        "counter_to_increments_conversations": _increments,
        "counter_rank_end_to_end_conversations": _counter_rank,
        "date_prefix_subset_events": lambda s, d: date_prefix(_events(s, d), 10),
        "date_prefix_subset_lineitem": lambda s, d: date_prefix(_lineitem(s, d), 50),
        "date_prefix_buckets_events": lambda s, d: date_prefix_buckets(_events(s, d), 5),
        "date_prefix_counts_lineitem": lambda s, d: date_prefix_counts(_lineitem(s, d), 50),
        "csv_case_report_scan_events": _csv_case_report_scan,
        "csv_multi_file_scan_events": _csv_multi_file_scan,
        "csv_counter_scan_conversations": _csv_counter_scan,
        "csv_rejects_events": _csv_rejects,
        "csv_reject_rows_events": _csv_reject_rows,
        "csv_sink_round_trip_events": _csv_sink_round_trip,
        "csv_date_prefix_events": _csv_date_prefix,
        "csv_overwrite_events": _csv_overwrite,
        "csv_repeated_turns_conversations": _csv_repeated_turns,
        "csv_report_rank_parts": _csv_report_parts,
        "csv_report_versioned_rank_events": _csv_report_versioned,
        "csv_report_avg_events": _csv_report(Layout.CASE_REPORT, "avg"),
        "csv_report_rank_events": _csv_report(Layout.CASE_REPORT, "rank"),
        "csv_report_rank_conversations": _csv_report(Layout.COUNTER, "rank"),
        "stream_rolling_avg_complete_events": _stream_average_complete,
        "stream_rolling_avg_closed_events": _stream_average_closed,
        "stream_pct_change_events": _stream_change,
        "stream_rank_events": _stream_rank,
        "stream_report_avg_events": _stream_report(0),
        "stream_report_rank_events": _stream_report(1),
        "stream_rolling_avg_updates_365_lineitem": _stream_average_updates,
        "stream_counter_fractions_events": _stream_counter_fractions,
        "stream_counter_timed_versions_events": _stream_counter_versions,
        "stream_counter_to_increments_conversations": _stream_counter,
        "stream_counter_rolling_avg_conversations": _stream_counter_average,
        "stream_counter_late_days_conversations": _stream_counter_late,
        "stream_rolling_avg_around_1970_events": _stream_average_around_1970,
        "stream_rolling_avg_90_1_lineitem": _stream_average_90,
        "stream_rolling_avg_late_rows_events": _stream_average_late_rows,
        "stream_late_rows_events": _stream_late,
        "stream_rolling_avg_in_time_events": _stream_average_in_time,
        "stream_rank_open_periods_events": _stream_rank_updates,
        "stream_csv_case_report_events": _stream_csv_case_report,
        "stream_csv_counter_conversations": _stream_csv_counter,
        "stream_csv_rejects_events": _stream_csv_rejects,
    }


# --- Oracle -----------------------------------------------------------------

_EVENTS = """select cast(ts as date) as date, cast(event_id % 3 - 1 as integer) as cases,
    event_type as country from events"""
_EVENTS_WITH_NULLS = """select
    case when value >= 5 then cast(ts as date) end as date,
    case when value <= 100 then cast(event_id % 3 - 1 as integer) end as cases,
    event_type as country from events"""
_ORDERS = """select cast(o_orderdate as date) as date, 1 as cases,
    cast(o_custkey as varchar) as country from orders"""
_ORDERS_BY_WEEK = f"""select cast(date_trunc('week', date) as date) as date,
    cast(sum(cases) as integer) as cases, country from ({_ORDERS}) group by 1, 3"""
_LINEITEM = """select cast(l_shipdate as date) as date,
    cast(trunc(l_quantity) as integer) as cases, l_returnflag as country from lineitem"""
_INCREMENTS = """select cast(date '1970-01-01' + cast(turn as integer) as date) as date,
    cast(length(text) - lag(length(text), 1, 0)
        over (partition by conv_id order by turn, length(text)) as integer) as cases,
    cast(conv_id as varchar) as country from conversations"""


def _with_changes(
    series: str, window_days: int = 7, slide_days: int = 1, total: str = "sum(cases)", fill_gaps: bool = False
) -> str:
    """CTEs ``n`` (series), ``a`` (averages) and ``i`` (their percent change)."""
    steps = -(-window_days // slide_days)
    day = "date_diff('day', date '1970-01-01', n.date)"
    offset = f"((({day} % {slide_days}) + {slide_days}) % {slide_days}) + {slide_days} * k.k"
    previous = "lag(avg) over (partition by country order by end_date)"
    filled, windows = "", "s"
    if fill_gaps:
        windows = "g"
        filled = f"""f as (select country, cast(unnest(generate_series(min(start_date), max(start_date),
        interval {slide_days} day)) as date) as start_date from s group by 1),
g as (select f.start_date, f.country, case when s.start_date is null then 0 else s.avg end as avg
    from f left join s on f.start_date = s.start_date and f.country = s.country),
"""
    return f"""with n as ({series}),
s as (select cast(n.date - cast({offset} as integer) as date) as start_date, country,
        {total} / cast({window_days // slide_days} as double) as avg
    from n, range(0, {steps}) k(k)
    where n.date is not null and {offset} < {window_days} group by 1, 2),
{filled}a as (select start_date, cast(start_date + {window_days} as date) as end_date, country, avg from {windows}),
p as (select *, {previous} as previous from a),
i as (select start_date, end_date, country, avg, previous,
        (avg - previous) / nullif(previous, 0) * 100.0 as avg_increase from p),
r as (select start_date, end_date, country, avg, avg_increase, cast(dense_rank() over (
        partition by end_date order by avg_increase desc nulls last) as integer) as rank from i)
"""


_PARTS = _LINEITEM.replace("l_returnflag as", "cast(l_partkey as varchar) as")
_DECIMALS = """select cast(l_shipdate as date) as date,
    cast(l_extendedprice as decimal(15,2)) as cases, l_returnflag as country from lineitem"""
_DOUBLES = """select cast(l_shipdate as date) as date,
    trunc(l_quantity) / 4 as cases, l_returnflag as country from lineitem"""
# These values are whole numbers of 2**-52; a double parsed from a number's digits is the next one to it.
_WHOLE = f"""select cast(l_shipdate as date) as date, cast({_REVENUE} * 4503599627370496 as hugeint) as cases,
    l_returnflag as country from lineitem"""
_WHOLE_BY_SUPPLIER = _WHOLE.replace("l_returnflag as", "cast(l_suppkey as varchar) as")
_ROUNDED = "cast(cast(sum(cases) as varchar) as double) / 4503599627370496"
_EVENTS_AROUND_1970 = f"""select cast(date - {_DAYS_TO_1970} as date) as date, cases, country
    from ({_EVENTS})"""
_EVENTS_IN_TIME = f"""select * from ({_EVENTS})
    where cases >= 0 or date >= (select max(cast(ts as date)) from events where event_id % 3 = 2)"""
# A row's file is 1 minus its cases; the files before it bound its date.
_SPLIT = f"""select * from ({_EVENTS}) e where {{which}} coalesce(date < (select max(date) - {_LATE_DAYS}
    from ({_EVENTS}) o where o.cases > e.cases), false)"""
_REPEATED_TURNS = """select conv_id, turn, case when length(text) % 3 = 0 then length(text) + 1
    else length(text) end as level from conversations"""
_REPEATED_INCREMENTS = f"""select cast(date '1970-01-01' + cast(turn as integer) as date) as date,
    cast(level - lag(level, 1, 0) over (partition by conv_id order by turn) as integer) as cases,
    cast(conv_id as varchar) as country from ({_REPEATED_TURNS})"""
_TYPED_INCREMENTS = """select cast(date '1970-01-01' + cast(date - date '2024-01-01' as integer) as date) as date,
    level - lag(level, 1, 0) over (partition by country order by date) as cases, country
    from (select cast(ts as date) as date, event_type as country, {level} as level from events group by 1, 2)"""
_FRACTIONS = _TYPED_INCREMENTS.format(level="max(value)")
_TIMED_VERSIONS = _TYPED_INCREMENTS.format(level="arg_max(cast(value as decimal(12,3)), ts)")
_REJECTS = f"""select count(*) as records, count(*) filter (where date is null or cases is null) as rejected
    from ({_EVENTS_WITH_NULLS})"""
_REJECT_ROWS = f"""select case when date is null then '2024-01-01,,,,' else
        concat(day(date), '/', month(date), '/', year(date), ',', day(date), ',', month(date), ',', year(date), ',') end
        || coalesce(cast(cases as varchar), 'x') || ',,' || country || ',,,,,' as record,
    concat_ws(' ', case when date is null then 'dateRep' end, case when cases is null then 'cases' end) as failing,
    true as placed from ({_EVENTS_WITH_NULLS}) where date is null or cases is null"""
_EIGHTHS = "(select 2 * cast(trunc((max(turn) + 8) / 8) as integer) as late, max(turn) as last from conversations)"

_AVG = "select start_date, end_date, country, avg from a"
_INC = "select start_date, end_date, country, avg, avg_increase from i"
_CLOSED = " where end_date <= (select max(date) from n)"


def _rank_sql(series: str, limit: int, total: str = "sum(cases)") -> str:
    return _with_changes(series, total=total) + f"select * from r where rank <= {limit}"


def _prefix_sql(series: str, dates: int) -> str:
    return f"""with n as ({series})
select * from n where date in (select distinct date from n order by date limit {dates})"""


def _bucketed(series: str, step: int) -> str:
    return f"""with n as ({series}), b as (select date,
    cast(ceil(row_number() over (order by date) / cast({step} as double)) as integer) as bucket
    from (select distinct date from n where date is not null))
"""


def oracle_sql() -> dict[str, str]:
    averages = _with_changes(_EVENTS) + _AVG
    closed_averages = averages + _CLOSED
    counter_ranks = _rank_sql(_INCREMENTS, 10)
    extra = {} if llm is None else llm.oracle_sql()
    return extra | {
        "normalise_reports_events": _EVENTS,
        "daily_totals_lineitem": f"""select date, country, cast(sum(cases) as bigint) as total
            from ({_LINEITEM}) group by 1, 2""",
        "rolling_avg_7_1_events": averages,
        "rolling_avg_7_1_orders": _with_changes(_ORDERS) + _AVG,
        "rolling_avg_7_1_lineitem": _with_changes(_LINEITEM) + _AVG,
        "rolling_avg_7_2_events": _with_changes(_EVENTS, 7, 2) + _AVG,
        "rolling_avg_14_7_orders": _with_changes(_ORDERS, 14, 7) + _AVG,
        "rolling_avg_90_1_lineitem": _with_changes(_LINEITEM, 90, 1) + _AVG,
        "tumbling_avg_7_7_events": _with_changes(_EVENTS, 7, 7) + _AVG,
        "tumbling_avg_7_7_orders": _with_changes(_ORDERS, 7, 7) + _AVG,
        "rolling_avg_weekly_grain_orders": _with_changes(_ORDERS_BY_WEEK) + _AVG,
        "rolling_avg_null_dates_events": _with_changes(_EVENTS_WITH_NULLS) + _AVG,
        "rolling_avg_decimal_lineitem": _with_changes(_DECIMALS) + _AVG,
        "rolling_avg_double_lineitem": _with_changes(_DOUBLES) + _AVG,
        "rolling_avg_floating_lineitem": _with_changes(_WHOLE, total=_ROUNDED) + _AVG,
        "rolling_avg_fill_gaps_orders": _with_changes(_ORDERS, 28, 28, fill_gaps=True) + _AVG,
        "pct_change_fill_gaps_orders": _with_changes(_ORDERS, 56, 28, fill_gaps=True) + _INC,
        "pct_change_7_1_events": _with_changes(_EVENTS) + _INC,
        "pct_change_7_1_orders": _with_changes(_ORDERS) + _INC,
        "pct_change_7_1_lineitem": _with_changes(_LINEITEM) + _INC,
        "pct_change_null_dates_events": _with_changes(_EVENTS_WITH_NULLS) + _INC,
        "pct_change_zero_base_events": _with_changes(_EVENTS) + _INC + " where previous = 0",
        "pct_change_one_country_events": _with_changes(_EVENTS) + _INC + " where country = 'click'",
        "rank_top10_events": _rank_sql(_EVENTS, 10),
        "rank_top3_events": _rank_sql(_EVENTS, 3),
        "rank_top10_orders": _rank_sql(_ORDERS, 10),
        "rank_top3_orders": _rank_sql(_ORDERS, 3),
        "rank_top10_lineitem": _rank_sql(_LINEITEM, 10),
        "rank_top10_lineitem_parts": _rank_sql(_PARTS, 10),
        "rank_top3_floating_lineitem_suppliers": _rank_sql(_WHOLE_BY_SUPPLIER, 3, _ROUNDED),
        "rank_one_period_events": _rank_sql(_EVENTS, 10)
        + " and end_date = (select max(date) from n)",
        "rank_sorted_events": _rank_sql(_EVENTS, 10) + " order by end_date, rank, country",
        "counter_to_increments_conversations": _INCREMENTS,
        "counter_rank_end_to_end_conversations": counter_ranks,
        "date_prefix_subset_events": _prefix_sql(_EVENTS, 10),
        "date_prefix_subset_lineitem": _prefix_sql(_LINEITEM, 50),
        "date_prefix_buckets_events": _bucketed(_EVENTS, 5)
        + "select n.date, cases, country, bucket from n join b on n.date = b.date",
        "date_prefix_counts_lineitem": _bucketed(_LINEITEM, 50)
        + """select bucket, dates, records, cast(sum(records) over (order by bucket) as bigint)
            as prefix_records from (select bucket, count(distinct n.date) as dates,
            count(*) as records from n join b on n.date = b.date group by 1)""",
        "csv_case_report_scan_events": _EVENTS,
        "csv_multi_file_scan_events": _EVENTS,
        "csv_counter_scan_conversations": _INCREMENTS,
        "csv_rejects_events": _REJECTS,
        "csv_reject_rows_events": _REJECT_ROWS,
        "csv_sink_round_trip_events": averages,
        "csv_date_prefix_events": _prefix_sql(_EVENTS, 10),
        "csv_overwrite_events": averages,
        "csv_repeated_turns_conversations": _REPEATED_INCREMENTS,
        "csv_report_rank_parts": _rank_sql(_PARTS, 10),
        "csv_report_versioned_rank_events": _rank_sql(_EVENTS, 10),
        "csv_report_avg_events": _with_changes(_EVENTS) + _INC,
        "csv_report_rank_events": _rank_sql(_EVENTS, 10),
        "csv_report_rank_conversations": counter_ranks,
        "stream_rolling_avg_complete_events": averages,
        "stream_rolling_avg_closed_events": closed_averages,
        "stream_pct_change_events": _with_changes(_EVENTS) + _INC + _CLOSED,
        "stream_rank_events": _rank_sql(_EVENTS, 3) + " and end_date <= (select max(date) from n)",
        "stream_report_avg_events": _with_changes(_EVENTS) + _INC + _CLOSED,
        "stream_report_rank_events": _rank_sql(_EVENTS, 3) + " and end_date <= (select max(date) from n)",
        "stream_rolling_avg_updates_365_lineitem": _with_changes(_LINEITEM, 365, 1) + _AVG,
        "stream_counter_fractions_events": _FRACTIONS,
        "stream_counter_timed_versions_events": _TIMED_VERSIONS,
        "stream_counter_to_increments_conversations": _INCREMENTS,
        "stream_counter_rolling_avg_conversations": _with_changes(_INCREMENTS) + _AVG + _CLOSED,
        "stream_counter_late_days_conversations": f"""select i.* from ({_INCREMENTS}) i, {_EIGHTHS}
            where date <= date '1970-01-01' + cast(last - late as integer)""",
        "stream_rolling_avg_around_1970_events": _with_changes(_EVENTS_AROUND_1970) + _AVG + _CLOSED,
        "stream_rolling_avg_90_1_lineitem": _with_changes(_LINEITEM, 90, 1) + _AVG + _CLOSED,
        "stream_rolling_avg_late_rows_events": _with_changes(_EVENTS_IN_TIME) + _AVG + _CLOSED,
        "stream_late_rows_events": _SPLIT.format(which=""),
        "stream_rolling_avg_in_time_events": _with_changes(_SPLIT.format(which="not")) + _AVG
        + f" where end_date <= (select max(date) - {_LATE_DAYS} from n)",
        "stream_rank_open_periods_events": _with_changes(_EVENTS) + """select * from (select start_date, end_date,
            country, avg, cast(dense_rank() over (partition by end_date order by avg desc nulls last) as integer)
            as rank from a) where rank <= 3""",
        "stream_csv_case_report_events": closed_averages,
        "stream_csv_counter_conversations": _INCREMENTS,
        "stream_csv_rejects_events": _REJECTS,
    }
