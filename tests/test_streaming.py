from __future__ import annotations

import os
import time
from contextlib import contextmanager

import pytest
from conftest import day, days, rows
from test_sources import CASE_HEADER, COUNTER_HEADER, write

from tidegauge import (
    percent_change,
    rank_within,
    read_replaced,
    read_series,
    rocksdb_state,
    rolling_average,
    start_rank,
    start_replace,
    start_table,
    stream_percent_change,
    stream_rolling_average,
    stream_series,
)

ZONES = ("UTC", "Europe/Rome", "America/New_York")


def case_lines(when, countries=("Italy", "Spain", "Germany")):
    year, month, date = when.split("-")
    serial = day(when).toordinal()
    return [
        f"{date}/{month}/{year},,,,{serial * (k + 3) % 7 - 1},0,{country},,,,,"
        for k, country in enumerate(countries)
    ]


class Feed:
    """A folder that files are dropped into, and the batch view of it."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, folder / "in"
        self.folder.mkdir()
        self.out, self.checkpoint = str(folder / "out"), str(folder / "checkpoint")
        self.files, self.started = 0, time.time() - 3600

    def drop(self, header, *lines):
        # The file source takes files in order of their modification time.
        self.files += 1
        path = write(self.folder, f"{self.files:04d}.csv", header, *lines)
        os.utime(path, (self.started + self.files,) * 2)

    def drop_days(self, dates):
        for when in dates:
            self.drop(CASE_HEADER, *case_lines(when))

    def stream(self, layout="case_report", files=1, **options):
        return stream_series(
            self.spark, str(self.folder), layout, max_files_per_trigger=files, **options
        )

    def batch(self, layout="case_report"):
        return read_series(self.spark, str(self.folder), layout)

    def finish(self, query):
        query.awaitTermination(120)
        assert not query.isActive and query.exception() is None

    def table(self, schema):
        return self.spark.read.schema(schema).parquet(self.out)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


@pytest.fixture
def zone(settings):
    @contextmanager
    def using(name):
        with settings(spark__sql__session__timeZone=name):
            yield

    return using


def closed(df, last):
    return df.where(f"end_date <= date '{last}'")


@pytest.mark.parametrize("name", ZONES)
def test_complete_mode_equals_batch(feed, zone, name):
    with zone(name):
        feed.drop_days(days("2021-01-01", 4))
        averages = stream_rolling_average(feed.stream(files=2), complete=True)
        feed.finish(start_replace(averages, feed.out, feed.checkpoint))
        found = read_replaced(feed.spark, feed.out, averages.schema)
        assert rows(found) == rows(rolling_average(feed.batch()))


@pytest.mark.filterwarnings("ignore:slide_days")
@pytest.mark.parametrize(("window_days", "slide_days"), [(7, 1), (6, 3), (7, 7), (7, 2)])
def test_closed_windows_equal_batch(feed, window_days, slide_days):
    feed.drop_days(days("2037-12-20", 30))
    window = {"window_days": window_days, "slide_days": slide_days}
    averages = stream_rolling_average(feed.stream(files=10), **window)
    feed.finish(start_table(averages, feed.out, feed.checkpoint))
    expected = closed(rolling_average(feed.batch(), **window), "2038-01-18")
    found = rows(feed.table(averages.schema))
    assert found and found == rows(expected)


@pytest.mark.parametrize("name", ZONES)
def test_change_equals_batch_and_survives_a_restart(spark, feed, zone, name):
    with zone(name):
        for first in ("2021-01-01", "2021-01-09", "2021-02-01"):
            feed.drop_days(days(first, 3))
            changes = stream_percent_change(stream_rolling_average(feed.stream(files=2)))
            with rocksdb_state(spark):
                query = start_table(changes, feed.out, feed.checkpoint)
            feed.finish(query)
        expected = closed(percent_change(rolling_average(feed.batch())), "2021-02-03")
        assert rows(feed.table(changes.schema)) == rows(expected)


def test_null_average_is_kept_as_previous(spark, feed):
    lines = {"2021-01-01": "4", "2021-01-02": "", "2021-01-03": "6", "2021-01-04": "9"}
    for when, cases in lines.items():
        year, month, date = when.split("-")
        feed.drop(CASE_HEADER, f"{date}/{month}/{year},,,,{cases},0,Italy,,,,,")
    averages = stream_rolling_average(feed.stream(), window_days=1)
    changes = stream_percent_change(averages)
    with rocksdb_state(spark):
        query = start_table(changes, feed.out, feed.checkpoint)
    feed.finish(query)
    assert [r[4] for r in rows(feed.table(changes.schema))] == [None, None, None]


def test_late_record_is_dropped(feed):
    feed.drop_days(days("2021-01-01", 20))
    feed.finish(
        start_table(stream_rolling_average(feed.stream()), feed.out, feed.checkpoint)
    )
    before = closed(rolling_average(feed.batch()), "2021-01-20")
    expected = rows(before)
    feed.drop(CASE_HEADER, *case_lines("2021-01-02"))
    averages = stream_rolling_average(feed.stream())
    feed.finish(start_table(averages, feed.out, feed.checkpoint))
    assert rows(feed.table(averages.schema)) == expected
    assert rows(closed(rolling_average(feed.batch()), "2021-01-20")) != expected


def test_record_within_the_delay_is_counted(feed):
    feed.drop_days(days("2021-01-01", 10))
    feed.drop(CASE_HEADER, *case_lines("2021-01-08"))
    averages = stream_rolling_average(feed.stream(), late_days=5)
    feed.finish(start_table(averages, feed.out, feed.checkpoint))
    expected = closed(rolling_average(feed.batch()), "2021-01-05")
    assert rows(feed.table(averages.schema)) == rows(expected)


def test_rank_equals_batch_and_can_be_replayed(spark, feed):
    feed.drop_days(days("2021-01-01", 12))
    changes = stream_percent_change(stream_rolling_average(feed.stream(files=4)))

    def run(checkpoint):
        with rocksdb_state(spark):
            query = start_rank(changes, feed.out, checkpoint, limit=2)
        feed.finish(query)

    batch = rank_within(percent_change(rolling_average(feed.batch())), limit=2)
    expected = rows(closed(batch, "2021-01-12"))
    # Running every micro-batch once more writes the same folders again.
    for checkpoint in (feed.checkpoint, f"{feed.checkpoint}-again"):
        run(checkpoint)
        assert rows(feed.table(batch.schema).select(*batch.columns)) == expected


def counter_table(feed, **options):
    """The counter files read as a stream, one in a trigger, and stored."""
    increments = feed.stream("counter", **options)
    with rocksdb_state(feed.spark):
        query = start_table(increments, feed.out, feed.checkpoint)
    feed.finish(query)
    return feed.table(increments.schema).drop("event_time")


@pytest.mark.parametrize("name", ZONES)
def test_counter_stream_equals_batch_and_survives_a_restart(feed, zone, name):
    with zone(name):
        for first in (0, 4):
            for n in range(first, first + 4):
                lines = [f"{n},{c},0,{'' if n == 2 and c == 1 else n * c * 5 % 11},0" for c in (1, 2)]
                feed.drop(COUNTER_HEADER, *lines)
            found = counter_table(feed, files=3)
        assert rows(found) == rows(feed.batch("counter"))


def test_counter_days_may_come_late(feed):
    levels = {0: 3, 1: 5, 2: 9, 3: 4, 4: 4, 5: 10}
    for n in (0, 2, 1, 4, 3, 5):
        feed.drop(COUNTER_HEADER, f"{n},7,0,{levels[n]},0")
    found = counter_table(feed, files=1, late_days=2)
    assert rows(found) == [(day(f"1970-01-0{n + 1}"), c, "7") for n, c in enumerate((3, 2, 4, -5))]
    # The rest comes once later days are seen, over a restart; a row of a closed day does not.
    for n, level in ((6, 11), (8, 13), (7, 12), (0, 99), (9, 13), (10, 15)):
        feed.drop(COUNTER_HEADER, f"{n},7,0,{level},0")
    found = counter_table(feed, files=1, late_days=2)
    assert [r[1] for r in rows(found)] == [3, 2, 4, -5, 0, 6, 1, 1, 1]


def test_counter_days_that_come_twice(feed):
    for line in ("0,7,0,3,0", "1,7,0,9,1", "1,7,0,5,2", "2,7,0,6,1"):
        feed.drop(COUNTER_HEADER, line)
    found = counter_table(feed, files=4)
    assert [r[1] for r in rows(found)] == [3, 6, -3]
    feed.out, feed.checkpoint = f"{feed.out}-last", f"{feed.checkpoint}-last"
    found = counter_table(feed, files=4, dedupe="last", version="immune")
    assert [r[1] for r in rows(found)] == [3, 2, 1]
    feed.out, feed.checkpoint = f"{feed.out}-none", f"{feed.checkpoint}-none"
    with pytest.raises(Exception, match="7 has several levels on 1970-01-02"):
        counter_table(feed, files=4, dedupe=None)


def test_counter_stream_feeds_the_averages(feed):
    for n in range(12):
        feed.drop(COUNTER_HEADER, *(f"{n},{c},0,{n * c * 5 % 11},0" for c in (1, 2)))
    averages = stream_rolling_average(feed.stream("counter", files=12))
    with rocksdb_state(feed.spark):
        query = start_table(averages, feed.out, feed.checkpoint)
    feed.finish(query)
    expected = closed(rolling_average(feed.batch("counter")), "1970-01-12")
    assert rows(feed.table(averages.schema)) == rows(expected)
    with pytest.raises(ValueError, match="already has a watermark"):
        stream_rolling_average(feed.stream("counter"), late_days=1)


@pytest.mark.filterwarnings("ignore:slide_days")
@pytest.mark.parametrize(("window_days", "slide_days"), [(7, 1), (10, 5), (7, 2)])
def test_dates_before_1970(feed, window_days, slide_days):
    feed.drop_days(days("1969-12-01", 60))
    window = {"window_days": window_days, "slide_days": slide_days}
    averages = stream_rolling_average(feed.stream(files=60), **window)
    feed.finish(start_table(averages, feed.out, feed.checkpoint))
    found = rows(feed.table(averages.schema))
    assert found == rows(closed(rolling_average(feed.batch(), **window), "1970-01-29"))
    assert found[0][1] < day("1970-01-01") < found[-1][1]


def test_days_are_summed_before_they_are_copied_into_windows(feed):
    feed.drop_days(days("2021-01-01", 3))
    query = start_table(stream_rolling_average(feed.stream(), window_days=90), feed.out, feed.checkpoint)
    feed.finish(query)
    plan = query._jsq.streamingQuery().lastExecution().executedPlan().toString()
    expand = plan.index("Expand")
    # Plans are printed from the result down: below the copies, sums by key and day.
    assert plan.count("StateStoreSave") == 2 and "StateStoreSave" in plan[expand:]


def test_a_row_out_of_order_ends_the_change_stream(spark, feed):
    for when in ("2021-01-05", "2021-01-02"):
        feed.drop_days([when])
    series = feed.stream(files=1).withColumnsRenamed({"date": "end_date", "cases": "avg"})
    changes = stream_percent_change(series)
    with rocksdb_state(spark):
        query = start_table(changes, feed.out, feed.checkpoint)
    with pytest.raises(Exception, match="2021-01-02 came after 2021-01-05"):
        query.awaitTermination(120)


def test_state_store_setting_is_put_back(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    with pytest.raises(RuntimeError):
        with rocksdb_state(spark):
            assert spark.conf.get(name).endswith("RocksDBStateStoreProvider")
            raise RuntimeError
    assert spark.conf.get(name) == before
