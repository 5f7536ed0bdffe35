"""Late rows kept apart, and rankings of periods that are still open."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from conftest import rows

from tidegauge import (
    rank_within,
    read_rank_updates,
    read_split,
    rocksdb_state,
    rolling_average,
    start_rank_updates,
    start_split,
    start_table,
    stream_in_time,
    stream_rolling_average,
    stream_rolling_updates,
)
from tidegauge.streaming import sinks

FIRST = date(2021, 1, 1)
SCHEMA = "date date, cases int, country string"


@pytest.fixture
def feed(spark, tmp_path):
    class Feed:
        out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

        def add(self, *records):
            made = [(None if d is None else FIRST + timedelta(days=d), n, c) for d, n, c in records]
            df = spark.createDataFrame(made, SCHEMA)
            df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            self.schema = df.schema

        def stream(self):
            reader = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
            return reader.parquet(str(tmp_path / "in"))

        def split(self, late_days=0):
            start_split(self.stream(), self.out, self.checkpoint, late_days=late_days).awaitTermination()

        def parts(self):
            """(day, cases, country) in time and late."""
            both = [read_split(spark, self.out, self.schema, late) for late in (False, True)]
            return [
                sorted(((None if r.date is None else (r.date - FIRST).days, r.cases, r.country) for r in part.collect()), key=str)
                for part in both
            ]

    return Feed()


def test_every_row_goes_to_one_table(feed):
    feed.add((10, 1, "A"), (0, 2, "B"), (None, 3, "A"))
    feed.add((8, 4, "A"), (7, 5, None), (12, 6, "B"), (None, 7, None))
    feed.add((9, 8, "A"), (10, 9, "A"), (7, None, "A"), (7, None, "A"))
    feed.split(late_days=2)
    kept, late = feed.parts()
    assert kept == sorted([(10, 1, "A"), (0, 2, "B"), (None, 3, "A"), (8, 4, "A"), (12, 6, "B"), (None, 7, None), (10, 9, "A")], key=str)
    assert late == sorted([(7, 5, None), (9, 8, "A"), (7, None, "A"), (7, None, "A")], key=str)
    # The newest date outlasts a restart.
    feed.add((9, 1, "C"), (10, 1, "C"))
    feed.split(late_days=2)
    kept, late = feed.parts()
    assert (10, 1, "C") in kept
    assert (9, 1, "C") in late


def test_days_before_1970_and_triggers_without_dates(spark, feed):
    days = (date(1969, 12, 25) - FIRST).days
    feed.add((None, 1, "A"))
    feed.add((days, 1, "A"))
    feed.add((days - 1, 2, "A"), (days, 3, "A"))
    feed.split()
    assert feed.parts() == [sorted([(None, 1, "A"), (days, 1, "A"), (days, 3, "A")], key=str), [(days - 1, 2, "A")]]


def test_nothing_read_yet(spark, feed):
    feed.add()
    feed.split()
    assert feed.parts() == [[], []]


def test_a_replayed_batch_writes_nothing_twice(spark, feed, tmp_path):
    feed.add((5, 1, "A"), (4, 2, "A"))
    feed.add((3, 3, "A"))
    feed.split()
    before = feed.parts()
    # A new checkpoint runs the same two batches again.
    feed.checkpoint = str(tmp_path / "another")
    feed.split()
    assert feed.parts() == before


def test_names_of_partitions_are_refused(spark, feed):
    feed.add((1, 1, "A"))
    with pytest.raises(ValueError, match="_late"):
        start_split(feed.stream().withColumnRenamed("country", "_late"), feed.out, feed.checkpoint)


@pytest.mark.parametrize("late_days", [0, 4])
def test_no_row_in_time_is_dropped_further_on(spark, feed, tmp_path, late_days):
    pick = random.Random(3)
    for part in range(5):
        feed.add(*((pick.randrange(8 * part, 8 * part + 16), pick.randrange(9), pick.choice("AB")) for _ in range(30)))
        feed.split(late_days)
        averages = stream_rolling_average(stream_in_time(spark, feed.out, feed.schema), late_days=late_days)
        start_table(averages, str(tmp_path / "table"), str(tmp_path / "second")).awaitTermination()
    kept = read_split(spark, feed.out, feed.schema, late=False)
    assert read_split(spark, feed.out, feed.schema, late=True).count() > 0
    last = max(r.date for r in kept.collect()) - timedelta(days=late_days)
    found = spark.read.schema(averages.schema).parquet(str(tmp_path / "table"))
    assert rows(found) == rows(rolling_average(kept).where(f"end_date <= date '{last}'"))


def ranked(spark, feed, averages, limit, by="avg"):
    with rocksdb_state(spark):
        query = start_rank_updates(averages, feed.out, feed.checkpoint, by=by, limit=limit)
    query.awaitTermination()
    return read_rank_updates(spark, feed.out, averages.schema)


def test_ranks_of_open_periods_end_as_the_batch_result(spark, feed):
    pick = random.Random(4)
    batch = []
    for _ in range(4):
        # Negative records let leaders fall back; few values make ties.
        part = [(pick.randrange(12), pick.choice([-6, 0, 6]), pick.choice("ABCDEF")) for _ in range(25)]
        feed.add(*part)
        batch += [(FIRST + timedelta(days=d), n, c) for d, n, c in part]
        averages = stream_rolling_updates(feed.stream(), window_days=3)
        found = ranked(spark, feed, averages, 2)
        whole = rolling_average(spark.createDataFrame(batch, SCHEMA), window_days=3)
        assert rows(found) == rows(rank_within(whole, by="avg", limit=2, key="country"))


def test_only_periods_that_changed_are_ranked_again(spark, feed):
    feed.add((0, 3, "A"), (0, 6, "B"), (50, 3, "A"))
    averages = stream_rolling_updates(feed.stream(), window_days=3)
    ranked(spark, feed, averages, 1)
    feed.add((50, 9, "C"))
    found = ranked(spark, feed, averages, 1)
    again = spark.read.parquet(f"{feed.out}/rank/batch=1")
    assert {(r.end_date - FIRST).days for r in again.collect()} == {51, 52, 53}
    assert {(r.country, r.avg) for r in found.collect()} == {("B", 2.0), ("C", 3.0)}


def test_a_failed_ranking_is_made_again(spark, feed, monkeypatch):
    feed.add((0, 3, "A"), (0, 6, "B"))
    averages = stream_rolling_updates(feed.stream(), window_days=3)
    ranked(spark, feed, averages, 1)
    feed.add((0, 9, "A"))
    with monkeypatch.context() as patch:
        patch.setattr(sinks, "rank_within", lambda *a, **k: 1 / 0)
        with pytest.raises(Exception, match="division by zero"):
            ranked(spark, feed, averages, 1)
    # Readers still see the ranking before.
    old = read_rank_updates(spark, feed.out, averages.schema)
    assert {r.country for r in old.collect()} == {"B"}
    found = ranked(spark, feed, averages, 1)
    assert {(r.country, r.avg) for r in found.collect()} == {("A", 4.0)}
