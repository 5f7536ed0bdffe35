from __future__ import annotations

import pytest
from conftest import day, days, rows

from tidegauge import (
    date_prefix,
    date_prefix_buckets,
    date_prefix_counts,
    read_date_prefix,
    write_date_prefixes,
)


@pytest.fixture
def table(series):
    # Dates come in no order, the third is crowded, and one record has none.
    data = [(d, "A", 1) for d in reversed(days("2021-01-01", 7, 3))]
    data += [("2021-01-07", "B", n) for n in range(10)] + [(None, "A", 5)]
    return series(data)


def test_prefix_keeps_the_first_dates(table):
    kept = rows(date_prefix(table, 3))
    assert len(kept) == 13
    assert {r[0] for r in kept} == {day(d) for d in days("2021-01-01", 3, 3)}
    assert len(rows(date_prefix(table, 100))) == 17


def test_buckets_hold_every_prefix(table):
    tagged = rows(date_prefix_buckets(table, 2))
    assert len(tagged) == 17
    for prefix in (1, 2, 3, 4):
        upto = [r[:3] for r in tagged if r[3] <= prefix]
        assert upto == rows(date_prefix(table, 2 * prefix))


def test_counts(table):
    counts = [(1, 2, 2, 2), (2, 2, 12, 14), (3, 2, 2, 16), (4, 1, 1, 17)]
    assert rows(date_prefix_counts(table, 2)) == counts


def test_written_prefixes_are_read_back(spark, table, tmp_path):
    write_date_prefixes(table, str(tmp_path / "sets"), step=2)
    for prefix in (1, 2, 4):
        found = read_date_prefix(spark, str(tmp_path / "sets"), prefix, table.schema)
        assert rows(found) == rows(date_prefix(table, 2 * prefix))


@pytest.mark.parametrize("count", [0, -1, 2.5, True])
def test_counts_are_checked(table, count):
    for operator in (date_prefix, date_prefix_buckets, date_prefix_counts):
        with pytest.raises(ValueError):
            operator(table, count)
