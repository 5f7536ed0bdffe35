from __future__ import annotations

import pytest
from conftest import day, days, rows

from tidegauge import percent_change, rolling_average, rolling_change

SCHEMA = "start_date date, end_date date, country string, avg double"


def averages(spark, values, country="Italy", first="2021-01-08"):
    ends = [day(d) for d in days(first, len(values))]
    return spark.createDataFrame(
        [(None, end, country, value) for end, value in zip(ends, values)], SCHEMA
    )


def changes(df):
    return [r[4] for r in rows(percent_change(df))]


def test_change_against_the_previous_window(spark):
    found = changes(averages(spark, [8.0, 10.0, 2.5, 2.5, 20.0]))
    assert found == [None, 25.0, -75.0, 0.0, 700.0]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_zero_base_gives_null(spark, settings, ansi):
    with settings(spark__sql__ansi__enabled=ansi):
        assert changes(averages(spark, [0.0, 5.0, 0.0, 0.0])) == [None, None, -100.0, None]


def test_null_is_kept_as_the_previous_value(spark):
    assert changes(averages(spark, [2.0, None, 4.0, 5.0])) == [None, None, None, 25.0]


def test_countries_are_compared_with_themselves(spark):
    both = averages(spark, [1.0, 2.0], "A").union(averages(spark, [10.0, 5.0], "B"))
    found = {(r[2], r[1]): r[4] for r in rows(percent_change(both))}
    assert found == {
        ("A", day("2021-01-08")): None,
        ("A", day("2021-01-09")): 100.0,
        ("B", day("2021-01-08")): None,
        ("B", day("2021-01-09")): -50.0,
    }


@pytest.mark.filterwarnings("ignore:slide_days")
@pytest.mark.parametrize(("window_days", "slide_days"), [(7, 1), (14, 7), (7, 2), (30, 1), (3, 3)])
def test_change_by_runs_equals_change_by_windows(series, window_days, slide_days):
    from test_rolling import random_rows

    df = series(random_rows(window_days, records=200))
    window = {"window_days": window_days, "slide_days": slide_days}
    assert rows(rolling_change(df, **window)) == rows(percent_change(rolling_average(df, **window)))
