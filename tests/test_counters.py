from __future__ import annotations

import pytest
from conftest import day, days, rows

from tidegauge import counter_to_increments

SCHEMA = "day int, country int, susceptible int, infected int, immune int"


def levels(spark, data):
    return spark.createDataFrame([(d, c, 0, n, 0) for d, c, n in data], SCHEMA)


def test_levels_become_increments(spark):
    df = levels(spark, [(0, 1, 3), (1, 1, 5), (2, 1, 5), (3, 1, 2), (0, 2, 4), (2, 2, 6)])
    result = counter_to_increments(df)
    assert [(f.name, f.dataType.simpleString()) for f in result.schema] == [
        ("date", "date"),
        ("cases", "int"),
        ("country", "string"),
    ]
    first = [day(d) for d in days("1970-01-01", 4)]
    assert rows(result) == sorted(
        [(first[0], 3, "1"), (first[1], 2, "1"), (first[2], 0, "1"), (first[3], -3, "1")]
        + [(first[0], 4, "2"), (first[2], 2, "2")]
    )


def test_anchor_is_a_parameter(spark):
    result = counter_to_increments(levels(spark, [(31, 1, 3)]), anchor="2020-01-01")
    assert rows(result) == [(day("2020-02-01"), 3, "1")]


def test_null_level_is_the_previous_level_of_the_next_row(spark):
    result = counter_to_increments(levels(spark, [(0, 1, 3), (1, 1, None), (2, 1, 5)]))
    assert [r[1] for r in rows(result)] == [3, None, None]


def test_repeated_days(spark):
    df = levels(spark, [(0, 1, 3), (1, 1, 9), (1, 1, 5), (2, 1, 10)])
    for result in (counter_to_increments(df), counter_to_increments(df, dedupe="max")):
        assert [r[1] for r in rows(result)] == [3, 6, 1]
    with pytest.raises(Exception, match="1 has several levels on 1970-01-02"):
        counter_to_increments(df, dedupe=None).collect()


def test_last_version_of_a_day(spark):
    df = spark.createDataFrame(
        [(0, "a", 3, 1), (1, "a", 9, 1), (1, "a", 5, 2)],
        "day int, country string, infected int, v int",
    )
    result = counter_to_increments(df, dedupe="last", version="v")
    assert [r[1] for r in rows(result)] == [3, 2]


def test_dedupe_argument_is_checked(spark):
    with pytest.raises(ValueError, match="dedupe"):
        counter_to_increments(levels(spark, []), dedupe="first")
    with pytest.raises(ValueError, match="version"):
        counter_to_increments(levels(spark, []), dedupe="last")
