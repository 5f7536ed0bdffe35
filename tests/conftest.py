from __future__ import annotations

import sys
from contextlib import contextmanager
from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tidegauge-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Set session settings for a block of code."""

    @contextmanager
    def using(**values):
        names = {name.replace("__", "."): value for name, value in values.items()}
        before = {name: spark.conf.get(name, None) for name in names}
        for name, value in names.items():
            spark.conf.set(name, value)
        try:
            yield
        finally:
            for name, value in before.items():
                if value is None:
                    spark.conf.unset(name)
                else:
                    spark.conf.set(name, value)

    return using


@pytest.fixture
def series(spark):
    """A series from ``(date, country, cases)`` rows."""

    def make(rows, cases="int"):
        return spark.createDataFrame(
            [(day(d), n, c) for d, c, n in rows], f"date date, cases {cases}, country string"
        )

    return make


def day(text):
    return None if text is None else date.fromisoformat(text)


def days(first, count, step=1):
    return [(day(first) + timedelta(days=step * i)).isoformat() for i in range(count)]


def rows(df):
    return sorted(
        (tuple(row) for row in df.collect()), key=lambda row: tuple((v is not None, v) for v in row)
    )


def final_plan(df):
    """The adaptive plan of a DataFrame after it ran."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
