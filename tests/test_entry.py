"""Every registered query against its SQL, and the entry point."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as roster

SF_DIR = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        connection.sql(f"create view {path.stem} as select * from read_parquet('{path}')")
    return connection


def counted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(
        tuple("nan" if isinstance(row[i], float) and math.isnan(row[i]) else row[i] for i in order)
        for row in rows
    )


# The corpus operators have tests of their own.
EXTRA = set() if roster.llm is None else {*roster.llm.queries(), "pipeline"}
CORE = [name for name in roster.queries() if name not in EXTRA]


def test_every_query_has_its_sql():
    assert set(CORE) == roster.oracle_sql().keys() - EXTRA


@pytest.mark.parametrize("name", CORE)
def test_query_equals_its_sql(spark, duck, name):
    df = roster.queries()[name](spark, str(SF_DIR))
    wanted = duck.sql(roster.oracle_sql()[name])
    assert sorted(df.columns) == sorted(wanted.columns)
    found = counted(df.columns, df.collect())
    assert found == counted(wanted.columns, wanted.fetchall())
    assert found.total() > 0 or name == "pct_change_zero_base_events"


def test_entry(spark):
    df = roster.entry(spark)
    assert df.columns[-1] == "rank"
    assert df.count() > 0
