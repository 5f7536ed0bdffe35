from __future__ import annotations

import random
from datetime import date

import pyarrow as pa
import pytest
from conftest import day, final_plan, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegauge import rank_within
from tidegauge.operators import rank

SCHEMA = "end_date date, country string, avg_increase double"


def by_window_function(df, limit):
    order = Window.partitionBy("end_date").orderBy(F.desc_nulls_last("avg_increase"))
    return df.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= limit)


def test_ranks_of_three_rivers(spark):
    # (end, river, change, rank), worked by hand.
    data = [
        (day("1998-06-30"), "Elbe", 12.5, 2),
        (day("1998-06-30"), "Oder", 40.0, 1),
        (day("1998-06-30"), "Main", -3.0, 3),
        (day("1998-07-03"), "Elbe", None, 2),
        (day("1998-07-03"), "Oder", None, 2),
        (day("1998-07-03"), "Main", 7.25, 1),
    ]
    df = spark.createDataFrame([row[:3] for row in data], SCHEMA)
    key = lambda row: (row[0], row[1])
    ranked = [tuple(r) for r in rank_within(df, limit=3).collect()]
    assert sorted(ranked, key=key) == sorted(data, key=key)
    top = [tuple(r) for r in rank_within(df, limit=1).collect()]
    assert sorted(top, key=key) == sorted((r for r in data if r[3] <= 1), key=key)


def test_ties_share_a_rank_and_nulls_come_last(spark):
    values = [5.0, 5.0, 3.0, None, None]
    df = spark.createDataFrame(
        [(day("2021-01-08"), str(i), v) for i, v in enumerate(values)], SCHEMA
    )
    ranks = {r[1]: r[3] for r in rank_within(df, limit=10).collect()}
    assert ranks == {"0": 1, "1": 1, "2": 2, "3": 3, "4": 3}
    assert len(rank_within(df, limit=1).collect()) == 2
    assert rank_within(df, limit=0).collect() == []
    assert rank_within(df, limit=-3).collect() == []
    assert rank_within(df).schema["rank"].dataType.simpleString() == "int"


@pytest.mark.parametrize("limit", [1, 3, 10, 1000])
@pytest.mark.parametrize("key", [None, "country"])
@pytest.mark.parametrize("at_once", [0, rank.PERIOD_VALUES])
def test_equals_the_window_function_on_spread_data(spark, limit, key, at_once, monkeypatch):
    monkeypatch.setattr(rank, "PERIOD_VALUES", at_once)
    pick = random.Random(limit)
    data = [
        (
            None if pick.random() < 0.02 else day(f"2021-01-{pick.randrange(1, 9):02d}"),
            str(i),
            pick.choice([None, 0.0, -0.0, 1.5, float(pick.randrange(40)), pick.random()]),
        )
        for i in range(4000)
    ]
    df = spark.createDataFrame(data, SCHEMA).repartition(13, "country")
    for cells in (None, 1, 50):
        ranked = rank_within(df, limit=limit, key=key, cells=cells)
        assert rows(ranked) == rows(by_window_function(df, limit))


@pytest.mark.parametrize("kind", ["date", "timestamp", "int", "decimal(5,1)", "string", "boolean"])
def test_missing_period_is_a_period(spark, kind):
    df = spark.createDataFrame(
        [(None, "a", 1.0), (None, "b", 2.0), ("0", "c", 5.0), ("0", "d", 4.0)],
        "end_date string, country string, avg_increase double",
    )
    text = {"date": "1970-01-01", "timestamp": "1970-01-01"}.get(kind, "0")
    period = F.when(F.col("end_date").isNotNull(), F.lit(text)).cast(kind)
    df = df.withColumn("end_date", period)
    ranks = {r.country: r["rank"] for r in rank_within(df).collect()}
    assert ranks == {"a": 2, "b": 1, "c": 1, "d": 2}


def test_other_columns_and_names(spark):
    df = spark.createDataFrame(
        [(1, 9, "a"), (1, 7, "b"), (2, 7, "c")], "shard int, hits int, who string"
    )
    ranked = rank_within(df, period="shard", by="hits", limit=1, output="place")
    assert ranked.columns == ["shard", "hits", "who", "place"]
    assert rows(ranked) == [(1, 9, "a", 1), (2, 7, "c", 1)]


def test_period_of_one_tie_is_kept_whole(spark):
    df = spark.range(50_000, numPartitions=8).select(
        F.lit(day("2021-01-08")).alias("end_date"),
        F.col("id").cast("string").alias("country"),
        F.when(F.col("id") % 3 != 0, 0.0)
        .otherwise(-F.col("id").cast("double"))
        .alias("avg_increase"),
    )
    ranked = rank_within(df, limit=2)
    counts = dict(ranked.groupBy("rank").count().collect())
    assert counts == {1: 33_333, 2: 1} or counts == {1: 33_334, 2: 1}
    assert rows(ranked) == rows(by_window_function(df, 2))


@pytest.mark.parametrize("new", [1, 50])
@pytest.mark.parametrize("known", [5, 10_000])
@pytest.mark.parametrize("kind", ["double", "bigint"])
def test_a_task_drops_rows_that_are_surpassed(monkeypatch, new, known, kind):
    monkeypatch.setattr(rank, "NEW_VALUES", new)
    monkeypatch.setattr(rank, "KNOWN_VALUES", known)
    pick = random.Random(5)
    odd = [None, 0, 2**62, 2**62 + 1] if kind == "bigint" else [None, 0.0, -0.0, float("nan"), float("inf"), -float("inf")]
    periods = [None, *(date(2020, 1, day) for day in range(1, 4))]
    values = [pick.choice([*odd, *range(60)]) for _ in range(2000)]
    given = pa.table({"p": pa.array(pick.choices(periods, k=2000), pa.date32()),
                      "v": pa.array(values, pa.int64() if kind == "bigint" else pa.float64()), "n": range(2000)})
    kept = list(rank._best_of_task(0, 1, 3)(iter(given.to_batches(100))))
    assert sum(batch.num_rows for batch in kept) <= (2000 if known == 5 else 800)
    found = {row["n"] for row in pa.Table.from_batches(kept).to_pylist()}

    def place(value):
        return (value is not None, value != value, value if value == value and value is not None else 0)

    for period in periods:
        own = [(place(row["v"]), row["n"]) for row in given.to_pylist() if row["p"] == period]
        best = sorted({at for at, _ in own}, reverse=True)[:3]
        assert {n for at, n in own if at in best} <= found


def test_surpassed_rows_are_not_sorted(spark):
    df = spark.range(100_000).selectExpr("date_add(date'2020-01-01', cast(id % 4 as int)) as end_date", "id as country",
                                         "hash(id) * 1.0D as avg_increase")
    ranked = rank_within(df, limit=3, key="country")
    plan = final_plan(ranked)
    assert plan.index("Partial") < plan.index("MapInArrow")
    assert plan.count("MapInArrow") == 1 and "ReusedExchange" in plan
    assert ranked.count() == 12
