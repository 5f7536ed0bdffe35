"""Daily increments of a running level."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Day 0 of the counter layout (fixed value).
COUNTER_ANCHOR = "1970-01-01"


def counter_to_increments(
    df: DataFrame,
    key: str = "country",
    day: str = "day",
    level: str = "infected",
    anchor: str = COUNTER_ANCHOR,
    *,
    dedupe: str | None = "max",
    version: str | None = None,
) -> DataFrame:
    """Turn levels per day number into the series ``(date, cases, country)``.

    Each day's level becomes its difference to that of the day before it of its key; the
    first level counts whole. Levels may fall, so increments may be negative.

    A key has one level a day. Of several rows of a day, ``dedupe="max"`` keeps the
    highest level and ``dedupe="last"`` the one with the greatest ``version``; both reduce
    the rows before they are shuffled by key, so a key has no more rows than days there.
    ``dedupe=None`` saves that step where days are known to be unique; a day with several
    rows then ends the query.

    The result is hash-partitioned by ``country``.
    """
    check_dedupe(dedupe, version)
    levels = df.select(
        F.date_add(F.lit(anchor).cast("date"), F.col(day)).alias("date"),
        F.col(key).cast("string").alias("country"),
        F.col(level).alias("_level"),
        *([F.col(version).alias("_version")] if dedupe == "last" else []),
    )
    if dedupe is not None:
        kept = F.max("_level") if dedupe == "max" else F.max_by("_level", "_version")
        levels = levels.groupBy("country", "date").agg(kept.alias("_level"))
        # One shuffle by key; the totals above were shuffled by key and day.
    in_order = Window.partitionBy("country").orderBy("date")
    increment = F.col("_level") - F.lag("_level", 1, 0).over(in_order)
    if dedupe is None:
        twice = F.lag("date").over(in_order) == F.col("date")
        refused = F.raise_error(F.concat(F.col("country"), F.lit(" has several levels on "), F.col("date")))
        increment = F.when(twice, refused.cast(df.schema[level].dataType)).otherwise(increment)
    return levels.select("date", increment.alias("cases"), "country")


def check_dedupe(dedupe: str | None, version: str | None) -> None:
    if dedupe not in (None, "max", "last"):
        raise ValueError(f"dedupe must be None, 'max' or 'last', got {dedupe!r}")
    if dedupe == "last" and version is None:
        raise ValueError("dedupe='last' needs a version column to order the rows of a day")
