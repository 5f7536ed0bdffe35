"""Mapping of a table onto the normalised series ``(date, cases, country)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalise(
    df: DataFrame,
    date: str | Column,
    cases: str | Column,
    country: str | Column,
) -> DataFrame:
    """Select and rename the three roles of a series; nothing else is read."""
    roles = {"date": (date, "date"), "cases": (cases, "int"), "country": (country, "string")}
    return df.select(
        *(
            (F.col(source) if isinstance(source, str) else source).cast(kind).alias(name)
            for name, (source, kind) in roles.items()
        )
    )
