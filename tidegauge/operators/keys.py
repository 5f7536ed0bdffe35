"""Arguments that name columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def key_names(key: str | Sequence[str]) -> list[str]:
    """Key columns are given as one name or several."""
    return [key] if isinstance(key, str) else list(key)


def check_dates(df: DataFrame, date: str) -> None:
    """Operators by day need a DATE: only that bounds the days of a key by the calendar."""
    kind = df.select(date).schema[0].dataType
    if not isinstance(kind, T.DateType):
        raise ValueError(f"{date} must be a DATE, not {kind.simpleString()}; cast it first")
