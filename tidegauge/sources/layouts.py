"""The two CSV layouts and the series they are normalised to."""

from __future__ import annotations

from enum import Enum

from pyspark.sql import types as T

# Column names, types and date pattern of the published files.
CASE_REPORT_DATE_FORMAT = "d/M/y"
CASE_REPORT_SCHEMA = T.StructType(
    [
        T.StructField("dateRep", T.DateType(), False),
        T.StructField("day", T.IntegerType(), False),
        T.StructField("month", T.IntegerType(), False),
        T.StructField("year", T.IntegerType(), False),
        T.StructField("cases", T.IntegerType(), False),
        T.StructField("deaths", T.IntegerType(), False),
        T.StructField("countriesAndTerritories", T.StringType(), False),
        T.StructField("geoId", T.StringType(), True),
        T.StructField("countryterritoryCode", T.StringType(), True),
        T.StructField("popData2019", T.IntegerType(), True),
        T.StructField("continentExp", T.StringType(), True),
        T.StructField(
            "Cumulative_number_for_14_days_of_COVID-19_cases_per_100000", T.IntegerType(), True
        ),
    ]
)

# Column names and types of the counter files.
COUNTER_SCHEMA = T.StructType(
    [
        T.StructField(name, T.IntegerType(), False)
        for name in ("day", "country", "susceptible", "infected", "immune")
    ]
)


class Layout(Enum):
    """Layout of a CSV report."""

    CASE_REPORT = "case_report"
    """One row per country and date with the new cases since the previous row."""

    COUNTER = "counter"
    """One row per country and day number with the current number of infected."""

    @classmethod
    def of(cls, name: str | Layout) -> Layout:
        """Look a layout up by name, whatever its case."""
        if isinstance(name, Layout):
            return name
        try:
            return cls(str(name).lower())
        except ValueError:
            known = ", ".join(layout.value for layout in cls)
            raise ValueError(f"CSV layout {name!r} is not supported; use one of: {known}") from None

    @property
    def schema(self) -> T.StructType:
        return CASE_REPORT_SCHEMA if self is Layout.CASE_REPORT else COUNTER_SCHEMA

    @property
    def read_options(self) -> dict[str, object]:
        options: dict[str, object] = {"header": True}
        if self is Layout.CASE_REPORT:
            options["dateFormat"] = CASE_REPORT_DATE_FORMAT
        return options
