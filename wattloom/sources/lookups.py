"""Literal lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Weather station city of each supported county.
WEATHER_LOCATIONS = [
    ("G0101270", "Birmingham Muni"),
    ("G0101130", "Fort Benning"),
    ("G0100530", "Middleton Fld"),
]


def weather_locations(
    spark: SparkSession, rows: list[tuple[str, str]] | None = None
) -> DataFrame:
    """County to weather city; ``rows`` replaces the built-in counties."""
    return spark.createDataFrame(
        WEATHER_LOCATIONS if rows is None else rows, "county_code string, weather_city string"
    )
