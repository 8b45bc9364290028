"""Raw layer to conformed readings, building dimension and weather-enriched hours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom import schemas
from wattloom.functions import measures, periods
from wattloom.operators.skew import skewed_join


def quoted(name: str) -> str:
    """Back-quoted name, for columns that contain dots."""
    return f"`{name}`"


def project_consumption(bronze: DataFrame, interval_seconds: int = measures.READING_SECONDS) -> DataFrame:
    """Short names for the dotted source measures, plus the average demand."""
    short = [F.col(quoted(src)).alias(name) for name, src in schemas.READING_MEASURES.items()]
    total = quoted(schemas.READING_MEASURES["electricity_kwh"])
    return bronze.select(
        F.col("bldg_id").alias("building_id"),
        F.col("timestamp").alias("source_timestamp"),
        *short,
        measures.demand_kw(total, interval_seconds).alias("average_demand_kw"),
    )


def project_metadata(metadata: DataFrame) -> DataFrame:
    """Short names and declared types for the building attributes.

    Attributes arrive as text; one that is not a number where a number is due
    becomes null instead of failing the job.
    """
    return metadata.select(
        *[
            F.col(quoted(src)).try_cast(kind).alias(name)
            for name, (src, kind) in schemas.BUILDING_ATTRIBUTES.items()
        ]
    )


def baseline_only(metadata: DataFrame) -> DataFrame:
    """Keep the baseline scenario (``upgrade = 0``)."""
    return metadata.filter(F.col("upgrade") == 0)


def one_row_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """The smallest row of each key, comparing the other columns left to right.

    ``min`` of a struct is combined map-side, so even a key with very many copies
    sends one row per task through the shuffle. Nulls count as smallest.
    """
    rest = [quoted(c) for c in df.columns if c not in keys]
    packed = df.groupBy(*[quoted(k) for k in keys]).agg(F.min(F.struct(*rest)).alias("_row"))
    return packed.select(*[quoted(k) for k in keys], "_row.*").select(
        *[quoted(c) for c in df.columns]
    )


def building_attributes(metadata: DataFrame) -> DataFrame:
    """One baseline row of attributes per building."""
    return one_row_per_key(project_metadata(baseline_only(metadata)), ["building_id"])


def arrived_buildings(bronze: DataFrame) -> DataFrame:
    """Buildings present in the raw layer."""
    return bronze.select(F.col("bldg_id").alias("building_id")).distinct()


def join_attributes(buildings: DataFrame, attributes: DataFrame) -> DataFrame:
    """Attach attributes; a building without any keeps nulls. Both sides are keyed."""
    return buildings.join(attributes, "building_id", "left")


def join_weather_city(buildings: DataFrame, locations: DataFrame) -> DataFrame:
    """Attach the weather city of the county; unmapped counties keep null.

    Not hinted: Spark broadcasts the lookup if its size is under the threshold.
    """
    return buildings.join(locations, "county_code", "left")


def onboarding_candidates(bronze: DataFrame, metadata: DataFrame, locations: DataFrame) -> DataFrame:
    """Dimension rows for every building that has arrived."""
    return join_weather_city(
        join_attributes(arrived_buildings(bronze), building_attributes(metadata)), locations
    )


def unmapped_buildings(candidates: DataFrame) -> DataFrame:
    """Candidates that lack state, county or weather city."""
    missing = [F.col(name).isNull() for name in schemas.PLACE]
    return candidates.filter(missing[0] | missing[1] | missing[2])


def join_buildings(hourly: DataFrame, buildings: DataFrame) -> DataFrame:
    """Attach place columns to hourly rows.

    Not hinted: the dimension grows with the data, so Spark broadcasts it only
    when its measured size is under the threshold.
    """
    return hourly.join(buildings.select("building_id", *schemas.PLACE), "building_id")


def join_weather(located_hours: DataFrame, weather: DataFrame) -> DataFrame:
    """Attach the county's weather of the same hour and derive system totals.

    Many buildings share one (county, hour); AQE splits a county-hour that is too
    large for one task.
    """
    series = weather.withColumnRenamed("weather_timestamp", "source_hour_end")
    joined = located_hours.join(series, ["county_code", "source_hour_end"])
    derived = {
        "hour_end": F.col("source_hour_end"),
        "usage_date": periods.usage_date("source_hour_end"),
        "cooling_system_kwh": measures.total_of("cooling_kwh", "cooling_fans_pumps_kwh"),
        "heating_system_kwh": measures.total_of(
            "heating_kwh", "heating_backup_kwh", "heating_fans_pumps_kwh"
        ),
        "temperature_f": measures.celsius_to_fahrenheit("temperature_c"),
        "weather_source_file": F.col("source_file"),
    }
    layout = [
        "building_id", *schemas.PLACE, "hour_end", "usage_date", "interval_count",
        "electricity_kwh", "net_electricity_kwh",
        "cooling_kwh", "cooling_fans_pumps_kwh", "cooling_system_kwh",
        "heating_kwh", "heating_backup_kwh", "heating_fans_pumps_kwh", "heating_system_kwh",
        "hot_water_kwh", "peak_15min_average_kw",
        "temperature_c", "temperature_f", *schemas.WEATHER_MEASURES, "weather_source_file",
    ]
    return joined.select(*[derived.get(name, F.col(name)).alias(name) for name in layout])


def enrich_hours(hourly: DataFrame, buildings: DataFrame, weather: DataFrame) -> DataFrame:
    """Hourly rows with place and weather."""
    return join_weather(join_buildings(hourly, buildings), weather)


def unmatched_weather(located_hours: DataFrame, weather: DataFrame) -> DataFrame:
    """Hourly rows for which the county has no weather."""
    known = weather.select(
        "county_code", F.col("weather_timestamp").alias("source_hour_end")
    )
    return located_hours.join(known, ["county_code", "source_hour_end"], "left_anti")


def lookup_accounts(
    requests: DataFrame, accounts: DataFrame, hot: DataFrame | None = None
) -> DataFrame:
    """Attach the building of each request's account; unknown accounts are flagged.

    One account may attract a large share of the requests, and requests that name none
    share the null key: both are spread. ``hot``: the much-requested accounts, where they
    are known already.
    """
    keyed = accounts.select("account_id", "building_id")
    return skewed_join(requests, keyed, ["account_id"], "left", hot).withColumn(
        "account_known", F.col("building_id").isNotNull()
    )
