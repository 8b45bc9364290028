"""Queries over joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattloom import schemas
from wattloom.functions.measures import WEATHER_DIGITS
from wattloom.operators import conform, requests, rollup
from wattloom.operators.upsert import stage
from wattloom.plans import bindings as b
from wattloom.plans.catalog import query
from wattloom.plans.oracle import NESTED_DAY, NESTED_MONTH

_DIMENSION = list(schemas.BUILDING_ATTRIBUTES)


@query(
    "arrived_entities",
    "SELECT DISTINCT user_id AS building_id FROM events",
)
def arrived_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.arrived_buildings(b.sparse_readings(spark, sf_dir))


@query(
    "join_metadata",
    f"SELECT {', '.join(_DIMENSION)} FROM candidates",
    "candidates",
)
def join_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.join_attributes(
        conform.arrived_buildings(b.sparse_readings(spark, sf_dir)),
        conform.building_attributes(b.building_metadata(spark, sf_dir)),
    )


@query(
    "join_weather_city",
    """SELECT m.building_id, m.county_code, l.weather_city FROM metadata m
       LEFT JOIN partial_locations l USING (county_code) WHERE m.upgrade = 0""",
    "metadata",
    "partial_locations",
)
def join_weather_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    attributes = conform.building_attributes(b.building_metadata(spark, sf_dir))
    return conform.join_weather_city(attributes, b.partial_locations(spark)).select(
        "building_id", "county_code", "weather_city"
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.onboarding_candidates(
        b.sparse_readings(spark, sf_dir), b.building_metadata(spark, sf_dir), b.partial_locations(spark)
    )


@query("onboard_buildings", "SELECT * FROM candidates", "candidates")
def onboard_buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates(spark, sf_dir)


@query(
    "unmapped_buildings",
    """SELECT building_id, state, county_code, weather_city FROM candidates
       WHERE state IS NULL OR county_code IS NULL OR weather_city IS NULL""",
    "candidates",
)
def unmapped_buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.unmapped_buildings(candidates(spark, sf_dir)).select(
        "building_id", *schemas.PLACE
    )


@query(
    "join_buildings",
    """SELECT h.building_id, h.source_hour_end, h.electricity_kwh, b.state, b.county_code, b.weather_city
       FROM sparse_hours h JOIN buildings b USING (building_id)""",
    "sparse_hours",
    "buildings",
)
def join_buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.join_buildings(b.sparse_hours(spark, sf_dir), b.buildings(spark, sf_dir)).select(
        "building_id", "source_hour_end", "electricity_kwh", *schemas.PLACE
    )


@query("join_weather", "SELECT * FROM enriched", "enriched")
def join_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.enriched_hours(spark, sf_dir)


@query(
    "unmatched_weather",
    """SELECT h.building_id, h.source_hour_end, b.county_code
       FROM sparse_hours h JOIN buildings b USING (building_id)
       WHERE NOT EXISTS (SELECT 1 FROM gappy_weather w WHERE w.county_code = b.county_code
                         AND w.weather_timestamp = h.source_hour_end)""",
    "sparse_hours",
    "buildings",
    "gappy_weather",
)
def unmatched_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = conform.join_buildings(b.sparse_hours(spark, sf_dir), b.buildings(spark, sf_dir))
    return conform.unmatched_weather(located, b.gappy_weather(spark, sf_dir)).select(
        "building_id", "source_hour_end", "county_code"
    )


@query("join_account_context", "SELECT * FROM accounts", "accounts")
def join_account_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.long_accounts(spark, sf_dir)


@query(
    "lookup_account",
    """SELECT p.request_id, p.account_id, a.building_id, a.building_id IS NOT NULL AS account_known
       FROM parsed p LEFT JOIN summary a ON p.account_id = a.account_id""",
    "parsed",
    "summary",
)
def lookup_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = stage(requests.parse(b.account_requests(spark, sf_dir)), "parsed-requests")
    return conform.lookup_accounts(parsed, b.long_accounts(spark, sf_dir)).select(
        "request_id", "account_id", "building_id", "account_known"
    )


@query(
    "nest_account_usage",
    f"""SELECT building_id, row_number() OVER (PARTITION BY building_id ORDER BY usage_date) AS place,
               {NESTED_DAY} FROM daily_long
        UNION ALL
        SELECT building_id, row_number() OVER (PARTITION BY building_id ORDER BY usage_month),
               {NESTED_MONTH} FROM monthly_long""",
    "monthly_long",
)
def nest_account_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every element of the nested arrays, with its place."""
    days = b.stored(b.daily_long, spark, sf_dir)
    nested = requests.nest_usage(days, rollup.monthly_rollup(days, 2, WEATHER_DIGITS))
    return b.nested_elements(nested, "building_id")
