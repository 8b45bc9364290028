"""Queries over projections, filters and scalar expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom import schemas
from wattloom.functions import measures, periods
from wattloom.operators import compare, conform, display, publish, rollup
from wattloom.plans import bindings as b
from wattloom.plans.catalog import query
from wattloom.plans.oracle import HOUR_END, USAGE_DATE


@query(
    "project_consumption",
    "SELECT * EXCLUDE (ingest_date), electricity_kwh * 4.0::DOUBLE AS average_demand_kw FROM sparse",
    "sparse",
)
def project_consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.project_consumption(b.sparse_readings(spark, sf_dir))


@query("project_metadata", "SELECT * EXCLUDE (upgrade) FROM metadata", "metadata")
def project_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.project_metadata(b.building_metadata(spark, sf_dir))


@query(
    "filter_baseline",
    "SELECT building_id, upgrade, county_code FROM metadata WHERE upgrade = 0",
    "metadata",
)
def filter_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.baseline_only(b.building_metadata(spark, sf_dir)).select(
        F.col("bldg_id").alias("building_id"), "upgrade", F.col("`in.county`").alias("county_code")
    )


@query(
    "demand_kw",
    """SELECT building_id, source_timestamp, electricity_kwh * 4.0::DOUBLE AS quarter_hour_kw,
              electricity_kwh * 2.0::DOUBLE AS half_hour_kw FROM sparse""",
    "sparse",
)
def demand_kw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.project_consumption(b.sparse_readings(spark, sf_dir)).select(
        "building_id",
        "source_timestamp",
        measures.demand_kw("electricity_kwh").alias("quarter_hour_kw"),
        measures.demand_kw("electricity_kwh", interval_seconds=1800).alias("half_hour_kw"),
    )


@query(
    "celsius_to_f",
    """SELECT county_code, weather_timestamp, temperature_c,
              temperature_c * 9.0::DOUBLE / 5.0::DOUBLE + 32.0::DOUBLE AS temperature_f
       FROM weather""",
    "weather",
)
def celsius_to_f(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.weather_hourly(spark, sf_dir).select(
        "county_code",
        "weather_timestamp",
        "temperature_c",
        measures.celsius_to_fahrenheit("temperature_c").alias("temperature_f"),
    )


@query(
    "end_use_systems",
    """SELECT building_id, source_timestamp,
              cooling_kwh + cooling_fans_pumps_kwh AS cooling_system_kwh,
              heating_kwh + heating_backup_kwh + heating_fans_pumps_kwh AS heating_system_kwh
       FROM sparse""",
    "sparse",
)
def end_use_systems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.project_consumption(b.sparse_readings(spark, sf_dir)).select(
        "building_id",
        "source_timestamp",
        measures.total_of("cooling_kwh", "cooling_fans_pumps_kwh").alias("cooling_system_kwh"),
        measures.total_of(
            "heating_kwh", "heating_backup_kwh", "heating_fans_pumps_kwh"
        ).alias("heating_system_kwh"),
    )


@query(
    "hour_ending",
    f"SELECT event_id, ts, {HOUR_END.format(ts='ts')} AS hour_end FROM events",
)
def hour_ending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.table(spark, sf_dir, "events").select(
        "event_id", "ts", periods.hour_ending("ts").alias("hour_end")
    )


@query(
    "usage_date",
    f"""SELECT building_id, source_hour_end,
               {USAGE_DATE.format(ts='source_hour_end')} AS usage_date FROM sparse_hours""",
    "sparse_hours",
)
def usage_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.sparse_hours(spark, sf_dir).select(
        "building_id", "source_hour_end", periods.usage_date("source_hour_end").alias("usage_date")
    )


@query(
    "usage_month",
    """SELECT l_orderkey, l_linenumber, cast(date_trunc('month', l_shipdate) AS TIMESTAMP) AS usage_month
       FROM lineitem""",
)
def usage_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", periods.usage_month("l_shipdate").alias("usage_month")
    )


@query(
    "degree_days",
    """SELECT building_id, usage_date, average_temperature_f, cooling_degree_days_65,
              heating_degree_days_65,
              greatest(average_temperature_f - 50.0::DOUBLE, 0.0::DOUBLE) AS cooling_degree_days_50
       FROM daily_long""",
    "daily_long",
)
def degree_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = b.daily_long(spark, sf_dir).drop("cooling_degree_days_65", "heating_degree_days_65")
    return rollup.with_degree_days(days).select(
        "building_id",
        "usage_date",
        "average_temperature_f",
        "cooling_degree_days_65",
        "heating_degree_days_65",
        measures.cooling_degree_days("average_temperature_f", 50.0).alias("cooling_degree_days_50"),
    )


@query("account_id", "SELECT c_custkey AS building_id, 'DEMO-' || c_custkey AS account_id FROM customer")
def account_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = b.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("building_id"))
    return publish.with_account_id(customers)


@query("data_description", "SELECT account_id, data_description FROM summary", "summary")
def data_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.long_accounts(spark, sf_dir).select("account_id", "data_description")


def audited(spark: SparkSession, sf_dir: str, expected_rows: int) -> DataFrame:
    return rollup.ingest_audit(b.bronze_rows(spark, sf_dir), expected_rows)


@query(
    "audit_status",
    """SELECT user_id AS bldg_id, cast(ts AS DATE) AS ingest_date,
              CASE WHEN count(*) = 3 AND count(DISTINCT ts) = 3 AND sum(bad) = 0
                   THEN 'SUCCESS' ELSE 'REVIEW' END AS status
       FROM (SELECT *, CASE WHEN cast(json_extract_string(props, '$.k') AS INT) % 25 = 0
                            THEN 1 ELSE 0 END AS bad FROM events)
       GROUP BY ALL""",
)
def audit_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(spark, sf_dir, 3).select("bldg_id", "ingest_date", "status")


@query(
    "audit_timestamp",
    """SELECT DISTINCT user_id AS bldg_id, cast(ts AS DATE) AS ingest_date, true AS stamped_now
       FROM events""",
)
def audit_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    age = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("audit_timestamp")
    return audited(spark, sf_dir, 3).select(
        "bldg_id", "ingest_date", F.abs(age).between(0, 3600).alias("stamped_now")
    )


_CHANGES = ", ".join(f"{m} - previous_{m} AS {name}" for name, m in schemas.CHANGES.items())


@query("deltas", f"SELECT building_id, usage_month, {_CHANGES} FROM lagged", "lagged")
def deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = compare.with_previous(b.monthly_long(spark, sf_dir))
    return compare.deltas(pairs).select("building_id", "usage_month", *schemas.CHANGES)


@query(
    "daily_change_pct",
    "SELECT building_id, usage_month, daily_usage_change_pct FROM investigation_long",
    "investigation_long",
)
def daily_change_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.with_previous(b.monthly_long(spark, sf_dir)).select(
        "building_id", "usage_month", compare.daily_change_pct().alias("daily_usage_change_pct")
    )


@query(
    "cooling_share_pct",
    "SELECT building_id, usage_month, cooling_share_of_net_change_pct FROM investigation_long",
    "investigation_long",
)
def cooling_share_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = compare.with_previous(b.monthly_long(spark, sf_dir))
    return compare.deltas(pairs).select(
        "building_id",
        "usage_month",
        compare.cooling_share_pct().alias("cooling_share_of_net_change_pct"),
    )


@query(
    "residual_change",
    "SELECT building_id, usage_month, other_electricity_change_kwh FROM investigation_long",
    "investigation_long",
)
def residual_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = compare.with_previous(b.monthly_long(spark, sf_dir))
    return compare.deltas(pairs).select(
        "building_id", "usage_month", compare.residual_change().alias("other_electricity_change_kwh")
    )


@query(
    "period_keys",
    """SELECT building_id, usage_date, strftime(usage_date, '%Y-%m-%d') AS date_key,
              strftime(usage_date, '%Y-%m') AS month_key, strftime(usage_date, '%B %Y') AS month_label
       FROM daily_long""",
    "daily_long",
)
def period_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.daily_long(spark, sf_dir).select(
        "building_id",
        "usage_date",
        periods.date_key("usage_date").alias("date_key"),
        periods.month_key("usage_date").alias("month_key"),
        periods.month_label("usage_date").alias("month_label"),
    )


def _magnitude(x: str, decimals: int) -> str:
    half = 2 ** (decimals + 1)
    nudge = 10 ** -(decimals + 1)
    return (
        f"printf('%.{decimals}f', abs({x}) + "
        f"CASE WHEN (abs({x}) * {half}.0::DOUBLE) % 2.0::DOUBLE = 1.0::DOUBLE THEN {nudge}::DOUBLE "
        f"ELSE 0.0::DOUBLE END)"
    )


def _number(x: str, decimals: int = 2, unit: str = "") -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN 'Not available' ELSE "
        f"CASE WHEN {x} < 0 THEN '-' ELSE '' END || {_magnitude(x, decimals)} || '{unit}' END"
    )


def _signed(x: str, decimals: int = 2, unit: str = "") -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN 'Not available' ELSE "
        f"CASE WHEN {x} > 0 THEN '+' WHEN {x} < 0 THEN '−' ELSE '' END || "
        f"{_magnitude(x, decimals)} || '{unit}' END"
    )


@query(
    "format_measures",
    f"""SELECT building_id, strftime(usage_month, '%Y-%m') AS month_key,
          {_number('electricity_kwh', 2, ' kWh')} AS electricity,
          {_signed('electricity_change_kwh')} AS electricity_change,
          {_signed('daily_usage_change_pct', 2, '%')} AS daily_change,
          {_signed('cooling_share_of_net_change_pct', 2, '%')} AS cooling_share,
          {_number('other_electricity_change_kwh')} AS other_change,
          {_number('average_temperature_f', 1, ' °F')} AS temperature,
          {_signed('average_temperature_change_f', 1, ' °F')} AS temperature_change,
          {_number('cooling_degree_days_65', 1)} AS cooling_degree_days,
          {_signed('heating_degree_days_change_65', 1)} AS heating_degree_days_change
        FROM investigation_long""",
    "investigation_long",
)
def format_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return display.formatted_comparison(compare.investigation(b.monthly_long(spark, sf_dir)))


@query(
    "building_labels",
    """SELECT building_id, coalesce(building_type, 'Not available') AS building_type,
              CASE WHEN floor_area_sqft = 0 THEN 'Not available'
                   WHEN floor_area_sqft = trunc(floor_area_sqft)
                        THEN cast(floor_area_sqft AS BIGINT) || ' sq ft'
                   ELSE floor_area_sqft || ' sq ft' END AS floor_area,
              coalesce(nullif(construction_vintage, ''), 'Not available') AS construction_vintage,
              heating_fuel, heating_system, coalesce(cooling_system, 'Not available') AS cooling_system,
              state, county_code
       FROM summary""",
    "summary",
)
def building_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return display.building_labels(b.long_accounts(spark, sf_dir))
