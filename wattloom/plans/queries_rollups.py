"""Queries over aggregations and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom import schemas
from wattloom.functions.measures import ENERGY_DIGITS, WEATHER_DIGITS
from wattloom.operators import compare, conform, display, publish, rollup
from wattloom.operators.upsert import upsert
from wattloom.plans import bindings as b
from wattloom.plans.catalog import query
from wattloom.plans.queries_expressions import audited
from wattloom.session import scratch_dir

_BAD = "cast(json_extract_string(props, '$.k') AS INT) % 25 = 0"


@query(
    "ingest_audit",
    f"""SELECT user_id AS bldg_id, cast(ts AS DATE) AS ingest_date,
               'events.parquet' AS source_file_name, count(*) AS row_count,
               count(DISTINCT ts) AS distinct_timestamps,
               sum(CASE WHEN {_BAD} THEN 1 ELSE 0 END)::BIGINT AS rescued_rows,
               min(ts) AS first_timestamp, max(ts) AS last_timestamp,
               CASE WHEN count(*) = 3 AND count(DISTINCT ts) = 3
                         AND sum(CASE WHEN {_BAD} THEN 1 ELSE 0 END) = 0
                    THEN 'SUCCESS' ELSE 'REVIEW' END AS status
        FROM events GROUP BY ALL""",
)
def ingest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(spark, sf_dir, 3).drop(
        "source_file_path", "source_file_size", "audit_timestamp"
    )


@query(
    "conditional_count",
    f"""SELECT user_id AS bldg_id, sum(CASE WHEN {_BAD} THEN 1 ELSE 0 END)::BIGINT AS rescued_rows
        FROM events GROUP BY user_id""",
)
def conditional_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.bronze_rows(spark, sf_dir).groupBy("bldg_id").agg(
        rollup.rescued_count().alias("rescued_rows")
    )


@query("hourly_rollup", "SELECT * FROM dense_hours", "dense_hours")
def hourly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.dense_hours(spark, sf_dir)


@query("daily_rollup", "SELECT * FROM daily", "daily")
def daily_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.daily_rollup(b.enriched_hours(spark, sf_dir), ENERGY_DIGITS, WEATHER_DIGITS)


@query("monthly_rollup", "SELECT * FROM monthly_long", "monthly_long")
def monthly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.monthly_long(spark, sf_dir)


@query("account_metrics", "SELECT * FROM metrics", "metrics")
def account_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.account_metrics(b.daily_long(spark, sf_dir), digits=2)


@query("account_summary", "SELECT * FROM summary", "summary")
def account_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view of the catalog, over tables that an upsert has written."""
    days, buildings, view = map(b.new_table, ("days", "buildings", "account_summary"))
    root = scratch_dir(spark, "account-summary")
    daily = b.daily_long(spark, sf_dir).withColumn("part_month", F.trunc("usage_date", "month"))
    upsert(daily, days, ["building_id", "usage_date"], root, "part_month", keys_unique=True)
    upsert(b.supplier_buildings(spark, sf_dir), buildings, ["building_id"], root)
    publish.create_account_view(spark, view, days, buildings, digits=2)
    return spark.table(view)


@query(
    "duplicate_keys",
    """SELECT l_orderkey AS bldg_id, l_linenumber AS line, count(*) AS copies
       FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
)
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.duplicate_keys(b.invoice_keys(spark, sf_dir), ["bldg_id", "line"])


@query(
    "dedup_metadata",
    """SELECT o_custkey AS building_id, o_orderpriority AS construction_vintage,
              o_totalprice AS floor_area_sqft, cast(o_orderdate AS DATE) AS seen_on
       FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey
         ORDER BY o_orderpriority NULLS FIRST, o_totalprice NULLS FIRST, o_orderdate NULLS FIRST) = 1""",
)
def dedup_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.one_row_per_key(b.repeated_metadata(spark, sf_dir), ["building_id"])


@query(
    "list_periods",
    "SELECT DISTINCT building_id, strftime(usage_date, '%Y-%m') AS month FROM daily_long",
    "daily_long",
)
def list_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return display.list_periods(b.daily_long(spark, sf_dir), "usage_date")


_LAGS = ", ".join(["previous_month"] + [f"previous_{m}" for m in schemas.LAGGED])


@query("lag_periods", f"SELECT building_id, usage_month, {_LAGS} FROM lagged", "lagged")
def lag_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.with_previous(b.monthly_long(spark, sf_dir)).select(
        "building_id", "usage_month", "previous_month", *[f"previous_{m}" for m in schemas.LAGGED]
    )


@query("investigation", "SELECT * FROM investigation_long", "investigation_long")
def investigation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.investigation(b.monthly_long(spark, sf_dir))


@query(
    "reading_to_comparison",
    "SELECT * FROM investigation",
    "investigation",
)
def reading_to_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain in one plan: readings, hours, weather, days, months, comparison."""
    days = rollup.daily_rollup(b.enriched_hours(spark, sf_dir), ENERGY_DIGITS, WEATHER_DIGITS)
    return compare.investigation(rollup.monthly_rollup(days, ENERGY_DIGITS, WEATHER_DIGITS))


_PREFERRED = {1: "1996-05", 2: "1990-01", 5: "2000-12"}


@query(
    "default_period",
    """SELECT building_id,
              CASE WHEN building_id = 1 AND count(CASE WHEN month = '1996-05' THEN 1 END) > 0 THEN '1996-05'
                   WHEN building_id = 2 AND count(CASE WHEN month = '1990-01' THEN 1 END) > 0 THEN '1990-01'
                   WHEN building_id = 5 AND count(CASE WHEN month = '2000-12' THEN 1 END) > 0 THEN '2000-12'
                   ELSE coalesce(min(CASE WHEN n = 2 THEN month END), min(month)) END AS default_month
       FROM (SELECT *, row_number() OVER (PARTITION BY building_id ORDER BY month) AS n
             FROM (SELECT DISTINCT building_id, strftime(usage_date, '%Y-%m') AS month FROM daily_long))
       GROUP BY building_id""",
    "daily_long",
)
def default_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return display.default_period(b.daily_long(spark, sf_dir), "usage_date", _PREFERRED)


@query(
    "first_period_nulls",
    """SELECT building_id, usage_month, previous_month, electricity_change_kwh,
              daily_usage_change_pct, cooling_share_of_net_change_pct
       FROM investigation_long
       QUALIFY row_number() OVER (PARTITION BY building_id ORDER BY usage_month) = 1""",
    "investigation_long",
)
def first_period_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.first_periods(compare.investigation(b.monthly_long(spark, sf_dir))).select(
        "building_id",
        "usage_month",
        "previous_month",
        "electricity_change_kwh",
        "daily_usage_change_pct",
        "cooling_share_of_net_change_pct",
    )
