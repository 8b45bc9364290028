"""Queries over data-quality gates: the violations each gate reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.functions.measures import ENERGY_DIGITS, WEATHER_DIGITS
from wattloom.operators import compare, conform, gates, publish, rollup
from wattloom.operators.upsert import stage
from wattloom.plans import bindings as b
from wattloom.plans import medallion
from wattloom.plans.catalog import query
from wattloom.plans.queries_joins import candidates
from wattloom.plans.queries_sources import long_layers, published
from wattloom.session import scratch_dir


@query(
    "gate_rescued",
    """SELECT user_id AS bldg_id, ts AS timestamp, '{"unit":"MWh"}' AS _rescued_data FROM events
       WHERE cast(json_extract_string(props, '$.k') AS INT) % 25 = 0""",
)
def gate_rescued(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.rescued(b.bronze_rows(spark, sf_dir)).violations.select(
        "bldg_id", "timestamp", "_rescued_data"
    )


@query(
    "gate_duplicates",
    """SELECT l_orderkey AS bldg_id, l_linenumber AS line, count(*) AS copies
       FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
)
def gate_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.duplicates(b.invoice_keys(spark, sf_dir), ["bldg_id", "line"]).violations


@query(
    "gate_hour_complete",
    """SELECT building_id, source_hour_end, interval_count FROM sparse_hours WHERE interval_count <> 4""",
    "sparse_hours",
)
def gate_hour_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.hours_complete(b.sparse_hours(spark, sf_dir)).violations.select(
        "building_id", "source_hour_end", "interval_count"
    )


@query(
    "gate_day_complete",
    "SELECT building_id, usage_date, hours_present FROM daily_sparse WHERE hours_present <> 24",
    "daily_sparse",
)
def gate_day_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    enriched = conform.enrich_hours(
        b.sparse_hours(spark, sf_dir), b.buildings(spark, sf_dir), b.weather_hourly(spark, sf_dir)
    )
    return gates.days_complete(rollup.daily_rollup(enriched, ENERGY_DIGITS, WEATHER_DIGITS)).violations.select(
        "building_id", "usage_date", "hours_present"
    )


@query(
    "gate_weather_complete",
    """SELECT b.county_code, h.source_hour_end, count(*) AS rows, 'hour without weather' AS problem
       FROM sparse_hours h JOIN buildings b USING (building_id)
       WHERE NOT EXISTS (SELECT 1 FROM gappy_weather w WHERE w.county_code = b.county_code
                         AND w.weather_timestamp = h.source_hour_end)
       GROUP BY ALL
       UNION ALL
       SELECT county_code, weather_timestamp, count(*), 'repeated weather stamp'
       FROM gappy_weather GROUP BY ALL HAVING count(*) > 1""",
    "sparse_hours",
    "buildings",
    "gappy_weather",
)
def gate_weather_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = conform.join_buildings(b.sparse_hours(spark, sf_dir), b.buildings(spark, sf_dir))
    return gates.weather_complete(located, b.gappy_weather(spark, sf_dir)).violations


@query(
    "gate_onboarding",
    """SELECT building_id, county_code FROM candidates
       WHERE state IS NULL OR county_code IS NULL OR weather_city IS NULL""",
    "candidates",
)
def gate_onboarding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.onboarding(candidates(spark, sf_dir)).violations.select(
        "building_id", "county_code"
    )


def built_layers(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All layers of the metered buildings, built by the gated flow."""
    tables = medallion.Tables(scratch_dir(spark, "layers"))
    bronze = b.stored(_clean_bronze, spark, sf_dir)
    weather = b.stored(b.weather_hourly, spark, sf_dir)
    medallion.refresh_buildings(
        tables, bronze, b.building_metadata(spark, sf_dir), b.locations(spark, sf_dir)
    )
    medallion.refresh_silver(tables, bronze, weather)
    medallion.refresh_gold(tables, spark)
    return medallion.layers(tables, spark, bronze)


def _clean_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.meter_15min(spark, sf_dir).withColumn("_rescued_data", F.lit(None).cast("string"))


_LAYERS = {
    "bronze": "SELECT count(*) FROM dense",
    "silver_15min": "SELECT count(*) FROM dense",
    "silver_hourly": "SELECT count(*) FROM dense_hours",
    "silver_buildings": "SELECT count(*) FROM buildings",
    "gold_daily": "SELECT count(*) FROM daily",
    "gold_monthly": "SELECT count(*) FROM monthly",
    "gold_investigation": "SELECT count(*) FROM monthly",
    "gold_accounts": "SELECT count(DISTINCT building_id) FROM daily",
}
_COUNTS = " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, ({sql}) AS rows" for layer, sql in _LAYERS.items()
)


@query("layer_counts", _COUNTS, "monthly")
def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.layer_counts(built_layers(spark, sf_dir))


# Rows per building of the bound month: 30 days, of which the comparison layers see one month.
_MONTH_EXPECTATION = {
    "bronze": 2_880,
    "silver_15min": 2_880,
    "silver_hourly": 720,
    "silver_buildings": 1,
    "gold_daily": 30,
    "gold_monthly": 1,
    "gold_investigation": 1,
    "gold_accounts": 1,
}
_EXPECTED = " ".join(f"WHEN '{layer}' THEN {n}" for layer, n in _MONTH_EXPECTATION.items())


@query(
    "gate_layer_counts",
    f"""SELECT layer, actual_rows, expected_rows,
               CASE WHEN actual_rows = expected_rows THEN 'PASS' ELSE 'FAIL' END AS status
        FROM (SELECT layer, rows AS actual_rows,
                     (CASE layer {_EXPECTED} END
                      * (SELECT count(DISTINCT user_id) FROM events))::BIGINT AS expected_rows
              FROM ({_COUNTS}))""",
    "monthly",
)
def gate_layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = built_layers(spark, sf_dir)
    arrived = conform.arrived_buildings(layers["bronze"])
    return gates.layer_check(rollup.layer_counts(layers), arrived, _MONTH_EXPECTATION)


@query(
    "gate_snapshot_counts",
    """SELECT layer, rows AS actual_rows, rows AS expected_rows, 'PASS' AS status FROM (
         SELECT 'accounts' AS layer, count(*) AS rows FROM summary
         UNION ALL SELECT 'daily_usage', count(*) FROM daily_long
         UNION ALL SELECT 'monthly_usage', count(*) FROM monthly_long
         UNION ALL SELECT 'investigations', count(*) FROM monthly_long)""",
    "summary",
    "monthly_long",
)
def gate_snapshot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = long_layers(spark, sf_dir)
    snapshot = publish.read_snapshot(spark, published(spark, sf_dir, expected))
    stored = {name: snapshot[name] for name in expected}
    return gates.same_counts(rollup.layer_counts(stored), rollup.layer_counts(expected))


@query(
    "gate_snapshot_current",
    """SELECT o_orderkey AS request_id, CASE o_orderkey % 10 WHEN 2 THEN 's0' ELSE 's1' END AS snapshot_id,
              CASE o_orderkey % 10 WHEN 0 THEN '2024-01-01T00:00:00+00:00'
                                   WHEN 2 THEN '2024-02-01T00:00:00+00:00' END AS created_at_utc,
              CASE WHEN o_orderkey % 10 <> 2 THEN '2024-02-01T00:00:00+00:00' END AS published_at_utc
       FROM orders WHERE o_orderkey % 10 IN (0, 1, 2)""",
)
def gate_snapshot_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers with an older stamp, with none, or from a snapshot no longer there."""
    key = F.col("request_id") % 10
    served = b.account_requests(spark, sf_dir).select(
        "request_id",
        F.when(key == 2, F.lit("s0")).otherwise(F.lit("s1")).alias("snapshot_id"),
        F.when(key == 0, F.lit("2024-01-01T00:00:00+00:00"))
        .when(key > 1, F.lit("2024-02-01T00:00:00+00:00"))
        .alias("created_at_utc"),
    )
    described = publish.snapshot_metadata(
        spark,
        "s1",
        b.table(spark, sf_dir, "events").filter(F.col("ts").isNull()),
        "2024-02-01T00:00:00+00:00",
    )
    return gates.not_current(served, stage(described, "snapshot-metadata")).violations


@query(
    "compare_tolerance",
    """SELECT building_id, usage_month, unnest(['electricity_kwh', 'average_temperature_f']) AS measure,
              unnest([electricity_kwh, average_temperature_f]) AS actual, unnest([e_kwh, e_temperature]) AS expected,
              unnest([CASE WHEN electricity_kwh IS NULL OR e_kwh IS NULL THEN electricity_kwh IS NULL AND e_kwh IS NULL
                           ELSE abs(electricity_kwh - e_kwh) <= 0.001::DOUBLE END,
                      CASE WHEN average_temperature_f IS NULL OR e_temperature IS NULL
                           THEN average_temperature_f IS NULL AND e_temperature IS NULL
                           ELSE abs(average_temperature_f - e_temperature) <= 0.25::DOUBLE END]) AS within
       FROM (SELECT *,
                    CASE WHEN building_id % 4 = 0 THEN electricity_kwh + 0.5::DOUBLE
                         WHEN building_id % 4 <> 1 THEN electricity_kwh END AS e_kwh,
                    average_temperature_f + (days_present % 3)::DOUBLE / 8.0::DOUBLE AS e_temperature
             FROM monthly_long)""",
    "monthly_long",
)
def compare_tolerance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months against expectations that agree, lie outside, or are missing."""
    months = b.stored(b.monthly_long, spark, sf_dir)
    kwh, kind = F.col("electricity_kwh"), F.col("building_id") % 4
    expected = months.withColumns(
        {
            "electricity_kwh": F.when(kind == 0, kwh + F.lit(0.5)).when(kind != 1, kwh),
            "average_temperature_f": F.col("average_temperature_f")
            + (F.col("days_present") % 3).cast("double") / F.lit(8.0),
        }
    )
    return gates.compare_tolerance(
        months, expected, ["building_id", "usage_month"], {"electricity_kwh": 0.001, "average_temperature_f": 0.25}
    )
