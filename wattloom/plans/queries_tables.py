"""Queries over ordering, upserts, reshaping and report series."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom import schemas
from wattloom.functions.measures import ENERGY_DIGITS
from wattloom.operators import compare, conform, display, gates, publish, rollup, upsert
from wattloom.plans import bindings as b
from wattloom.plans.catalog import query
from wattloom.plans.oracle import MEASURES
from wattloom.session import scratch_dir
from wattloom.streaming import ingest as streaming


@query(
    "ordered_listing",
    "SELECT building_id, account_id, days_present FROM summary ORDER BY building_id",
    "summary",
)
def ordered_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    accounts = b.long_accounts(spark, sf_dir).select("building_id", "account_id", "days_present")
    return publish.ordered_listing(accounts, "building_id")


@query(
    "exists_probe",
    """SELECT 'repeated invoice lines' AS probe,
              (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber
                                     HAVING count(*) > 1)) > 0 AS found
       UNION ALL SELECT 'repeated orders',
              (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)) > 0
       UNION ALL SELECT 'negative readings', (SELECT count(*) FROM events WHERE value < 0) > 0""",
)
def exists_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    probes = {
        "repeated invoice lines": rollup.duplicate_keys(
            b.invoice_keys(spark, sf_dir), ["bldg_id", "line"]
        ),
        "repeated orders": rollup.duplicate_keys(b.table(spark, sf_dir, "orders"), ["o_orderkey"]),
        "negative readings": b.table(spark, sf_dir, "events").filter(F.col("value") < 0),
    }
    return gates.probe_report(probes)


@query(
    "monthly_series",
    """SELECT building_id, strftime(usage_month, '%Y-%m') AS month_key,
              strftime(usage_month, '%B %Y') AS month, electricity_kwh FROM monthly_long""",
    "monthly_long",
)
def monthly_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return display.monthly_series(b.monthly_long(spark, sf_dir))


@query(
    "daily_series",
    """SELECT building_id, strftime(usage_date, '%Y-%m-%d') AS date, electricity_kwh
       FROM daily_long WHERE strftime(usage_date, '%Y-%m') = '1997-02'""",
    "daily_long",
)
def daily_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return display.daily_series(b.daily_long(spark, sf_dir), "1997-02")


@query(
    "upsert_one_key",
    """SELECT building_id,
              CASE WHEN building_id % 4 = 0 THEN building_type || ' (renovated)' ELSE building_type END
                AS building_type,
              floor_area_sqft
       FROM (SELECT * FROM metadata WHERE upgrade = 0)""",
    "metadata",
)
def upsert_one_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    dimension = conform.building_attributes(b.building_metadata(spark, sf_dir)).select(
        "building_id", "building_type", "floor_area_sqft"
    )
    table, root = b.new_table("buildings"), scratch_dir(spark, "buildings")
    upsert.upsert(dimension.filter("building_id % 3 <> 0"), table, ["building_id"], root)
    # All that the seed lacks, and a quarter of all with a changed attribute.
    renovated = F.concat("building_type", F.lit(" (renovated)"))
    changed = dimension.filter("building_id % 3 = 0 OR building_id % 4 = 0").withColumn(
        "building_type",
        F.when(F.col("building_id") % 4 == 0, renovated).otherwise(F.col("building_type")),
    )
    upsert.upsert(changed, table, ["building_id"], root)
    return upsert.read_table(spark, table)


def _days_table(spark: SparkSession, sf_dir: str, repeats: int) -> DataFrame:
    """Days up to mid-1998, then a correction of everything from 1997 on."""
    days = (
        b.stored(b.daily_long, spark, sf_dir)
        .select("building_id", "usage_date", "electricity_kwh")
        .withColumn("part_month", F.trunc("usage_date", "month"))
    )
    table, root = b.new_table("days"), scratch_dir(spark, "days")
    keys = ["building_id", "usage_date"]
    first = days.filter(F.col("usage_date") < F.lit(date(1998, 7, 1)))
    upsert.upsert(first, table, keys, root, "part_month")
    corrected = days.filter(F.col("usage_date") >= F.lit(date(1997, 1, 1))).withColumn(
        "electricity_kwh", F.col("electricity_kwh") + F.lit(1.0)
    )
    for _ in range(repeats):
        upsert.upsert(corrected, table, keys, root, "part_month")
    return upsert.read_table(spark, table)


@query(
    "upsert_two_keys",
    """SELECT building_id, usage_date,
              CASE WHEN usage_date >= DATE '1997-01-01' THEN electricity_kwh + 1.0::DOUBLE
                   ELSE electricity_kwh END AS electricity_kwh
       FROM daily_long""",
    "daily_long",
)
def upsert_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _days_table(spark, sf_dir, repeats=1).drop("part_month")


@query(
    "upsert_idempotent",
    """SELECT cast(date_trunc('month', usage_date) AS DATE) AS part_month, count(*) AS rows,
              count(DISTINCT building_id) AS buildings, max(CASE
                WHEN usage_date >= DATE '1997-01-01' THEN electricity_kwh + 1.0::DOUBLE
                ELSE electricity_kwh END) AS largest_day
       FROM daily_long GROUP BY ALL""",
    "daily_long",
)
def upsert_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _days_table(spark, sf_dir, repeats=2).groupBy("part_month").agg(
        F.count("*").alias("rows"),
        F.count_distinct("building_id").alias("buildings"),
        F.max("electricity_kwh").alias("largest_day"),
    )


@query(
    "upsert_key_conflicts",
    """SELECT user_id AS bldg_id, cast(ts AS DATE) AS ingest_date, count(*) AS copies
       FROM (SELECT DISTINCT user_id, cast(ts AS DATE) AS ts, event_type FROM events)
       GROUP BY ALL HAVING count(*) > 1""",
)
def upsert_key_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows come per file, but the audit table is keyed without the file."""
    per_file = (
        b.table(spark, sf_dir, "events")
        .select(
            F.col("user_id").alias("bldg_id"),
            F.col("ts").cast("date").alias("ingest_date"),
            F.col("event_type").alias("source_file_name"),
        )
        .distinct()
    )
    return upsert.key_conflicts(per_file, ["bldg_id", "ingest_date"]).violations


@query("upsert_stream", "SELECT * FROM sparse_hours", "sparse_hours")
def upsert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = scratch_dir(spark, "landing")
    # A few files, read in three micro-batches; hours are split between them.
    b.sparse_readings(spark, sf_dir).repartition(6).write.parquet(landing)
    hourly = b.new_table("hourly")
    streaming.upsert_stream(
        spark,
        landing,
        hourly,
        scratch_dir(spark, "hourly"),
        scratch_dir(spark, "hourly-progress"),
        schemas.readings_schema(),
        max_files_per_trigger=2,
        digits=ENERGY_DIGITS,
    )
    return upsert.read_table(spark, hourly).select(
        "building_id", "source_hour_end", "interval_count", *MEASURES, "peak_15min_average_kw"
    )


@query(
    "end_use_composition",
    """SELECT building_id, strftime(usage_month, '%Y-%m') AS month_key,
              strftime(usage_month, '%B %Y') AS month, cooling_system_kwh AS cooling,
              heating_system_kwh AS heating, hot_water_kwh AS hot_water,
              CASE WHEN abs(other) < 0.01::DOUBLE THEN 0.0::DOUBLE ELSE other END AS other
       FROM (SELECT *, electricity_kwh - cooling_system_kwh - heating_system_kwh - hot_water_kwh AS other
             FROM monthly_long)""",
    "monthly_long",
)
def end_use_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return display.end_use_composition(b.monthly_long(spark, sf_dir))


@query(
    "end_use_change_long",
    """SELECT building_id, usage_month, 'Cooling' AS category, cooling_change_kwh AS change_kwh
       FROM investigation_long
       UNION ALL SELECT building_id, usage_month, 'Heating', heating_change_kwh FROM investigation_long
       UNION ALL SELECT building_id, usage_month, 'Hot water', hot_water_change_kwh FROM investigation_long
       UNION ALL SELECT building_id, usage_month, 'Other (derived)', other_electricity_change_kwh
       FROM investigation_long""",
    "investigation_long",
)
def end_use_change_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return display.end_use_changes(compare.investigation(b.monthly_long(spark, sf_dir)))
