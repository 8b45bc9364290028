"""Queries over scans, sources and sinks."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom import schemas
from wattloom.functions.measures import WEATHER_DIGITS
from wattloom.operators import compare, conform, publish, rollup
from wattloom.operators.upsert import stage
from wattloom.plans import bindings as b
from wattloom.plans.catalog import query
from wattloom.session import scratch_dir
from wattloom.sources import landing, transfer
from wattloom.streaming import ingest as streaming

TOTAL = conform.quoted(schemas.READING_MEASURES["electricity_kwh"])


def _landed(spark: SparkSession, readings: DataFrame) -> str:
    """Write readings as landing files, one folder per ingest date."""
    path = scratch_dir(spark, "landing")
    readings.write.partitionBy("ingest_date").parquet(path)
    return path


def _ingest(spark: SparkSession, files: str, runs: int = 1, **options: bool) -> DataFrame:
    """The raw layer of landing files, in a table of its own."""
    table, root = b.new_table("bronze"), scratch_dir(spark, "bronze")
    checkpoint = scratch_dir(spark, "bronze-progress")
    for _ in range(runs):
        streaming.ingest(spark, files, table, root, checkpoint, schemas.readings_schema(), **options)
    return streaming.read_bronze(spark, table)


@query(
    "ingest_stream",
    f"""SELECT building_id AS bldg_id, source_timestamp AS "timestamp",
               {", ".join(f'{m} AS "{source}"' for m, source in schemas.READING_MEASURES.items())},
               ingest_date, true AS path_ends_with_name, true AS has_size,
               cast(NULL AS VARCHAR) AS _rescued_data
        FROM sparse""",
    "sparse",
)
def ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns; path, name and size of the files as what must hold for them."""
    bronze = _ingest(spark, _landed(spark, b.sparse_readings(spark, sf_dir)))
    return bronze.select(
        *[F.col(conform.quoted(c)) for c in schemas.readings_schema().fieldNames()],
        F.col("source_file_path").endswith(F.col("source_file_name")).alias("path_ends_with_name"),
        (F.col("source_file_size") > 0).alias("has_size"),
        landing.RESCUED,
    )


@query(
    "ingest_idempotent",
    "SELECT ingest_date, count(*) AS rows FROM sparse GROUP BY ingest_date",
    "sparse",
)
def ingest_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    twice = _ingest(spark, _landed(spark, b.sparse_readings(spark, sf_dir)), runs=2)
    return twice.groupBy("ingest_date").agg(F.count("*").alias("rows"))


@query(
    "ingest_provenance",
    """SELECT 'events.parquet' AS source_file_name, true AS path_ends_with_name,
              true AS has_size, count(*) AS rows FROM events""",
)
def ingest_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    traced = landing.with_provenance(b.table(spark, sf_dir, "events"))
    return traced.groupBy(
        "source_file_name",
        F.col("source_file_path").endswith(F.col("source_file_name")).alias("path_ends_with_name"),
        (F.col("source_file_size") > 0).alias("has_size"),
    ).agg(F.count("*").alias("rows"))


@query(
    "partition_date",
    """SELECT ingest_date, count(*) AS rows, min(source_timestamp) AS first_timestamp,
              max(source_timestamp) AS last_timestamp FROM sparse GROUP BY ingest_date""",
    "sparse",
)
def partition_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _landed(spark, b.sparse_readings(spark, sf_dir))
    return (
        landing.read_landing(spark, files, schemas.readings_schema())
        .groupBy("ingest_date")
        .agg(
            F.count("*").alias("rows"),
            F.min("timestamp").alias("first_timestamp"),
            F.max("timestamp").alias("last_timestamp"),
        )
    )


@query(
    "schema_evolution",
    """SELECT cast(ts AS DATE) AS ingest_date, count(*) AS rows,
              count(CASE WHEN cast(ts AS DATE) >= DATE '2024-01-15' THEN event_type END)
                AS rows_with_tariff
       FROM events GROUP BY ALL""",
)
def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = b.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("bldg_id"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias(schemas.READING_MEASURES["electricity_kwh"]),
        F.col("event_type").alias("tariff"),
        F.col("ts").cast("date").alias("ingest_date"),
    )
    since = F.lit(date(2024, 1, 15))
    files = scratch_dir(spark, "landing")
    older = events.filter(F.col("ingest_date") < since).drop("tariff")
    for part in (older, events.filter(F.col("ingest_date") >= since)):
        part.write.mode("append").partitionBy("ingest_date").parquet(files)
    return (
        _ingest(spark, files, new_columns=True)
        .groupBy("ingest_date")
        .agg(F.count("*").alias("rows"), F.count("tariff").alias("rows_with_tariff"))
    )


@query(
    "rescue_data",
    """SELECT user_id AS building_id, ts AS source_timestamp,
              CASE WHEN k % 10 NOT IN (0, 1) THEN value END AS electricity_kwh,
              CASE WHEN k % 10 = 0 AND k % 7 = 0 THEN
                     '{"out.electricity.total.energy_consumption":"n/a","remark":"' || event_type || '"}'
                   WHEN k % 10 = 1 AND k % 7 = 0 THEN
                     '{"out.electricity.total.energy_consumption":"NaN","remark":"' || event_type || '"}'
                   WHEN k % 10 = 0 THEN '{"out.electricity.total.energy_consumption":"n/a"}'
                   WHEN k % 10 = 1 THEN '{"out.electricity.total.energy_consumption":"NaN"}'
                   WHEN k % 7 = 0 THEN '{"remark":"' || event_type || '"}' END AS rescued
       FROM (SELECT *, cast(json_extract_string(props, '$.k') AS INT) AS k FROM events)""",
)
def rescue_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the readings arrive in files that store the total as a number, half as text."""
    files = scratch_dir(spark, "landing")
    arrived = b.text_readings(spark, sf_dir).withColumn("ingest_date", F.col("timestamp").cast("date"))
    total = F.col(TOTAL)
    numbers = total.try_cast("double").isNotNull() & ~F.isnan(total.try_cast("double")) & (F.col("bldg_id") % 2 == 0)
    for part in (arrived.filter(~numbers), arrived.filter(numbers).withColumn(TOTAL.strip("`"), total.cast("double"))):
        part.write.mode("append").partitionBy("ingest_date").parquet(files)
    return _ingest(spark, files).select(
        F.col("bldg_id").alias("building_id"),
        F.col("timestamp").alias("source_timestamp"),
        F.col(TOTAL).alias("electricity_kwh"),
        F.col(landing.RESCUED).alias("rescued"),
    )


@query("table_scan", "SELECT * FROM orders")
def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.table(spark, sf_dir, "orders")


@query(
    "inline_lookup",
    """SELECT m.county_code, l.weather_city, count(*) AS buildings
       FROM metadata m LEFT JOIN partial_locations l USING (county_code) GROUP BY ALL""",
    "metadata",
    "partial_locations",
)
def inline_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    attributes = conform.project_metadata(b.building_metadata(spark, sf_dir))
    counted = attributes.groupBy("county_code").agg(F.count("*").alias("buildings"))
    return conform.join_weather_city(counted, b.partial_locations(spark)).select(
        "county_code", "weather_city", "buildings"
    )


@query(
    "snapshot_rows",
    "SELECT *, previous_month IS NULL AS null_kept FROM investigation_long",
    "investigation_long",
)
def snapshot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of the rows, read back from their JSON."""
    comparisons = compare.investigation(b.monthly_long(spark, sf_dir))
    null_kept = F.col("json").contains('"previous_month":null').alias("null_kept")
    read_back = F.from_json("json", comparisons.schema).alias("row")
    return publish.json_rows(comparisons).select(read_back, null_kept).select("row.*", "null_kept")


def long_layers(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The layers of the seven-year accounts that a snapshot publishes; days, months and
    accounts are written once and read by all that follows.

    Days of a building lie together, so that months and accounts are reduced before they
    are shuffled, and days are published without another shuffle. So are comparisons, as
    their window leaves them.
    """
    days = b.daily_long(spark, sf_dir).hint("rebalance", "building_id")
    days = stage(days.sortWithinPartitions("building_id", "usage_date"), "daily-long")
    months = stage(rollup.monthly_rollup(days, 2, WEATHER_DIGITS), "monthly-long")
    buildings = b.supplier_buildings(spark, sf_dir)
    return {
        "accounts": stage(publish.published_accounts(days, buildings, digits=2), "accounts"),
        "daily_usage": days,
        "monthly_usage": months,
        "investigations": compare.investigation(months),
    }


def published(spark: SparkSession, sf_dir: str, layers: dict[str, DataFrame] | None = None) -> str:
    """A snapshot of the seven-year accounts in a folder of its own."""
    root = scratch_dir(spark, "snapshots")
    layers = layers or long_layers(spark, sf_dir)
    days = layers["daily_usage"]
    publish.publish_snapshot(
        root,
        layers["accounts"],
        days,
        layers["monthly_usage"],
        layers["investigations"],
        days.filter(F.col("weather_city").isNull()),
        together=("daily_usage", "investigations"),
    )
    return root


@query(
    "snapshot_publish",
    """SELECT 'accounts' AS layer, count(*) AS rows, count(DISTINCT account_id) AS accounts,
              sum(cast(round_even(annual_electricity_kwh * 100.0::DOUBLE, 0) AS BIGINT))::BIGINT AS kwh_hundredths
       FROM summary
       UNION ALL SELECT 'daily_usage', count(*), count(DISTINCT building_id),
              sum(cast(round_even(electricity_kwh * 100.0::DOUBLE, 0) AS BIGINT))::BIGINT FROM daily_long
       UNION ALL SELECT 'monthly_usage', count(*), count(DISTINCT building_id),
              sum(cast(round_even(electricity_kwh * 100.0::DOUBLE, 0) AS BIGINT))::BIGINT FROM monthly_long
       UNION ALL SELECT 'investigations', count(*), count(DISTINCT building_id),
              sum(cast(round_even(electricity_kwh * 100.0::DOUBLE, 0) AS BIGINT))::BIGINT FROM monthly_long
       UNION ALL SELECT 'metadata', 1, NULL, NULL""",
    "summary",
    "monthly_long",
)
def snapshot_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and totals of a published snapshot, read back from its JSON export."""
    current = publish.read_snapshot(spark, published(spark, sf_dir))
    export = scratch_dir(spark, "export")
    publish.export_json(current, export)
    counts = []
    for name, df in current.items():
        rows = spark.read.schema(df.drop(publish.BUCKET).schema).json(f"{export}/{name}")
        total = next((c for c in ("annual_electricity_kwh", "electricity_kwh") if c in rows.columns), None)
        ids = F.count_distinct("account_id") if "account_id" in rows.columns else F.lit(None).cast("bigint")
        hundredths = F.lit(None).cast("bigint") if total is None else F.sum(F.rint(F.col(total) * 100.0).cast("bigint"))
        counts.append(
            rows.agg(
                F.count("*").alias("rows"), ids.alias("accounts"), hundredths.alias("kwh_hundredths")
            ).select(F.lit(name).alias("layer"), "rows", "accounts", "kwh_hundredths")
        )
    return reduce(DataFrame.unionByName, counts)


# The texts and numbers are the fixed values of a snapshot's description.
@query(
    "snapshot_metadata",
    """SELECT 3 AS schema_version, 'ResStock 2022 release, AMY2018 baseline' AS dataset,
              'modeled building profiles' AS data_type,
              NOT EXISTS (SELECT 1 FROM sparse_hours h JOIN buildings b USING (building_id)
                          WHERE NOT EXISTS (SELECT 1 FROM gappy_weather w
                            WHERE w.county_code = b.county_code
                              AND w.weather_timestamp = h.source_hour_end))
                AS weather_alignment_verified,
              'exact county_code + hour-ending timestamps' AS weather_alignment_method,
              65.0::DOUBLE AS degree_day_base_f""",
    "sparse_hours",
    "buildings",
    "gappy_weather",
)
def snapshot_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = conform.join_buildings(b.sparse_hours(spark, sf_dir), b.buildings(spark, sf_dir))
    gaps = conform.unmatched_weather(located, b.gappy_weather(spark, sf_dir))
    return publish.snapshot_metadata(spark, "s1", gaps, "2024-02-01T00:00:00+00:00").drop(
        "snapshot_id", "created_at_utc"
    )


@query(
    "snapshot_read",
    """SELECT 'accounts' AS dataset, * FROM accounts
       UNION ALL BY NAME SELECT 'daily_usage' AS dataset, 'DEMO-' || building_id AS account_id, * FROM daily_long
       UNION ALL BY NAME SELECT 'monthly_usage' AS dataset, 'DEMO-' || building_id AS account_id, * FROM monthly_long
       UNION ALL BY NAME SELECT 'investigations' AS dataset, 'DEMO-' || building_id AS account_id, *
                         FROM investigation_long""",
    "accounts",
    "investigation_long",
)
def snapshot_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows and columns of the four datasets."""
    current = publish.read_snapshot(spark, published(spark, sf_dir))
    parts = [current[name].drop(publish.BUCKET).withColumn("dataset", F.lit(name)) for name in publish.DATASETS]
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), parts)


@query(
    "transfer_audit_scan",
    """SELECT run_date, status, count(*) AS runs,
              sum(CASE WHEN moved IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS files_transferred,
              coalesce(sum(size), 0)::BIGINT AS bytes_transferred,
              count(CASE WHEN moved % 5 = 0 THEN 1 END) AS landing_reused,
              count(CASE WHEN moved % 11 = 0 THEN 1 END) AS archive_reused,
              count(CASE WHEN moved % 50 = 0 THEN 1 END) AS size_mismatches
       FROM records GROUP BY run_date, status""",
    "records",
)
def transfer_audit_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "transfer-audit")
    b.transfer_records(spark, sf_dir).write.json(path)
    return transfer.summarize_runs(transfer.read_records(spark, path))


@query(
    "transfer_reconcile",
    """SELECT file_name, i.size_bytes IS NOT NULL AS in_incoming,
              l.size_bytes IS NOT NULL AS in_landing, a.size_bytes IS NOT NULL AS in_archive,
              i.size_bytes AS incoming_size_bytes, l.size_bytes AS landing_size_bytes,
              a.size_bytes AS archive_size_bytes,
              coalesce(l.size_bytes = i.size_bytes, false) AS landing_matches,
              coalesce(a.size_bytes = i.size_bytes, false) AS archive_matches,
              coalesce(l.size_bytes = i.size_bytes AND a.size_bytes = i.size_bytes, false)
                AS safe_to_remove
       FROM incoming i FULL JOIN landing l USING (file_name) FULL JOIN archive a USING (file_name)""",
    "incoming",
    "landing",
    "archive",
)
def transfer_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transfer.reconcile(
        *[b.file_area(spark, sf_dir, area) for area in ("incoming", "landing", "archive")]
    )


@query(
    "next_file",
    """SELECT 'incoming/' || file_name AS key, size_bytes FROM incoming
       ORDER BY 'incoming/' || file_name LIMIT 1""",
    "incoming",
)
def next_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transfer.next_file(b.file_area(spark, sf_dir, "incoming"))
