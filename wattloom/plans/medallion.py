"""The layers end to end: raw readings to published snapshot.

Every layer is computed once, written to the shared folder, checked there and only
then upserted into its table; the next layer starts from the written rows. Fact
tables are partitioned by month, so a refresh touches the months it has rows for.
Row checks are counted by the job that writes the layer. What a step staged is deleted
when it ends, whether it succeeds or fails.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime, time, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattloom.operators import compare, conform, gates, publish, rollup
from wattloom.operators.upsert import Staging, read_table, upsert

PART = "part_month"


@dataclass(frozen=True)
class Tables:
    """The tables of a deployment: a database of the session catalog, files below ``root``."""

    root: str
    database: str = "wattloom"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def name(self, name: str) -> str:
        return f"{self.database}.{name}"

    def read(self, spark: SparkSession, name: str, since: date | None = None) -> DataFrame:
        """A table, of a table kept by month only the months from that of ``since`` on."""
        df = read_table(spark, self.name(name))
        if df is None:
            raise ValueError(f"table {self.name(name)} has not been written")
        if since is not None:
            df = df.filter(F.col(PART) >= F.lit(since.replace(day=1)))
        return df.drop(PART)

    def upsert(self, rows: DataFrame, name: str, keys: list[str], period: str | None = None, **known: bool) -> None:
        """Upsert into a table; one with a ``period`` is kept by its month."""
        self._create(rows.sparkSession)
        if period is not None:
            rows = _by_month(rows, period)
        upsert(rows, self.name(name), keys, self.path(name), PART if period else None, **known)

    def stage(self, staging: Staging, rows: DataFrame, name: str, period: str, *checks: gates.Check) -> Layer:
        """Rows written by month where the table's files are, to be checked before ``take``."""
        folder = f"{self.path(name)}/{uuid.uuid4().hex}"
        return Layer(name, folder, staging.by_partition(_by_month(rows, period), folder, PART, *checks))

    def take(self, staging: Staging, layer: Layer, keys: list[str], keys_unique: bool = False) -> None:
        """Upsert a staged layer. Months that the table does not have yet are taken as they lie."""
        self._create(staging.spark)
        taken = upsert(
            layer.written, self.name(layer.name), keys, self.path(layer.name), PART,
            staged=True, keys_unique=keys_unique, laid_out=layer.folder,
        )
        if taken == layer.folder:
            staging.keep(layer.folder)

    def _create(self, spark: SparkSession) -> None:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION '{self.root}'")


@dataclass(frozen=True)
class Layer:
    """Rows staged for a table: ``written`` has its month column, ``rows`` has not."""

    name: str
    folder: str
    written: DataFrame

    @property
    def rows(self) -> DataFrame:
        return self.written.drop(PART)


def _by_month(rows: DataFrame, period: str) -> DataFrame:
    return rows.withColumn(PART, F.trunc(F.col(period).cast("date"), "month"))


def refresh_audit(tables: Tables, bronze: DataFrame, expected_rows: int) -> None:
    """Reconcile the raw layer by building and ingest date."""
    tables.upsert(rollup.ingest_audit(bronze, expected_rows), "ingest_audit", ["bldg_id", "ingest_date"])


def refresh_buildings(
    tables: Tables, bronze: DataFrame, metadata: DataFrame, locations: DataFrame
) -> None:
    """Onboard the buildings that have arrived; all of them or none."""
    with Staging(bronze.sparkSession) as stage:
        candidates = stage(
            conform.onboarding_candidates(bronze, metadata, locations), "building-candidates"
        )
        gates.onboarding(candidates).enforce()
        tables.upsert(candidates, "buildings", ["building_id"], staged=True)


def refresh_silver(
    tables: Tables, bronze: DataFrame, weather: DataFrame, since: date | None = None
) -> None:
    """Readings, hours and weather-enriched hours, for days from ``since`` on."""
    spark = bronze.sparkSession
    if since is not None:
        # A stamp closes its interval: midnight belongs to the day before. A plain
        # comparison of the column reaches the scan.
        first = datetime.combine(since, time()) + timedelta(seconds=1)
        bronze = bronze.filter(F.col("timestamp") >= F.lit(first).cast(bronze.schema["timestamp"].dataType))
    with Staging(spark) as stage:
        clean = gates.Counted([gates.no_rescued()])
        readings = tables.stage(
            stage, conform.project_consumption(clean.over(bronze)), "consumption", "source_timestamp"
        )
        clean.enforce()
        gates.duplicates(readings.rows, ["building_id", "source_timestamp"]).enforce()
        hours = tables.stage(
            stage, rollup.hourly_rollup(readings.rows), "consumption_hourly", "source_hour_end", gates.whole_hours()
        )
        located = conform.join_buildings(hours.rows, tables.read(spark, "buildings"))
        gates.weather_complete(located, weather).enforce()
        enriched = tables.stage(
            stage, conform.join_weather(located, weather), "energy_weather_hourly", "hour_end"
        )
        for layer, time_key in [(readings, "source_timestamp"), (hours, "source_hour_end"), (enriched, "hour_end")]:
            # The gates and the grouping have settled that keys are unique.
            tables.take(stage, layer, ["building_id", time_key], keys_unique=True)


def refresh_gold(tables: Tables, spark: SparkSession, since: date | None = None) -> None:
    """Days, months and comparisons of the month of ``since`` and all later ones, and the
    account view.

    A month is always computed from all its days, so ``since`` may lie within it.
    """
    if since is not None:
        since = since.replace(day=1)
    hours = tables.read(spark, "energy_weather_hourly", since)
    if since is not None:
        # The partition of an hour is the month of its stamp, which for the last hour
        # of a month is the next; its usage date decides.
        hours = hours.filter(F.col("usage_date") >= F.lit(since))
    with Staging(spark) as stage:
        days = tables.stage(
            stage, rollup.daily_rollup(hours), "daily_energy_weather", "usage_date", gates.whole_days()
        )
        tables.take(stage, days, ["building_id", "usage_date"])
        monthly = ["building_id", "usage_month"]
        tables.upsert(rollup.monthly_rollup(days.rows), "monthly_energy_weather", monthly, "usage_month")
        changes = _comparisons(tables, spark, since)
        tables.upsert(changes, "usage_investigation_weather", monthly, "usage_month")
    publish.create_account_view(
        spark, tables.name("account_summary"), tables.name("daily_energy_weather"), tables.name("buildings")
    )


def _comparisons(tables: Tables, spark: SparkSession, since: date | None) -> DataFrame:
    """Comparisons of the months from ``since`` on, each building's last earlier month
    standing before them."""
    months = tables.read(spark, "monthly_energy_weather")
    if since is None:
        return compare.investigation(months)
    first = F.lit(since)
    earlier = months.filter(F.col("usage_month") < first)
    last = earlier.groupBy("building_id").agg(
        F.max_by(F.struct(*months.columns), "usage_month").alias("row")
    )
    current = tables.read(spark, "monthly_energy_weather", since).unionByName(last.select("row.*"))
    return compare.investigation(current).filter(F.col("usage_month") >= first)


def accounts(tables: Tables, spark: SparkSession) -> DataFrame:
    """The account view over the current days and buildings."""
    return publish.published_accounts(
        tables.read(spark, "daily_energy_weather"), tables.read(spark, "buildings")
    )


def layers(tables: Tables, spark: SparkSession, bronze: DataFrame) -> dict[str, DataFrame]:
    """All layers by the names used in the count checks."""
    return {
        "bronze": bronze,
        "silver_15min": tables.read(spark, "consumption"),
        "silver_hourly": tables.read(spark, "consumption_hourly"),
        "silver_buildings": tables.read(spark, "buildings"),
        "gold_daily": tables.read(spark, "daily_energy_weather"),
        "gold_monthly": tables.read(spark, "monthly_energy_weather"),
        "gold_investigation": tables.read(spark, "usage_investigation_weather"),
        "gold_accounts": spark.table(tables.name("account_summary")),
    }


def refresh(
    tables: Tables,
    bronze: DataFrame,
    metadata: DataFrame,
    locations: DataFrame,
    weather: DataFrame,
    since: date | None = None,
    per_building: dict[str, int] | None = None,
) -> str:
    """The whole flow after an ingest: audit, layers, count checks, snapshot.

    ``per_building`` holds the rows per building that each layer should have; a
    layer that has others stops the flow before anything is published.
    """
    spark = bronze.sparkSession
    expected = per_building or gates.YEAR_EXPECTATION
    refresh_audit(tables, bronze, expected["bronze"])
    refresh_buildings(tables, bronze, metadata, locations)
    refresh_silver(tables, bronze, weather, since)
    refresh_gold(tables, spark, since)
    counts = rollup.layer_counts(layers(tables, spark, bronze))
    gates.layers_complete(counts, tables.read(spark, "buildings"), expected).enforce()
    return publish_current(tables, spark, weather)


def publish_current(tables: Tables, spark: SparkSession, weather: DataFrame) -> str:
    """Publish the current layers as a new snapshot.

    Refused if a first month carries a comparison or a later one carries none.
    """
    investigations = tables.read(spark, "usage_investigation_weather")
    gates.Gate("first periods", compare.first_period_violations(investigations)).enforce()
    located = conform.join_buildings(
        tables.read(spark, "consumption_hourly"), tables.read(spark, "buildings")
    )
    return publish.publish_snapshot(
        tables.path("snapshots"),
        accounts(tables, spark),
        tables.read(spark, "daily_energy_weather"),
        tables.read(spark, "monthly_energy_weather"),
        investigations,
        conform.unmatched_weather(located, weather),
    )
