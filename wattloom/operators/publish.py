"""Account view and published snapshots."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom import schemas
from wattloom.functions.measures import DEGREE_DAY_BASE_F
from wattloom.operators import conform, gates, rollup
from wattloom.operators.upsert import Staging
from wattloom.session import delete_path

#: Column that names the folder of a published row, and accounts in a folder on average.
BUCKET = "building_bucket"
ACCOUNTS_PER_BUCKET = 25_000

# Texts and numbers that readers of a snapshot rely on.
ACCOUNT_PREFIX = "DEMO-"
DATA_DESCRIPTION = "Modeled ResStock building; not a real customer account"
SCHEMA_VERSION = 3
DATASET = "ResStock 2022 release, AMY2018 baseline"
DATA_TYPE = "modeled building profiles"
ALIGNMENT_METHOD = "exact county_code + hour-ending timestamps"

# Attributes of a building that its account shows.
_ATTRIBUTES = [
    "state", "county_code", "building_type", "floor_area_sqft", "construction_vintage",
    "heating_fuel", "heating_system", "cooling_system",
]

DATASETS = {
    "accounts": schemas.ACCOUNTS,
    "daily_usage": schemas.DAILY,
    "monthly_usage": schemas.MONTHLY,
    "investigations": schemas.INVESTIGATIONS,
}
KEYS = {
    "accounts": ["building_id"],
    "daily_usage": ["building_id", "usage_date"],
    "monthly_usage": ["building_id", "usage_month"],
    "investigations": ["building_id", "usage_month"],
}


def account_id(building: str | Column = "building_id") -> Column:
    building = F.col(building) if isinstance(building, str) else building
    return F.concat(F.lit(ACCOUNT_PREFIX), building.cast("string"))


def with_account_id(df: DataFrame) -> DataFrame:
    return df.withColumn("account_id", account_id())


def account_summary(
    days: DataFrame,
    buildings: DataFrame,
    digits: int | None = None,
    context: tuple[str, ...] = (),
) -> DataFrame:
    """One row per building with any days: attributes, totals, provenance text, and the
    ``context`` columns of the building."""
    joined = buildings.join(rollup.account_metrics(days, digits), "building_id")
    return joined.select(
        "building_id",
        account_id().alias("account_id"),
        *_ATTRIBUTES,
        "days_present",
        "annual_electricity_kwh",
        "average_daily_kwh",
        "peak_15min_average_kw",
        F.lit(DATA_DESCRIPTION).alias("data_description"),
        *context,
    )


def create_account_view(
    spark: SparkSession, view: str, days: str, buildings: str, digits: int | None = None
) -> None:
    """The account summary as a view of the catalog over the tables ``days`` and ``buildings``.

    It is computed whenever it is read, so it follows every upsert of the two tables.
    ``digits``: see ``measures.exact_sum``.
    """
    total = "sum(electricity_kwh)"
    if digits is not None:
        unit = f"{float(10**digits)!r}D"
        total = f"cast(sum(cast(rint(electricity_kwh * {unit}) AS bigint)) AS double) / {unit}"
    mean = f"{total} / nullif(count(electricity_kwh), 0)" if digits is not None else "avg(electricity_kwh)"
    names = ", ".join(f"b.{c}" for c in _ATTRIBUTES)
    spark.sql(
        f"""CREATE OR REPLACE VIEW {view} AS
        SELECT b.building_id, concat('{ACCOUNT_PREFIX}', cast(b.building_id AS string)) AS account_id, {names},
               m.days_present, m.annual_electricity_kwh, m.average_daily_kwh, m.peak_15min_average_kw,
               '{DATA_DESCRIPTION}' AS data_description
        FROM {buildings} b JOIN (
          SELECT building_id, count(DISTINCT usage_date) AS days_present, {total} AS annual_electricity_kwh,
                 {mean} AS average_daily_kwh, max(peak_15min_average_kw) AS peak_15min_average_kw
          FROM {days} GROUP BY building_id) m ON b.building_id = m.building_id"""
    )


def published_accounts(
    days: DataFrame, buildings: DataFrame, digits: int | None = None
) -> DataFrame:
    """Account rows as published: summary plus weather city and reference use."""
    context = ("weather_city", "reference_annual_electricity_kwh")
    return account_summary(days, buildings, digits, context)


def ordered_listing(df: DataFrame, key: str) -> DataFrame:
    return df.orderBy(key)


def json_rows(df: DataFrame) -> DataFrame:
    """Each row as one JSON document that keeps its nulls."""
    every = F.struct(*[F.col(conform.quoted(c)) for c in df.columns])
    return df.select(F.to_json(every, {"ignoreNullFields": "false"}).alias("json"))


def snapshot_metadata(
    spark: SparkSession, snapshot_id: str, alignment_gaps: DataFrame, created_at: str
) -> DataFrame:
    """The one-row description of a snapshot.

    The alignment flag is computed: it holds when no hour lacks its weather.
    """
    verified = alignment_gaps.agg(F.count("*").alias("gaps")).scalar() == F.lit(0)
    return spark.range(1).select(
        F.lit(snapshot_id).alias("snapshot_id"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.lit(created_at).alias("created_at_utc"),
        F.lit(DATASET).alias("dataset"),
        F.lit(DATA_TYPE).alias("data_type"),
        verified.alias("weather_alignment_verified"),
        F.lit(ALIGNMENT_METHOD).alias("weather_alignment_method"),
        F.lit(DEGREE_DAY_BASE_F).alias("degree_day_base_f"),
    )


def publish_snapshot(
    root: str,
    accounts: DataFrame,
    daily: DataFrame,
    monthly: DataFrame,
    investigations: DataFrame,
    alignment_gaps: DataFrame,
    created_at: datetime | None = None,
    accounts_per_bucket: int = ACCOUNTS_PER_BUCKET,
    together: tuple[str, ...] = (),
) -> str:
    """Write the four datasets of a snapshot, check them, then write its metadata.

    Readers start from the metadata, so a snapshot becomes visible in one step and
    only when it is whole. Each dataset is computed once, as parquet in folders by a hash
    of the building, sorted by building and period. The written rows must be as many as
    were computed and must not repeat a key; otherwise they are deleted again.

    ``together`` names datasets of which a task holds the rows of a building together
    already: they need no shuffle, and make few files as they are.
    """
    spark = accounts.sparkSession
    now = created_at or datetime.now(timezone.utc)
    snapshot_id = now.strftime("%Y%m%dT%H%M%S%f")
    written = {name: f"{root}/{name}/snapshot_id={snapshot_id}" for name in DATASETS}
    with Staging(spark) as stage:
        accounts = stage(accounts, "accounts")
        buckets = max(1, -(-accounts.count() // accounts_per_bucket))
        bucket = F.pmod(F.xxhash64("building_id"), F.lit(buckets)).cast("int")
        rows = {
            "accounts": accounts,
            "daily_usage": daily,
            "monthly_usage": monthly,
            "investigations": investigations,
        }
        try:
            for name, df in rows.items():
                counted = Observation()
                columns = DATASETS[name].fieldNames()
                kept = [c for c in columns if c != "account_id"]
                computed = df.select(*kept).withColumn(BUCKET, bucket)
                if name not in together:
                    computed = computed.hint("rebalance", BUCKET)
                # Rebalancing splits a large folder over several tasks and files. The text of
                # the account is made from the building behind the shuffle.
                (
                    with_account_id(computed)
                    .select(*columns, BUCKET)
                    .sortWithinPartitions(BUCKET, *KEYS[name])
                    .observe(counted, F.count("*").alias("rows"))
                    .write.partitionBy(BUCKET)
                    .parquet(written[name])
                )
                computed_rows, stored_rows = counted.get.get("rows", 0), _stored(spark, name, written[name]).count()
                if computed_rows != stored_rows:
                    raise gates.GateFailed(f"{name}: {stored_rows} of {computed_rows} rows were written")
            _no_repeats({name: _stored(spark, name, path) for name, path in written.items()}).enforce()
        except gates.GateFailed:
            for path in written.values():
                delete_path(spark, path)
            raise
    snapshot_metadata(spark, snapshot_id, alignment_gaps, now.isoformat()).coalesce(1).write.option(
        "ignoreNullFields", "false"
    ).json(f"{root}/metadata/published={snapshot_id}")
    return snapshot_id


def _no_repeats(stored: dict[str, DataFrame]) -> gates.Gate:
    """Repeated keys of all datasets, looked for in one job."""
    repeats = [
        rollup.duplicate_keys(df, KEYS[name]).select(
            F.lit(name).alias("dataset"), F.to_json(F.struct(*KEYS[name])).alias("key"), "copies"
        )
        for name, df in stored.items()
    ]
    return gates.Gate("duplicate keys", reduce(DataFrame.unionByName, repeats))


def _stored(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A written dataset; ``BUCKET`` names the folder of a row."""
    schema = T.StructType([*DATASETS[name].fields, T.StructField(BUCKET, T.IntegerType())])
    return spark.read.schema(schema).parquet(path)


def export_json(snapshot: dict[str, DataFrame], path: str) -> None:
    """A snapshot as JSON lines, a folder for each dataset, nulls kept.

    The names of all fields stand in every line, so the lines are written compressed.
    """
    for name, df in snapshot.items():
        json_rows(df.drop(BUCKET)).write.option("compression", "gzip").text(f"{path}/{name}")


def read_metadata(spark: SparkSession, root: str) -> DataFrame:
    """Description of the newest whole snapshot (one row)."""
    published = spark.read.schema(schemas.METADATA).json(f"{root}/metadata")
    return published.select(*schemas.METADATA.fieldNames()).orderBy(F.desc("snapshot_id")).limit(1)


def read_snapshot(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The newest whole snapshot: its four datasets and its metadata.

    The datasets carry ``BUCKET``, the folder of a row: join on it as well as on the
    building, and Spark reads only the folders of the buildings asked for.
    """
    newest = read_metadata(spark, root).select("snapshot_id").first()
    if newest is None:
        raise ValueError(f"no published snapshot under {root}")
    current = {
        name: _stored(spark, name, f"{root}/{name}/snapshot_id={newest[0]}") for name in DATASETS
    }
    current["metadata"] = read_metadata(spark, root)
    return current
