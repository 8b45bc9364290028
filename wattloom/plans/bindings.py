"""The star-schema test tables seen as metering data.

Each function builds one domain table from whole test tables with Spark; the
entry of the same name in ``CTES`` is the same table for DuckDB. Users of the
package read their own metering data instead and need nothing of this module.

Values carry at most two decimals and derived ones use integer arithmetic, so both
engines get the same doubles.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattloom import schemas
from wattloom.functions.measures import ENERGY_DIGITS, WEATHER_DIGITS, exact_sum
from wattloom.operators import conform, publish, rollup
from wattloom.operators.upsert import stage
from wattloom.sources import landing
from wattloom.sources.lookups import weather_locations

QUARTER_US = 900_000_000
GRID_ROWS = 2_000_000  # rows of the quarter-hour grid in one partition
BUCKET_ROWS = 250_000  # line items whose days make one bucket, on average
UNMAPPED_FROM = 22  # nations from this key on have no weather city in the partial lookup
M = schemas.READING_MEASURES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- interval readings from events -------------------------------------------

# Event type, and range of the numeric property, that feed each end use.
_END_USE = {
    "cooling_kwh": "event_type = 'click'",
    "cooling_fans_pumps_kwh": "event_type = 'view'",
    "heating_kwh": "event_type = 'purchase' AND k < 50",
    "heating_backup_kwh": "event_type = 'purchase' AND k >= 50 AND k < 80",
    "heating_fans_pumps_kwh": "event_type = 'purchase' AND k >= 80",
    "hot_water_kwh": "event_type = 'signup'",
    "net_electricity_kwh": "event_type <> 'error'",
    "electricity_kwh": "TRUE",
}


def _part(measure: str) -> str:
    return f"CASE WHEN {_END_USE[measure]} THEN value ELSE 0.0D END"


def _with_k(events: DataFrame) -> DataFrame:
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def _reading_columns() -> list[Column]:
    return [
        F.col("user_id").alias("bldg_id"),
        F.col("ts").alias("timestamp"),
        *[F.expr(_part(m)).alias(source) for m, source in M.items()],
        F.col("ts").cast("date").alias("ingest_date"),
    ]


def sparse_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per event, in the layout of the landing files."""
    return _with_k(table(spark, sf_dir, "events")).select(*_reading_columns())


def bronze_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings as a raw layer: with provenance and some rescued values."""
    events = _with_k(landing.with_provenance(table(spark, sf_dir, "events")))
    return events.select(
        *_reading_columns(),
        *landing.PROVENANCE,
        F.when(F.col("k") % 25 == 0, F.lit('{"unit":"MWh"}')).alias(landing.RESCUED),
    )


def text_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings delivered as text, with some words among the numbers and a column
    the declared schema does not know."""
    return _with_k(table(spark, sf_dir, "events")).select(
        F.col("user_id").alias("bldg_id"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("k") % 10 == 0, F.lit("n/a"))
        .when(F.col("k") % 10 == 1, F.lit("NaN"))
        .otherwise(F.col("value").cast("string"))
        .alias(M["electricity_kwh"]),
        F.when(F.col("k") % 7 == 0, F.col("event_type")).alias("remark"),
    )


def _bounds(spark: SparkSession, sf_dir: str) -> tuple[Column, Column]:
    """First midnight and last midnight of the days the events cover."""
    days = table(spark, sf_dir, "events").select(F.col("ts").cast("date").alias("day"))
    first = days.agg(F.min("day").cast("timestamp_ntz")).scalar()
    last = days.agg(F.date_add(F.max("day"), 1).cast("timestamp_ntz")).scalar()
    return first, last


def meter_15min(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reading for every building and quarter hour of the days covered.

    Only the readings there are travel, to the partition of their building. Each then
    stands before the quarters without a reading that follow it, so the grid is made where
    it is used and never shuffled, and rows stay together by building for what follows.
    """
    sparse = sparse_readings(spark, sf_dir)
    up = F.unix_micros(F.col("timestamp").cast("timestamp")) + F.lit(QUARTER_US - 1)
    quarter = F.timestamp_micros(up - up % F.lit(QUARTER_US)).cast("timestamp_ntz")
    first, last = _bounds(spark, sf_dir)
    step = F.expr("INTERVAL '15' MINUTE")
    used = sparse.groupBy("bldg_id", quarter.alias("timestamp")).agg(
        *[exact_sum(conform.quoted(source), 2).alias(m) for m, source in M.items()]
    )
    used = used.filter(F.col("bldg_id").isNotNull() & (F.col("timestamp") > first))
    starts = sparse.select("bldg_id").distinct().withColumn("timestamp", first)
    marks = starts.unionByName(used, allowMissingColumns=True).repartition(
        _grid_partitions(spark, sf_dir), "bldg_id"
    )
    following = F.lead("timestamp").over(Window.partitionBy("bldg_id").orderBy("timestamp"))
    grid = marks.withColumn("_until", F.coalesce(following - step, last)).select(
        "*", F.posexplode(F.sequence("timestamp", "_until", step)).alias("_at", "_quarter")
    )
    # A start closes the interval before the first.
    return grid.filter(F.col("_quarter") > first).select(
        "bldg_id",
        F.col("_quarter").alias("timestamp"),
        *[
            F.coalesce(F.when(F.col("_at") == 0, F.col(m)), F.lit(0.0)).alias(source)
            for m, source in M.items()
        ],
        F.col("_quarter").cast("date").alias("ingest_date"),
    )


def _grid_partitions(spark: SparkSession, sf_dir: str) -> int:
    """Partitions of the grid by its own number of rows: what goes in is far smaller than
    what comes out, so Spark's sizes say nothing."""
    day = F.col("ts").cast("date")
    days = (F.datediff(F.max(day), F.min(day)) + 1).cast("bigint")
    size = table(spark, sf_dir, "events").agg((F.approx_count_distinct("user_id") * days * 96).alias("rows"))
    rows = size.first()["rows"] or 0
    return max(spark.sparkContext.defaultParallelism, -(-rows // GRID_ROWS))


# --- buildings and weather ----------------------------------------------------


def building_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Building attributes as text, for the baseline and one other scenario."""
    customers = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return customers.select(
        F.col("c_custkey").alias("bldg_id"),
        F.explode(F.array(F.lit(0), F.lit(1))).alias("upgrade"),
        F.col("r_name").alias("in.state"),
        F.col("n_name").alias("in.county"),
        F.col("c_mktsegment").alias("in.geometry_building_type_recs"),
        F.when(F.col("c_custkey") % 17 == 0, F.lit("n/a"))
        .otherwise(F.col("c_acctbal").cast("string"))
        .alias("in.sqft"),
        (F.lit(1940) + F.col("c_custkey") % 80).cast("string").alias("in.vintage"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit("Natural Gas"))
        .otherwise(F.lit("Electricity"))
        .alias("in.heating_fuel"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("Furnace"))
        .otherwise(F.lit("Heat pump"))
        .alias("in.hvac_heating_type"),
        F.lit("Central AC").alias("in.hvac_cooling_type"),
        (F.col("c_custkey") * 100).cast("string").alias(
            "out.electricity.total.energy_consumption.kwh"
        ),
    )


def repeated_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several attribute rows per building: one for each order of a customer."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("building_id"),
        F.col("o_orderpriority").alias("construction_vintage"),
        F.col("o_totalprice").alias("floor_area_sqft"),
        F.col("o_orderdate").cast("date").alias("seen_on"),
    )


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A weather city for every nation (25 rows at any scale)."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("county_code"),
        F.concat(F.lit("Station "), F.col("n_nationkey").cast("string")).alias("weather_city"),
    )


def partial_locations(spark: SparkSession) -> DataFrame:
    """A literal lookup that leaves the last nations unmapped."""
    return weather_locations(
        spark, [(f"NATION_{k}", f"Station {k}") for k in range(UNMAPPED_FROM)]
    )


def buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The building dimension of the metered buildings."""
    return conform.onboarding_candidates(
        sparse_readings(spark, sf_dir), building_metadata(spark, sf_dir), locations(spark, sf_dir)
    )


def weather_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A weather row for every nation and hour of the days covered."""
    first, last = _bounds(spark, sf_dir)
    hour = F.expr("INTERVAL '1' HOUR")
    stamps = table(spark, sf_dir, "nation").select(
        "n_nationkey",
        "n_name",
        F.posexplode(F.sequence(first + hour, last, hour)).alias("i", "weather_timestamp"),
    )
    nk, h = F.col("n_nationkey").cast("bigint"), F.col("i").cast("bigint") + F.lit(1)

    def wave(a: int, b: int, cycle: int, scale: float, shift: float) -> Column:
        raw = (nk * F.lit(a) + h * F.lit(b)) % F.lit(cycle)
        return raw.cast("double") / F.lit(scale) + F.lit(shift)

    return stamps.select(
        F.col("n_name").alias("county_code"),
        "weather_timestamp",
        *[wave(*spec).alias(name) for name, spec in _WAVES.items()],
        F.concat(F.lit("weather_"), nk.cast("string"), F.lit(".csv")).alias("source_file"),
    )


_WAVES = {
    "temperature_c": (7, 3, 400, 10.0, -5.0),
    "relative_humidity_pct": (11, 5, 600, 10.0, 30.0),
    "wind_speed_mps": (3, 7, 150, 10.0, 0.0),
    "wind_direction_deg": (13, 10, 360, 1.0, 0.0),
    "global_horizontal_radiation_wm2": (1, 17, 1000, 1.0, 0.0),
    "direct_normal_radiation_wm2": (2, 19, 900, 1.0, 0.0),
    "diffuse_horizontal_radiation_wm2": (5, 23, 400, 1.0, 0.0),
}


def gappy_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weather series without the night hours of some nations, and with one
    nation's series doubled."""
    weather = weather_hourly(spark, sf_dir)
    kept = weather.filter(
        ~(
            F.col("county_code").isin("NATION_3", "NATION_11")
            & (F.hour("weather_timestamp") < 4)
        )
    )
    return kept.unionByName(weather.filter(F.col("county_code") == "NATION_7"))


# --- the layers over them -----------------------------------------------------


def sparse_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.hourly_rollup(
        conform.project_consumption(sparse_readings(spark, sf_dir)), ENERGY_DIGITS
    )


def dense_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.hourly_rollup(conform.project_consumption(meter_15min(spark, sf_dir)), ENERGY_DIGITS)


def enriched_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense hours with place and weather; the dimension is a written table, so that
    Spark knows its size when it picks the join."""
    return conform.enrich_hours(
        dense_hours(spark, sf_dir),
        stored(buildings, spark, sf_dir),
        weather_hourly(spark, sf_dir),
    )


# --- several years of days from line items -------------------------------------


def daily_long(spark: SparkSession, sf_dir: str, buckets: int | None = None) -> DataFrame:
    """Days of use over seven years: suppliers as buildings, prices as energy.

    ``buckets``: deal the days of a building to one of so many partitions, before the
    columns of place and weather are added.
    """
    items = table(spark, sf_dir, "lineitem")

    def use(condition: str) -> Column:
        return exact_sum(
            F.expr(f"CASE WHEN {condition} THEN l_extendedprice ELSE 0.0D END"), 2
        )

    days = items.groupBy(
        F.col("l_suppkey").alias("building_id"),
        F.col("l_shipdate").cast("date").alias("usage_date"),
    ).agg(
        use("TRUE").alias("electricity_kwh"),
        use("NOT (l_returnflag = 'N' AND l_linestatus = 'F')").alias("net_electricity_kwh"),
        use("l_returnflag = 'R'").alias("cooling_system_kwh"),
        use("l_returnflag = 'A'").alias("heating_system_kwh"),
        use("l_returnflag = 'N' AND l_linestatus = 'O'").alias("hot_water_kwh"),
        F.max("l_quantity").alias("peak_15min_average_kw"),
    )
    if buckets is not None:
        days = days.repartition(buckets, "building_id")
    placed = days.join(_suppliers(spark, sf_dir), "building_id")
    nk = F.col("s_nationkey").cast("bigint")
    n = F.datediff("usage_date", F.lit("1995-01-01").cast("date")).cast("bigint")

    def tenths(raw: Column) -> Column:
        return raw.cast("double") / F.lit(10.0)

    mean = (nk * F.lit(13) + n * F.lit(7)) % F.lit(1000)
    climate = placed.select(
        *rollup.PLACE_KEYS,
        "usage_date",
        F.lit(24).cast("bigint").alias("hours_present"),
        "electricity_kwh",
        "net_electricity_kwh",
        *schemas.END_USES,
        "peak_15min_average_kw",
        tenths(mean).alias("average_temperature_f"),
        tenths(mean - F.lit(85)).alias("minimum_temperature_f"),
        tenths(mean + F.lit(97)).alias("maximum_temperature_f"),
        tenths((nk * F.lit(5) + n * F.lit(11)) % F.lit(700)).alias(
            "average_relative_humidity_pct"
        ),
        tenths((nk + n * F.lit(3)) % F.lit(200)).alias("average_wind_speed_mps"),
    )
    return rollup.with_degree_days(climate)


def day_buckets(spark: SparkSession, sf_dir: str) -> int:
    """Buckets for the days of ``daily_long``, by the number of line items."""
    rows = table(spark, sf_dir, "lineitem").count()
    return max(spark.sparkContext.defaultParallelism, -(-rows // BUCKET_ROWS))


def _suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("building_id"),
            "s_nationkey",
            "s_acctbal",
            F.col("r_name").alias("state"),
            F.col("n_name").alias("county_code"),
            F.concat(F.lit("Station "), F.col("s_nationkey").cast("string")).alias(
                "weather_city"
            ),
        )
    )


def monthly_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.monthly_rollup(daily_long(spark, sf_dir), 2, WEATHER_DIGITS)


def supplier_buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The building dimension of ``daily_long``, with gaps in its attributes."""
    key = F.col("building_id")
    return _suppliers(spark, sf_dir).select(
        "building_id",
        "state",
        "county_code",
        F.when(key % 9 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("Type "), (key % 4).cast("string")))
        .alias("building_type"),
        F.when(key % 10 == 0, F.lit(0.0))
        .when(key % 4 == 0, key.cast("double"))
        .otherwise(F.col("s_acctbal"))
        .alias("floor_area_sqft"),
        F.when(key % 7 == 0, F.lit(""))
        .otherwise((F.lit(1950) + key % 70).cast("string"))
        .alias("construction_vintage"),
        F.when(key % 3 == 0, F.lit("Natural Gas"))
        .otherwise(F.lit("Electricity"))
        .alias("heating_fuel"),
        F.lit("Furnace").alias("heating_system"),
        F.when(key % 5 != 0, F.lit("Central AC")).alias("cooling_system"),
        "weather_city",
        (key.cast("double") * F.lit(10.5)).alias("reference_annual_electricity_kwh"),
    )


def long_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.published_accounts(
        daily_long(spark, sf_dir), supplier_buildings(spark, sf_dir), digits=2
    )


# --- account requests and file transfers from orders ---------------------------


def account_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request document per order, right and wrong ones."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("request_id"),
        F.expr(_REQUEST_JSON.format(month="date_format(o_orderdate, 'yyyy-MM')", div="div")).alias(
            "request_json"
        ),
    )


_REQUEST_JSON = """
CASE
  WHEN o_orderkey % 8 = 0 THEN '{{"operation":"list_accounts"}}'
  WHEN o_orderkey % 8 = 1 THEN
    concat('{{"operation":"account_details","account_id":"DEMO-', o_custkey {div} 12, '"}}')
  WHEN o_orderkey % 8 IN (2, 3, 4) THEN
    concat('{{"operation":"investigate_usage","account_id":"DEMO-', o_custkey {div} 12,
           '","month":"', {month}, '"}}')
  WHEN o_orderkey % 8 IN (5, 6) THEN
    concat('{{"operation":"explain_usage","account_id":"DEMO-', o_custkey {div} 12,
           '","month":"', {month}, '"}}')
  WHEN o_orderkey % 56 = 7 THEN '"list_accounts"'
  WHEN o_orderkey % 56 = 15 THEN '{{"operation":'
  WHEN o_orderkey % 56 = 23 THEN '{{"operation":"List_accounts"}}'
  WHEN o_orderkey % 56 = 31 THEN '{{"operation":"account_details"}}'
  WHEN o_orderkey % 56 = 39 THEN '{{"operation":"account_details","account_id":""}}'
  WHEN o_orderkey % 56 = 47 THEN '{{"operation":"investigate_usage","account_id":true,"month":"1996-01"}}'
  ELSE '{{"operation":"investigate_usage","account_id":"DEMO-1","month":"1996-00"}}'
END
"""


def transfer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transfer record per order: its status decides the outcome of the run."""
    moved = F.col("o_orderstatus") == "F"
    key, size = F.col("o_orderkey"), F.round(F.col("o_totalprice")).cast("bigint")
    name = F.concat(F.lit("meter-"), key.cast("string"), F.lit(".parquet"))
    return table(spark, sf_dir, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("run_timestamp_utc"),
        F.col("o_orderdate").cast("date").alias("run_date"),
        F.when(moved, F.lit("SUCCESS"))
        .when(F.col("o_orderstatus") == "O", F.lit("NO_DATA"))
        .otherwise(F.lit("FAILED"))
        .alias("status"),
        F.when(moved, name).alias("filename"),
        F.when(moved, size).alias("source_size_bytes"),
        F.when(moved, size).alias("landing_size_bytes"),
        F.when(moved, F.when(key % 50 == 0, size + 1).otherwise(size)).alias("archive_size_bytes"),
        F.when(moved, key % 5 == 0).alias("landing_reused"),
        F.when(moved, key % 11 == 0).alias("archive_reused"),
        F.when(F.col("o_orderstatus") != "P", moved.cast("bigint")).alias("files_transferred"),
    )


def file_area(spark: SparkSession, sf_dir: str, area: str) -> DataFrame:
    """Listing (key, size) of one file area: a file per order."""
    key = F.col("o_orderkey")
    size = F.round(F.col("o_totalprice")).cast("bigint")
    name = F.concat(F.lit("meter-"), key.cast("string"), F.lit(".parquet"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    orders = table(spark, sf_dir, "orders")
    if area == "incoming":
        return orders.filter(key % 3 != 0).select(
            F.concat(F.lit("incoming/"), name).alias("key"), size.alias("size_bytes")
        )
    if area == "landing":
        # Some files were landed on two dates; the first by key counts.
        copies = F.when(key % 13 == 0, F.array(F.lit(""), F.lit("b"))).otherwise(F.array(F.lit("")))
        return (
            orders.filter(key % 5 != 0)
            .select(
                name.alias("name"),
                day.alias("day"),
                size.alias("size"),
                F.posexplode(copies).alias("copy", "suffix"),
            )
            .select(
                F.concat(
                    F.lit("landing/ingest_date="), "day", "suffix", F.lit("/"), "name"
                ).alias("key"),
                (F.col("size") + F.col("copy")).alias("size_bytes"),
            )
        )
    return orders.filter(key % 7 != 0).select(
        F.concat(F.lit("archive/processed_date="), day, F.lit("/"), name).alias("key"),
        F.when(key % 50 == 1, size + 1).otherwise(size).alias("size_bytes"),
    )


def invoice_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items by (order, line number): a table with many repeated keys."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("bldg_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_extendedprice").alias("amount"),
    )


def stored(build, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bound table written once to the shared folder, for queries that read it
    several times."""
    return stage(build(spark, sf_dir), build.__name__.replace("_", "-"))


def new_table(label: str) -> str:
    """Name of a table of its own in the session catalog, for one run of a query."""
    return f"{label}_{uuid.uuid4().hex}"


#: Measures that a day and a month of a building share.
NESTED = [f.name for f in schemas.DAILY.fields if f.dataType.simpleString() == "double"]


def nested_elements(nested: DataFrame, *keys: str) -> DataFrame:
    """The elements of nested usage as rows: level, place (from 1), period, rows below it
    and measures."""
    levels = {"daily_usage": ("day", "usage_date", "hours_present"), "monthly_usage": ("month", "usage_month", "days_present")}
    parts = []
    for array, (level, period, present) in levels.items():
        elements = nested.select(*keys, F.posexplode(array).alias("_at", "_e"))
        parts.append(
            elements.select(
                *keys,
                (F.col("_at") + 1).cast("bigint").alias("place"),
                F.lit(level).alias("level"),
                F.col(f"_e.{period}").cast("date").alias("period"),
                F.col(f"_e.{present}").alias("present"),
                *[F.col(f"_e.{m}").alias(m) for m in NESTED],
            )
        )
    return parts[0].unionByName(parts[1])
