"""Conforming, roll-ups, gates, upserts and the layered flow on small tables."""

import os
import uuid
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattloom import schemas
from wattloom.operators import conform, gates, publish, rollup, upsert
from wattloom.plans import bindings, medallion
from wattloom.sources.lookups import weather_locations

SOURCES = list(schemas.READING_MEASURES.values())


def readings(spark, days=2, buildings=(1, 2), start=datetime(2018, 1, 1)):
    rows = []
    for building in buildings:
        for i in range(1, days * 96 + 1):
            stamp = start + timedelta(minutes=15 * i)
            values = [building * 0.1 + (i % 7) * 0.001 * (k + 1) for k in range(len(SOURCES))]
            rows.append((building, stamp, *values, date(2018, 1, 3), None))
    schema = schemas.readings_schema().add("_rescued_data", "string")
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def bronze(spark):
    return readings(spark).cache()


@pytest.fixture(scope="module")
def metadata(spark):
    names = ["bldg_id", "upgrade", *[src for src, _ in list(schemas.BUILDING_ATTRIBUTES.values())[1:]]]
    rows = [
        (1, 0, "AL", "G0101130", "Single-Family", "885", "1990s", "Gas", "Furnace", "AC", "5376.9"),
        (1, 1, "AL", "G0101130", "Other scenario", "885", "1990s", "Gas", "Furnace", "AC", "1.0"),
        (2, 0, "AL", "G0101270", "Mobile Home", "n/a", "", "Electricity", "Heat pump", "AC", "100"),
        (3, 0, "AL", "G0101270", "Never metered", "1", "", "Gas", "Furnace", "AC", "100"),
    ]
    kinds = ", ".join(
        f"`{n}` {'bigint' if n == 'bldg_id' else 'int' if n == 'upgrade' else 'string'}" for n in names
    )
    return spark.createDataFrame(rows, kinds)


@pytest.fixture(scope="module")
def weather(spark):
    rows = [
        (county, datetime(2018, 1, 1) + timedelta(hours=h), 10.0 + h % 24, *[1.0] * 6, "w.csv")
        for county in ("G0101130", "G0101270")
        for h in range(1, 24 * 62 + 1)
    ]
    measures = ", ".join(f"{m} double" for m in schemas.WEATHER_MEASURES)
    return spark.createDataFrame(
        rows,
        f"county_code string, weather_timestamp timestamp_ntz, temperature_c double, {measures}, source_file string",
    ).cache()


@pytest.fixture(scope="module")
def buildings(spark, bronze, metadata):
    return conform.onboarding_candidates(bronze, metadata, weather_locations(spark)).cache()


def test_onboarding_keeps_arrived_baseline_buildings(buildings):
    rows = {r.building_id: r for r in buildings.collect()}
    assert set(rows) == {1, 2}
    assert rows[1].building_type == "Single-Family" and rows[1].weather_city == "Fort Benning"
    assert rows[2].floor_area_sqft is None and rows[2].weather_city == "Birmingham Muni"


def test_baseline_filter_reaches_the_scan(spark, metadata, tmp_path):
    path = str(tmp_path / "metadata")
    metadata.write.parquet(path)
    plan = conform.building_attributes(spark.read.parquet(path))._jdf.queryExecution().executedPlan()
    assert "EqualTo(upgrade,0)" in plan.toString()


def test_sums_survive_every_rollup(bronze, buildings, weather):
    hours = rollup.hourly_rollup(conform.project_consumption(bronze))
    days = rollup.daily_rollup(conform.enrich_hours(hours, buildings, weather))
    months = rollup.monthly_rollup(days)
    total = F.round(F.sum("electricity_kwh"), 6)
    expected = bronze.select(F.round(F.sum(f"`{SOURCES[0]}`"), 6)).first()[0]
    assert {df.select(total).first()[0] for df in (hours, days, months)} == {expected}
    assert [hours.count(), days.count(), months.count()] == [96, 4, 2]
    assert {r.hours_present for r in days.collect()} == {24}
    assert {r.days_present for r in months.collect()} == {2}


def test_one_row_per_key_takes_the_smallest_row(spark):
    df = spark.createDataFrame(
        [(1, "b", 1.0), (1, None, 9.0), (1, "a", 2.0), (2, "c", 3.0)], "id int, s string, v double"
    )
    kept = {tuple(r) for r in conform.one_row_per_key(df, ["id"]).collect()}
    assert kept == {(1, None, 9.0), (2, "c", 3.0)}


def fails(gate, text):
    with pytest.raises(gates.GateFailed, match=text):
        gate.enforce()


def test_gates_pass_on_clean_rows_and_fire_on_broken_ones(spark, bronze, buildings, weather):
    project = conform.project_consumption
    keys = ["bldg_id", "timestamp"]
    hours = rollup.hourly_rollup(project(bronze))
    located = conform.join_buildings(hours, buildings)
    days = rollup.daily_rollup(conform.join_weather(located, weather))
    for gate in (
        gates.rescued(bronze),
        gates.duplicates(bronze, keys),
        gates.hours_complete(hours),
        gates.weather_complete(located, weather),
        gates.days_complete(days),
        gates.onboarding(buildings),
    ):
        gate.enforce()

    stamp = datetime(2018, 1, 1, 5, 15)
    short = bronze.filter(F.col("timestamp") != F.lit(stamp).cast("timestamp_ntz"))
    doubled = bronze.union(bronze.limit(1))
    fails(gates.rescued(bronze.withColumn("_rescued_data", F.lit("{}"))), "rescued")
    fails(gates.duplicates(doubled, keys), "duplicate keys")
    fails(gates.hours_complete(rollup.hourly_rollup(project(short))), "incomplete hours")
    fails(gates.days_complete(days.withColumn("hours_present", F.lit(23))), "incomplete days")
    fails(gates.onboarding(buildings.withColumn("weather_city", F.lit(None))), "metadata")
    # One lost and one doubled weather row leave the row count as it was.
    lost = weather.filter(
        ~((F.col("county_code") == "G0101130") & (F.col("weather_timestamp") == F.lit("2018-01-01 05:00:00").cast("timestamp_ntz")))
    )
    balanced = lost.union(
        weather.filter((F.col("county_code") == "G0101130") & (F.col("weather_timestamp") == F.lit("2018-01-01 06:00:00").cast("timestamp_ntz")))
    )
    assert conform.join_weather(located, balanced).count() == hours.count()
    problems = {r.problem for r in gates.weather_complete(located, balanced).violations.collect()}
    assert problems == {"hour without weather", "repeated weather stamp"}


def test_audit_status_needs_a_complete_clean_file(spark, bronze):
    traced = bronze.withColumns(
        {
            "source_file_name": F.lit("a"),
            "source_file_path": F.lit("/a"),
            "source_file_size": F.lit(1).cast("bigint"),
        }
    )
    assert {r.status for r in rollup.ingest_audit(traced, 192).collect()} == {"SUCCESS"}
    assert {r.status for r in rollup.ingest_audit(traced, 193).collect()} == {"REVIEW"}
    bad = traced.withColumn("_rescued_data", F.when(F.col("bldg_id") == 1, F.lit("{}")))
    statuses = {r.bldg_id: r.status for r in rollup.ingest_audit(bad, 192).collect()}
    assert statuses == {1: "REVIEW", 2: "SUCCESS"}


@pytest.fixture
def table():
    return f"t_{uuid.uuid4().hex}"


def table_rows(spark, table):
    return sorted(tuple(r) for r in upsert.read_table(spark, table).select("k", "day", "v").collect())


def by_month(spark, *rows, kinds="k int, day date, v int"):
    return spark.createDataFrame(rows, kinds).withColumn("part_month", F.trunc("day", "month"))


JAN, FEB = date(2018, 1, 5), date(2018, 2, 5)


def test_upsert_updates_inserts_and_leaves_other_partitions_alone(spark, tmp_path, table):
    root, keys = str(tmp_path), ["k", "day"]
    first = upsert.upsert(by_month(spark, (1, JAN, 1), (2, JAN, 2), (1, FEB, 3)), table, keys, root, "part_month")
    change = by_month(spark, (1, FEB, 30), (9, FEB, 9))
    for _ in range(2):  # the second time changes nothing
        upsert.upsert(change, table, keys, root, "part_month")
        assert table_rows(spark, table) == [(1, JAN, 1), (1, FEB, 30), (2, JAN, 2), (9, FEB, 9)]
    read = {os.path.dirname(f) for f in upsert.read_table(spark, table).inputFiles()}
    assert len(read) == 2 and any(f.endswith(f"{first}/part_month=2018-01-01") for f in read)


@pytest.mark.parametrize("partition_by", [None, "part_month"])
@pytest.mark.parametrize("step", ["_write", "_switch", "add_columns", "merge_rows"])
def test_a_failed_upsert_leaves_the_old_rows(spark, tmp_path, monkeypatch, step, partition_by, table):
    root, keys = str(tmp_path), ["k", "day"]

    def batch(ids, v):
        return by_month(spark, *[(k, date(2018, 1 + k % 3, 5), v) for k in ids])

    upsert.upsert(batch(range(100), 0), table, keys, root, partition_by)
    before = table_rows(spark, table)

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(upsert, step, broken)
        with pytest.raises(RuntimeError, match="lost"):
            upsert.upsert(batch(range(95, 105), 1), table, keys, root, partition_by)
    assert table_rows(spark, table) == before
    upsert.upsert(batch(range(95, 105), 1), table, keys, root, partition_by)
    rows = table_rows(spark, table)
    assert len(rows) == 105 and sum(v for _, _, v in rows) == 10


@pytest.mark.parametrize("partition_by", [None, "part_month"])
def test_columns_of_a_table_only_grow(spark, tmp_path, partition_by, table):
    root, keys = str(tmp_path), ["k", "day"]
    wide = "k int, day date, v int, tariff int"
    upsert.upsert(by_month(spark, (1, JAN, 1, 9), (2, JAN, 2, 8), kinds=wide), table, keys, root, partition_by)
    # Without the column: its values stay, in matched rows too.
    upsert.upsert(by_month(spark, (2, JAN, 20), (3, JAN, 3)), table, keys, root, partition_by)
    # With another column, and a type that the table casts.
    other = "k int, day date, v long, note string"
    upsert.upsert(by_month(spark, (3, JAN, 30, "n"), (4, FEB, 4, "m"), kinds=other), table, keys, root, partition_by)
    rows = upsert.read_table(spark, table).select("k", "v", "tariff", "note")
    assert sorted(map(tuple, rows.collect())) == [(1, 1, 9, None), (2, 20, 8, None), (3, 30, None, "n"), (4, 4, None, "m")]
    assert rows.schema["v"].dataType.simpleString() == "int"


@pytest.mark.parametrize("partition_by", [None, "part_month"])
def test_a_reader_outlasts_later_upserts(spark, tmp_path, partition_by, table):
    root, keys = str(tmp_path), ["k", "day"]
    upsert.upsert(by_month(spark, (1, JAN, 0), (1, FEB, 0)), table, keys, root, partition_by)
    held = upsert.read_table(spark, table).select("k", "day", "v")
    files = [f.removeprefix("file:") for f in held.inputFiles()]
    for v in (1, 2, 3):
        upsert.upsert(by_month(spark, (1, JAN, v), (2, FEB, v)), table, keys, root, partition_by)
    assert all(os.path.exists(f) for f in files)
    # A reader that has not started reads what the catalog names when it does: of a table
    # with partitions the newest rows, of one without those it was taken with.
    newest = [(1, JAN, 3), (1, FEB, 0), (2, FEB, 3)]
    assert sorted(map(tuple, held.collect())) == (newest if partition_by else [(1, JAN, 0), (1, FEB, 0)])


def test_rows_without_a_month(spark, tmp_path, table):
    rows = by_month(spark, (1, None, 1), (2, JAN, 2))
    upsert.upsert(rows, table, ["k"], str(tmp_path), "part_month")
    upsert.upsert(by_month(spark, (1, None, 5)), table, ["k"], str(tmp_path), "part_month")
    assert {tuple(r) for r in upsert.read_table(spark, table).select("k", "v").collect()} == {(1, 5), (2, 2)}


def test_upsert_refuses_a_source_key_that_occurs_twice(spark, tmp_path, table):
    df = spark.createDataFrame([(1, 1), (1, 2)], "k int, v int")
    with pytest.raises(gates.GateFailed, match="occur twice"):
        upsert.upsert(df, table, ["k"], str(tmp_path / "t"))
    assert upsert.read_table(spark, table) is None


def test_staged_rows_are_checked_as_they_are_written(spark):
    df = spark.range(10).toDF("interval_count")
    jobs = spark.sparkContext.statusTracker()
    with upsert.Staging(spark) as stage:
        kept = stage(df.filter("interval_count = 4"), "kept", gates.whole_hours())
        assert kept.count() == 1
        spark.sparkContext.setJobGroup("staged", "staged")
        with pytest.raises(gates.GateFailed, match="incomplete hours: 9 rows"):
            stage(df, "broken", gates.whole_hours())
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert len(jobs.getJobIdsForGroup("staged")) == 1
        paths = list(stage.paths)
    assert len(paths) == 2 and not any(os.path.exists(p) for p in paths)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory, bronze, metadata, weather):
    tables = medallion.Tables(str(tmp_path_factory.mktemp("layers")), f"layers_{uuid.uuid4().hex}")
    medallion.refresh_buildings(tables, bronze, metadata, weather_locations(spark))
    medallion.refresh_silver(tables, bronze, weather)
    medallion.refresh_gold(tables, spark)
    return tables


def test_layered_flow_counts(spark, built, bronze):
    counts = rollup.layer_counts(medallion.layers(built, spark, bronze))
    expected = dict.fromkeys(gates.YEAR_EXPECTATION, 1) | {
        "bronze": 192, "silver_15min": 192, "silver_hourly": 48, "gold_daily": 2,
    }
    arrived = conform.arrived_buildings(bronze)
    gates.layers_complete(counts, arrived, expected).enforce()
    fails(gates.layers_complete(counts, arrived, expected | {"gold_daily": 3}), "layer counts")


def test_whole_flow_stops_at_a_wrong_layer(spark, bronze, metadata, weather, tmp_path):
    tables = medallion.Tables(str(tmp_path / "flow"), f"flow_{uuid.uuid4().hex}")
    traced = bronze.withColumns(
        {"source_file_name": F.lit("a"), "source_file_path": F.lit("/a"), "source_file_size": F.lit(1)}
    )
    expected = dict.fromkeys(gates.YEAR_EXPECTATION, 1) | {
        "bronze": 192, "silver_15min": 192, "silver_hourly": 48, "gold_daily": 2,
    }
    inputs = (tables, traced, metadata, weather_locations(spark), weather)
    with pytest.raises(gates.GateFailed, match="layer counts"):
        medallion.refresh(*inputs, per_building=expected | {"gold_daily": 3})
    assert not (tmp_path / "flow" / "snapshots").exists()
    published = medallion.refresh(*inputs, per_building=expected)
    assert publish.read_metadata(spark, tables.path("snapshots")).first().snapshot_id == published
    assert {r.status for r in tables.read(spark, "ingest_audit").collect()} == {"SUCCESS"}


def test_account_view_follows_the_tables(spark, built, bronze):
    view = built.name("account_summary")
    expected = publish.account_summary(built.read(spark, "daily_energy_weather"), built.read(spark, "buildings"))
    assert spark.table(view).columns == expected.columns
    assert spark.catalog.getTable(view).tableType == "VIEW"
    assert sorted(map(tuple, spark.table(view).collect())) == sorted(map(tuple, expected.collect()))
    days = built.read(spark, "daily_energy_weather")
    before = {r.building_id: r.annual_electricity_kwh for r in spark.table(view).collect()}
    more = days.filter("building_id = 1").limit(1).withColumn("electricity_kwh", F.col("electricity_kwh") + 100.0)
    built.upsert(more, "daily_energy_weather", ["building_id", "usage_date"], "usage_date")
    after = {r.building_id: r.annual_electricity_kwh for r in spark.table(view).collect()}
    assert round(after[1] - before[1], 6) == 100.0 and after[2] == before[2]
    less = more.withColumn("electricity_kwh", F.col("electricity_kwh") - 100.0)
    built.upsert(less, "daily_energy_weather", ["building_id", "usage_date"], "usage_date")


def test_later_months_refresh_only_themselves(spark, built, bronze, weather):
    # The last hour of January is stamped on 1 February.
    newer = bronze.unionByName(readings(spark, 2, start=datetime(2018, 2, 1)))
    since = date(2018, 2, 1)
    before = built.read(spark, "consumption").count()
    medallion.refresh_silver(built, newer, weather, since)
    medallion.refresh_gold(built, spark, since)
    assert built.read(spark, "consumption").count() == before + 2 * 192
    months = built.read(spark, "usage_investigation_weather")
    got = {(r.building_id, r.usage_month.month): r.previous_month for r in months.collect()}
    assert got == {
        (1, 1): None, (1, 2): datetime(2018, 1, 1), (2, 1): None, (2, 2): datetime(2018, 1, 1),
    }


def test_since_within_a_month_keeps_the_month_whole(spark, built):
    before = {(r.building_id, r.usage_month): r.days_present for r in built.read(spark, "monthly_energy_weather").collect()}
    changes = sorted(map(str, built.read(spark, "usage_investigation_weather").collect()))
    medallion.refresh_gold(built, spark, date(2018, 2, 2))
    after = {(r.building_id, r.usage_month): r.days_present for r in built.read(spark, "monthly_energy_weather").collect()}
    assert after == before
    assert sorted(map(str, built.read(spark, "usage_investigation_weather").collect())) == changes


def test_since_reads_only_its_months(spark, built):
    plan = built.read(spark, "energy_weather_hourly", date(2018, 2, 2))._jdf.queryExecution().executedPlan().toString()
    assert "part_month" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_failed_gate_leaves_the_tables_alone(spark, built, bronze, weather):
    before = built.read(spark, "consumption_hourly").count()
    partial = bronze.filter(F.minute("timestamp") != 15)
    with pytest.raises(gates.GateFailed):
        medallion.refresh_silver(built, partial, weather)
    assert built.read(spark, "consumption_hourly").count() == before


def test_published_snapshot_is_visible_only_when_whole(spark, built, weather, tmp_path):
    first = medallion.publish_current(built, spark, weather)
    root = built.path("snapshots")
    snapshot = publish.read_snapshot(spark, root)
    assert snapshot["metadata"].first().weather_alignment_verified is True
    assert snapshot["accounts"].count() == 2
    # Datasets of a later snapshot without metadata are not served.
    snapshot["accounts"].write.json(f"{root}/accounts/snapshot_id=99990101T000000000000")
    assert publish.read_metadata(spark, root).first().snapshot_id == first


def test_publish_refuses_repeated_keys(spark, built, tmp_path):
    accounts = medallion.accounts(built, spark)
    monthly = built.read(spark, "monthly_energy_weather")
    with pytest.raises(gates.GateFailed, match="duplicate keys"):
        publish.publish_snapshot(
            str(tmp_path / "s"),
            accounts,
            built.read(spark, "daily_energy_weather"),
            monthly.union(monthly),
            built.read(spark, "usage_investigation_weather"),
            accounts.limit(0),
        )
    assert not (tmp_path / "s" / "metadata").exists()
    assert not list((tmp_path / "s").glob("*/snapshot_id=*"))


def test_stale_answers_are_found(spark):
    metadata = spark.createDataFrame([("s1", "t1")], "snapshot_id string, created_at_utc string")
    served = spark.createDataFrame(
        [(1, "s1", "t1"), (2, "s1", "t0"), (3, "s0", "t1")],
        "n int, snapshot_id string, created_at_utc string",
    )
    assert {r.n for r in gates.not_current(served, metadata).violations.collect()} == {2, 3}


def test_bindings_cover_every_quarter_hour(spark, sf_dir):
    dense = bindings.meter_15min(spark, sf_dir)
    per_building = {r["count"] for r in dense.groupBy("bldg_id").count().collect()}
    assert per_building == {2880}
