"""What must not grow faster than the input: shuffles of expanded rows, memory of a task."""

import importlib
import uuid
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import oracle
from test_plans import plan
from wattloom.functions.measures import WEATHER_DIGITS
from wattloom.operators import publish, requests, rollup
from wattloom.plans import bindings, queries_answers, queries_sources
from wattloom.session import apply_defaults

upsert_module = importlib.import_module("wattloom.operators.upsert")


@pytest.mark.parametrize("name", ["hourly_rollup", "join_weather", "daily_rollup", "reading_to_comparison"])
def test_the_grid_of_quarter_hours_is_not_shuffled(name, spark, sf_dir):
    """Readings travel; the quarter hours between them are made behind the shuffle, and
    hours, days and months are built where they are."""
    text = plan(driver.queries()[name](spark, sf_dir))
    above = text[: text.index("Generate posexplode(sequence(timestamp")]
    assert "Exchange hashpartitioning" not in above


def test_grid_of_odd_readings(spark, tmp_path):
    """Readings on midnights, several in a quarter, of no building, and without a stamp."""
    stamps = [
        (1, datetime(2024, 1, 1)), (1, datetime(2024, 1, 1, 0, 0, 1)), (1, datetime(2024, 1, 1, 0, 15)),
        (1, datetime(2024, 1, 1, 7, 20)), (1, datetime(2024, 1, 2, 23, 59, 59)), (2, datetime(2024, 1, 1)),
        (3, datetime(2024, 1, 2, 23, 45)), (4, None), (None, datetime(2024, 1, 1, 9)),
    ]
    rows = [(i, at, user, "purchase", 1.25 * i, f'{{"k":{i * 20}}}') for i, (user, at) in enumerate(stamps)]
    events = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows, events).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    con = oracle.connect(str(tmp_path))
    con.execute(f"CREATE OR REPLACE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    df = driver.queries()["hourly_rollup"](spark, str(tmp_path))
    assert oracle.difference(df, con, driver.oracle_sql()["hourly_rollup"]) is None


def test_exported_lines_are_compressed(spark, sf_dir, tmp_path):
    months = publish.with_account_id(driver.queries()["monthly_rollup"](spark, sf_dir))
    publish.export_json({"monthly_usage": months}, str(tmp_path))
    lines = publish.json_rows(months).agg(F.sum(F.octet_length("json") + 1)).first()[0]
    stored = sum(f.stat().st_size for f in tmp_path.glob("monthly_usage/part-*"))
    assert stored < lines / 4
    assert spark.read.schema(months.schema).json(f"{tmp_path}/monthly_usage").exceptAll(months).isEmpty()


def test_partitions_are_cut_below_what_fills_a_task(spark):
    """Partitions of days held 64 MB, which are more than a gigabyte in hash tables."""
    assert apply_defaults(spark).conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


def test_new_months_are_written_once(spark, sf_dir, monkeypatch):
    """Hours and days were staged, then shuffled and written again into their tables."""
    rewritten = []
    write = upsert_module._write
    monkeypatch.setattr(upsert_module, "_write", lambda rows, folder, by: (rewritten.append(folder), write(rows, folder, by)))
    counts = driver.queries()["layer_counts"](spark, sf_dir).collect()
    assert all(row["rows"] for row in counts)
    large = ("/consumption/", "/consumption_hourly/", "/energy_weather_hourly/", "/daily_energy_weather/")
    assert rewritten and not [f for f in rewritten if any(name in f for name in large)]


def test_a_table_takes_new_partitions_as_they_lie_and_merges_known_ones(spark, tmp_path):
    table, root = f"taken_{uuid.uuid4().hex}", str(tmp_path)

    def put(rows, folder):
        with upsert_module.Staging(spark) as staging:
            source = staging.by_partition(spark.createDataFrame(rows, "k int, v int, p date"), f"{root}/{folder}", "p")
            taken = upsert_module.upsert(source, table, ["k"], root, "p", staged=True, laid_out=f"{root}/{folder}")
            if taken == f"{root}/{folder}":
                staging.keep(taken)
        return taken

    may, june = date(2018, 5, 1), date(2018, 6, 1)
    assert put([(1, 1, may), (2, 1, may)], "a") == f"{root}/a"
    assert put([(3, 1, june), (4, 1, None)], "b") == f"{root}/b"
    assert put([(2, 2, may), (5, 2, None)], "c") != f"{root}/c"
    assert not (tmp_path / "c").exists()
    rows = {tuple(r) for r in upsert_module.read_table(spark, table).collect()}
    assert rows == {(1, 1, may), (2, 2, may), (3, 1, june), (4, 1, None), (5, 2, None)}


def test_layers_of_a_snapshot_are_computed_once(spark, sf_dir, monkeypatch):
    """Days were computed four times to count what had been published."""
    computed, build = [], bindings.daily_long
    monkeypatch.setattr(bindings, "daily_long", lambda *a: computed.append(a) or build(*a))
    report = driver.queries()["gate_snapshot_counts"](spark, sf_dir).collect()
    assert {r["status"] for r in report} == {"PASS"} and len(computed) == 1


def test_staged_days_of_a_building_lie_together(spark, sf_dir):
    """They were dealt by building and date, so that no month was reduced before its shuffle."""
    days = queries_sources.long_layers(spark, sf_dir)["daily_usage"]
    files = days.select("building_id", F.input_file_name().alias("file")).distinct()
    assert files.groupBy("building_id").count().agg(F.max("count")).first()[0] == 1


def test_datasets_that_lie_together_are_published_whole(spark, sf_dir, tmp_path):
    layers = queries_sources.long_layers(spark, sf_dir)
    accounts, daily, monthly, changes = layers.values()
    publish.publish_snapshot(
        str(tmp_path), accounts, daily, monthly, changes, daily.limit(0),
        accounts_per_bucket=3, together=("daily_usage", "investigations"),
    )
    stored = publish.read_snapshot(spark, str(tmp_path))
    for name, layer in (("daily_usage", daily), ("monthly_usage", monthly), ("investigations", changes)):
        rows = stored[name].drop(publish.BUCKET)
        assert rows.count() == layer.count()
        assert rows.exceptAll(publish.with_account_id(layer).select(*rows.columns)).isEmpty()


def test_days_and_months_of_a_snapshot_are_used_where_they_lie(spark, sf_dir):
    """Days were shuffled for months, for totals and for details, months for comparisons and details."""
    layers = queries_answers.snapshot(spark, sf_dir)
    days, months = layers["daily_usage"], layers["monthly_usage"]
    nested = requests.nest_usage(days, months)
    totals = rollup.account_metrics(days, 2)
    again = rollup.monthly_rollup(days, 2, WEATHER_DIGITS)
    for df in (layers["investigations"], nested, totals, again):
        assert "Exchange" not in plan(df)
    assert again.exceptAll(months.select(*again.columns)).isEmpty() and again.count() == months.count()


def test_days_lie_together_in_as_many_buckets_as_they_fill(spark, sf_dir, monkeypatch):
    items = bindings.table(spark, sf_dir, "lineitem").count()
    monkeypatch.setattr(bindings, "BUCKET_ROWS", items // 20)
    buckets = bindings.day_buckets(spark, sf_dir)
    assert 20 <= buckets <= 21
    plain = bindings.daily_long(spark, sf_dir)
    rows = upsert_module.stage_together(bindings.daily_long(spark, sf_dir, buckets), "days", "building_id", buckets)
    files = rows.select("building_id", F.input_file_name().alias("file")).distinct()
    assert files.groupBy("building_id").count().agg(F.max("count")).first()[0] == 1
    assert files.select("file").distinct().count() <= buckets
    assert rows.count() == plain.count() and rows.exceptAll(plain).isEmpty()
