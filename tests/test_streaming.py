"""File streams: ingest once, rescue misfits, keep hours current."""

import glob
import os
import uuid
from datetime import date, datetime

import pytest

from wattloom import schemas
from wattloom.operators import conform, gates, rollup, upsert
from wattloom.sources import landing as landing_files
from wattloom.streaming import ingest as streaming

TOTAL = schemas.READING_MEASURES["electricity_kwh"]


def land(spark, path, rows, total_kind="double", day="2018-01-03", extra=""):
    df = spark.createDataFrame(rows, f"bldg_id bigint, timestamp timestamp_ntz, `{TOTAL}` {total_kind}{extra}")
    df.coalesce(1).write.mode("append").parquet(f"{path}/ingest_date={day}")


@pytest.fixture
def raw(spark, tmp_path):
    """Landing folder, a fresh raw layer, and a function that ingests into it."""
    landing, table = str(tmp_path / "landing"), f"bronze_{uuid.uuid4().hex}"

    def run(**options):
        paths = [str(tmp_path / n) for n in ("bronze", "state")]
        streaming.ingest(spark, landing, table, *paths, schemas.readings_schema(), **options)
        return {r.bldg_id: r for r in streaming.read_bronze(spark, table).collect()}

    return landing, run


def stamp(minute=15):
    return datetime(2018, 1, 1, 0, minute)


def test_second_run_adds_only_new_files(spark, raw):
    landing, run = raw
    land(spark, landing, [(1, stamp(), 0.5)])
    for _ in range(2):
        assert len(run()) == 1
    land(spark, landing, [(2, stamp(), 0.7)], day="2018-01-04")
    rows = run()
    assert rows[2].ingest_date == date(2018, 1, 4)
    assert rows[1].source_file_path.endswith(rows[1].source_file_name)
    assert rows[1].source_file_size > 0 and rows[1]._rescued_data is None


def test_files_of_earlier_runs_are_not_opened(spark, raw):
    landing, run = raw
    land(spark, landing, [(1, stamp(), 0.5)])
    run()
    for file in glob.glob(f"{landing}/*/*.parquet"):
        os.remove(file)
    land(spark, landing, [(2, stamp(), 0.7)], day="2018-01-04")
    assert set(run()) == {1, 2}


def test_columns_nobody_declared(spark, raw, tmp_path):
    landing, run = raw
    land(spark, landing, [(1, stamp(), 0.5)])
    run(new_columns=True)
    land(spark, landing, [(2, stamp(), 0.7, "x")], day="2018-01-04", extra=", tariff string")
    run(new_columns=True)
    # The catalog keeps the column for files that lack it, and its type for others.
    land(spark, landing, [(3, stamp(), 0.7)], day="2018-01-05")
    land(spark, landing, [(4, stamp(), 0.7, 7)], day="2018-01-06", extra=", tariff int")
    rows = run()
    assert {k: (r.tariff, r._rescued_data) for k, r in rows.items()} == {
        1: (None, None), 2: ("x", None), 3: (None, None), 4: ("7", None)
    }
    kept = f"bronze_{uuid.uuid4().hex}"
    streaming.ingest(spark, landing, kept, str(tmp_path / "kept"), str(tmp_path / "state2"), schemas.readings_schema())
    rows = streaming.read_bronze(spark, kept).orderBy("bldg_id").collect()
    assert [r._rescued_data for r in rows] == [None, '{"tariff":"x"}', None, '{"tariff":"7"}']


def test_a_new_column_outlives_ingest_and_upsert(spark, raw, tmp_path):
    landing, run = raw
    land(spark, landing, [(1, stamp(), 0.5, "x"), (2, stamp(), 0.5, "y")], extra=", tariff string")
    run(new_columns=True)
    readings = spark.createDataFrame([(r.bldg_id, r.tariff) for r in run().values()], "building_id long, tariff string")
    table = f"readings_{uuid.uuid4().hex}"
    upsert.upsert(readings, table, ["building_id"], str(tmp_path / "t"))
    later = spark.createDataFrame([(2, 1.5), (3, 2.5)], "building_id long, electricity_kwh double")
    upsert.upsert(later, table, ["building_id"], str(tmp_path / "t"))
    rows = upsert.read_table(spark, table).orderBy("building_id").collect()
    assert [(r.tariff, r.electricity_kwh) for r in rows] == [("x", None), ("y", 1.5), (None, 2.5)]


def test_files_that_store_a_column_in_other_types(spark, raw):
    landing, run = raw
    land(spark, landing, [(1, stamp(), 0.5)])
    land(spark, landing, [(2, stamp(), "0.7"), (3, stamp(), "n/a")], "string")
    land(spark, landing, [(4, stamp(), 3)], "int", day="2018-01-04")
    land(spark, landing, [(5, stamp(), 0.25)], day="2018-01-05")
    land(spark, landing, [(6, stamp(), True)], "boolean", day="2018-01-05")
    rows = run()
    assert {k: r[TOTAL] for k, r in rows.items()} == {1: 0.5, 2: 0.7, 3: None, 4: 3.0, 5: 0.25, 6: 1.0}
    assert {k for k, r in rows.items() if r._rescued_data is not None} == {3}
    assert rows[3]._rescued_data == f'{{"{TOTAL}":"n/a"}}'


def test_files_are_grouped_by_their_types(spark, tmp_path):
    path = str(tmp_path / "landing")
    for k in range(3):
        land(spark, path, [(k, stamp(), 0.5)])
        land(spark, path, [(k, stamp(), "1")], "string")
    groups = landing_files.schema_groups(spark, sorted(glob.glob(f"{path}/*/*.parquet")), path)
    assert sorted((len(files), schema[TOTAL].dataType.simpleString()) for files, schema in groups) == [
        (3, "double"), (3, "string")
    ]


def test_an_interrupted_batch_is_written_again(spark, raw, monkeypatch):
    landing, run = raw
    land(spark, landing, [(1, stamp(), 0.5)])
    run()
    land(spark, landing, [(2, stamp(), 0.7)], day="2018-01-04")

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(streaming, "add_partitions", lost)
        with pytest.raises(Exception, match="lost"):
            run()
    assert set(run()) == {1, 2}


def test_text_readings_are_rescued_and_stop_the_flow(spark, tmp_path):
    landing, table = str(tmp_path / "landing"), f"bronze_{uuid.uuid4().hex}"
    rows = [(1, stamp(15), "0.5", None), (1, stamp(30), "n/a", None), (1, stamp(45), "Infinity", "x")]
    land(spark, landing, rows, "string", extra=", remark string")
    paths = [str(tmp_path / n) for n in ("bronze", "state")]
    streaming.ingest(spark, landing, table, *paths, schemas.readings_schema())
    bronze = streaming.read_bronze(spark, table)
    got = bronze.orderBy("timestamp").collect()
    assert [r[TOTAL] for r in got] == [0.5, None, None]
    assert [r._rescued_data for r in got] == [
        None,
        f'{{"{TOTAL}":"n/a"}}',
        f'{{"{TOTAL}":"Infinity","remark":"x"}}',
    ]
    assert gates.exists_probe(gates.rescued(bronze).violations)


@pytest.fixture
def hours(spark, tmp_path):
    landing, table = str(tmp_path / "landing"), f"hourly_{uuid.uuid4().hex}"

    def run(state="state"):
        streaming.upsert_stream(
            spark, landing, table, str(tmp_path / "hourly"), str(tmp_path / state), schemas.readings_schema()
        )
        rows = upsert.read_table(spark, table).orderBy("source_hour_end").collect()
        return [(r.source_hour_end.month, r.source_hour_end.hour, r.interval_count, round(r.electricity_kwh, 9)) for r in rows]

    return landing, run


def test_a_late_reading_corrects_its_hour(spark, hours):
    landing, run = hours
    land(spark, landing, [(1, datetime(2018, 1, 1, 0, 15), 0.1), (1, datetime(2018, 1, 1, 1, 15), 0.3)])
    assert run() == [(1, 1, 1, 0.1), (1, 2, 1, 0.3)]
    land(spark, landing, [(1, datetime(2018, 1, 1, 0, 30), 0.2)])
    assert run() == [(1, 1, 2, 0.3), (1, 2, 1, 0.3)]
    assert run() == [(1, 1, 2, 0.3), (1, 2, 1, 0.3)]


def test_a_batch_lost_between_two_months_counts_once(spark, hours, monkeypatch):
    landing, run = hours
    both = [(1, datetime(2018, 1, 1, 0, 15), 0.1), (1, datetime(2018, 2, 1, 0, 15), 0.2)]
    land(spark, landing, both)
    run()
    land(spark, landing, both)
    sql, switched = type(spark).sql, []

    def breaking(self, text, *args, **kwargs):
        if "SET LOCATION" in text:
            switched.append(text)
            if len(switched) == 2:
                raise RuntimeError("lost")
        return sql(self, text, *args, **kwargs)

    with monkeypatch.context() as patched:
        patched.setattr(type(spark), "sql", breaking)
        with pytest.raises(Exception, match="lost"):
            run()
    assert run() == [(1, 1, 2, 0.2), (2, 1, 2, 0.4)]


def test_a_second_stream_is_refused(spark, hours):
    landing, run = hours
    land(spark, landing, [(1, datetime(2018, 1, 1, 0, 15), 0.1)])
    run()
    with pytest.raises(Exception, match="another stream"):
        run("other")


def test_batches_add_up_to_the_batch_result(spark, sf_dir, tmp_path):
    from wattloom.plans import bindings

    readings = bindings.sparse_readings(spark, sf_dir)
    landing = str(tmp_path / "landing")
    readings.repartition(5).write.parquet(landing)
    table = f"hourly_{uuid.uuid4().hex}"
    paths = [str(tmp_path / n) for n in ("hourly", "state")]
    streaming.upsert_stream(spark, landing, table, *paths, schemas.readings_schema(), max_files_per_trigger=2, digits=6)
    whole = rollup.hourly_rollup(conform.project_consumption(readings), 6)
    stream = upsert.read_table(spark, table).select(*whole.columns)
    assert stream.exceptAll(whole).isEmpty() and whole.exceptAll(stream).isEmpty()
