"""Column functions on hand-made values."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from wattloom.functions import measures, periods, text


def one(spark, value, kind, expression):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expression(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize(
    "stamp, hour, day",
    [
        (datetime(2018, 5, 1, 0, 15), datetime(2018, 5, 1, 1), date(2018, 5, 1)),
        (datetime(2018, 5, 1, 1, 0), datetime(2018, 5, 1, 1), date(2018, 5, 1)),
        (datetime(2018, 5, 1, 1, 0, 0, 500), datetime(2018, 5, 1, 1), date(2018, 5, 1)),
        (datetime(2018, 5, 1, 1, 0, 1), datetime(2018, 5, 1, 2), date(2018, 5, 1)),
        (datetime(2018, 6, 1, 0, 0), datetime(2018, 6, 1, 0), date(2018, 5, 31)),
        (datetime(2019, 1, 1, 0, 0), datetime(2019, 1, 1, 0), date(2018, 12, 31)),
    ],
)
def test_hour_ending_and_usage_date(spark, stamp, hour, day):
    assert one(spark, stamp, "timestamp_ntz", periods.hour_ending) == hour
    assert one(spark, stamp, "timestamp_ntz", periods.usage_date) == day


def test_periods_ignore_the_session_time_zone(spark):
    # 02:30 does not exist on this day in New York.
    stamp = datetime(2018, 3, 11, 2, 30)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert one(spark, stamp, "timestamp_ntz", periods.hour_ending) == datetime(2018, 3, 11, 3)
        assert one(spark, stamp, "timestamp_ntz", periods.month_key) == "2018-03"
        assert one(spark, date(2018, 3, 11), "date", periods.usage_month) == datetime(2018, 3, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_month_label(spark):
    assert one(spark, datetime(2018, 5, 1), "timestamp_ntz", periods.month_label) == "May 2018"


@pytest.mark.parametrize("mean, cooling, heating", [(70.0, 5.0, 0.0), (60.0, 0.0, 5.0), (None, 0.0, 0.0)])
def test_degree_days(spark, mean, cooling, heating):
    assert one(spark, mean, "double", measures.cooling_degree_days) == cooling
    assert one(spark, mean, "double", measures.heating_degree_days) == heating


def test_ratio_is_null_for_null_or_zero_and_never_clamped(spark):
    rows = spark.createDataFrame(
        [(14.5, 10.0), (-8.0, 40.0), (1.0, 0.0), (1.0, None), (None, 2.0)], "a double, b double"
    )
    got = [r[0] for r in rows.select(measures.ratio_pct(F.col("a"), "b")).collect()]
    assert got == [145.0, -20.0, None, None, None]


def test_exact_sum_does_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e6, -1e6, 0.007] * 50
    sums = set()
    for n in (1, 3, 7):
        df = spark.createDataFrame([(v,) for v in values], "x double").repartition(n)
        sums.add(df.select(measures.exact_sum("x", 6)).first()[0])
    assert sums == {30.35}


def test_sums_keep_tiny_values_and_nan(spark):
    tiny = spark.createDataFrame([(4e-7,)] * 1000, "x double")
    assert abs(tiny.select(measures.exact_sum("x")).first()[0] - 4e-4) < 1e-12
    nan = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert str(nan.select(measures.exact_sum("x")).first()[0]) == "nan"


def test_exact_avg_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert df.select(measures.exact_avg("x"), measures.exact_sum("x")).first() == (None, None)


@pytest.mark.parametrize(
    "value, plain, signed, percent",
    [
        (None, "Not available", "Not available", "Not available"),
        (float("nan"), "Not available", "Not available", "Not available"),
        (float("inf"), "Not available", "Not available", "Not available"),
        (0.0, "0.00", "0.00", "0.00%"),
        (-0.0, "0.00", "0.00", "0.00%"),
        (145.0, "145.00", "+145.00", "+145.00%"),
        (-20.0, "-20.00", "−20.00", "−20.00%"),
        (1.005, "1.00", "+1.00", "+1.00%"),
        (0.125, "0.13", "+0.13", "+0.13%"),
        (1234567.891, "1234567.89", "+1234567.89", "+1234567.89%"),
    ],
)
def test_number_texts(spark, value, plain, signed, percent):
    assert one(spark, value, "double", text.number) == plain
    assert one(spark, value, "double", text.signed) == signed
    assert one(spark, value, "double", text.percent) == percent


@pytest.mark.parametrize(
    "form, value, shown",
    [
        (text.temperature, 74.12014516129032, "74.1 °F"),
        (text.temperature_change, 12.162995161290333, "+12.2 °F"),
        (text.degree_days, 282.7245, "282.7"),
        (text.degree_days, 0.0, "0.0"),
        (text.degree_days_change, 251.36924999999997, "+251.4"),
        (text.degree_days_change, -122.64075, "−122.6"),
        (text.temperature, None, "Not available"),
        (text.degree_days_change, None, "Not available"),
        (text.energy, 584.687, "584.69 kWh"),
        (text.demand, 4.12, "4.12 kW"),
        (text.floor_area, 885.0, "885 sq ft"),
        (text.floor_area, 0.0, "Not available"),
    ],
)
def test_unit_texts(spark, form, value, shown):
    assert one(spark, value, "double", form) == shown


@pytest.mark.parametrize("value, shown", [(None, "Not available"), ("", "Not available"), ("1990s", "1990s")])
def test_labels(spark, value, shown):
    assert one(spark, value, "string", text.label) == shown


def test_fixed_rounds_like_the_binary_value(spark):
    for value in (0.125, 0.375, 1.005, 2.675, 258.51000000000005, 1e15 + 0.5):
        assert one(spark, value, "double", text.fixed) == f"{value:.2f}"
