"""Month-over-month comparison on hand-made months."""

from datetime import datetime

import pytest

from wattloom import schemas
from wattloom.operators import compare, display, gates


def month(building, year, number, total, daily, cooling, heating, hot, mean=60.0, cdd=0.0, hdd=0.0):
    return (
        building, "AL", "G0101130", "Fort Benning", datetime(year, number, 1), 30,
        daily, total, total, cooling, heating, hot, 4.0, mean, mean - 9, mean + 9, cdd, hdd, 50.0, 3.0,
    )


@pytest.fixture(scope="module")
def months(spark):
    rows = [
        month(1, 2018, 4, 258.51, 8.617, 10.0, 20.0, 38.0, 61.95714999999999, 31.355250000000026, 122.64075),
        month(1, 2018, 5, 584.687, 18.860870967741935, 332.692, 20.0, 37.215, 74.12014516129032, 282.7245, 0.0),
        # The month of June is missing.
        month(1, 2018, 7, 594.687, 19.0, 347.192, 20.0, 36.015),
        month(2, 2018, 1, 0.0, 0.0, 0.0, 0.0, 0.0),
        month(2, 2018, 2, 0.0, 1.0, 5.0, 0.0, 0.0),
    ]
    layout = [f for f in schemas.MONTHLY.fields if f.name != "account_id"]
    return spark.createDataFrame(rows, schemas.T.StructType(layout))


@pytest.fixture(scope="module")
def result(months):
    rows = compare.investigation(months).collect()
    return {(r.building_id, r.usage_month.month): r for r in rows}


def test_worked_example(result):
    may = result[1, 5]
    assert may.previous_month == datetime(2018, 4, 1)
    assert may.electricity_change_kwh == pytest.approx(326.177, abs=1e-3)
    assert may.daily_usage_change_pct == pytest.approx(118.8797837733, abs=1e-9)
    assert may.cooling_change_kwh == pytest.approx(322.692, abs=1e-3)
    assert may.heating_change_kwh == 0.0
    assert may.hot_water_change_kwh == pytest.approx(-0.785, abs=1e-3)
    assert may.other_electricity_change_kwh == pytest.approx(4.27, abs=1e-3)
    assert may.cooling_share_of_net_change_pct == pytest.approx(98.9315616981, abs=1e-9)
    assert may.average_temperature_change_f == pytest.approx(12.162995161290333)
    assert may.cooling_degree_days_change_65 == pytest.approx(251.36924999999997)
    assert may.heating_degree_days_change_65 == pytest.approx(-122.64075)


def test_first_month_has_no_comparison(result):
    april = result[1, 4].asDict()
    for name in ["previous_month", *[f"previous_{m}" for m in schemas.LAGGED], *schemas.DERIVED]:
        assert april[name] is None


def test_comparison_spans_a_missing_month(result):
    assert result[1, 7].previous_month == datetime(2018, 5, 1)


def test_shares_are_not_clamped(result):
    assert result[1, 7].cooling_share_of_net_change_pct == pytest.approx(145.0)


def test_zero_predecessor_gives_null_ratios(result):
    assert result[2, 2].daily_usage_change_pct is None
    assert result[2, 2].cooling_share_of_net_change_pct is None
    assert result[2, 2].electricity_change_kwh == 0.0


def test_columns_and_their_order(months):
    assert compare.investigation(months).columns == schemas.INVESTIGATION_COLUMNS
    assert len(schemas.INVESTIGATION_COLUMNS) == 34


def test_all_lags_share_one_window(months):
    plan = compare.investigation(months)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 1


def test_first_period_check_fires_on_a_broken_row(months):
    good = compare.investigation(months)
    assert compare.first_period_violations(good).isEmpty()
    broken = good.withColumn("previous_electricity_kwh", display.F.lit(1.0))
    assert {r.building_id for r in compare.first_period_violations(broken).collect()} == {1, 2}


def test_changes_by_end_use_add_up(months):
    rows = display.end_use_changes(compare.investigation(months)).collect()
    parts = [r.change_kwh for r in rows if r.building_id == 1 and r.usage_month.month == 5]
    assert len(parts) == 4 and sum(parts) == pytest.approx(326.177)


def test_default_period(months):
    def chosen(preferred=None):
        rows = display.default_period(months, "usage_month", preferred).collect()
        return {r.building_id: r.default_month for r in rows}

    assert chosen() == {1: "2018-05", 2: "2018-02"}
    assert chosen({1: "2018-07", 2: "2017-01"}) == {1: "2018-07", 2: "2018-02"}


def test_tolerance_report(months):
    shifted = months.withColumn("electricity_kwh", display.F.col("electricity_kwh") + 0.0005)
    keys = ["building_id", "usage_month"]
    near = gates.compare_tolerance(months, shifted, keys, {"electricity_kwh": 0.001})
    far = gates.compare_tolerance(months, shifted, keys, {"electricity_kwh": 0.0001})
    assert {r.within for r in near.collect()} == {True}
    assert {r.within for r in far.collect()} == {False}
    missing = gates.compare_tolerance(months, shifted.filter("building_id = 1"), keys, {"electricity_kwh": 1.0})
    assert sorted(r.within for r in missing.collect()) == [False, False, True, True, True]
