"""Report tables: periods to choose from, series, end-use compositions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.functions import periods, text

RESIDUAL_EPSILON = 0.01

# The end-use categories of a change report, in display order.
CHANGE_CATEGORIES = {
    "Cooling": "cooling_change_kwh",
    "Heating": "heating_change_kwh",
    "Hot water": "hot_water_change_kwh",
    "Other (derived)": "other_electricity_change_kwh",
}


def list_periods(df: DataFrame, period: str) -> DataFrame:
    """Months present for each building, sorted."""
    return (
        df.select("building_id", periods.month_key(period).alias("month"))
        .distinct()
        .orderBy("building_id", "month")
    )


def default_period(
    df: DataFrame, period: str, preferred: dict[int, str] | None = None
) -> DataFrame:
    """Month to open for each building.

    The preferred month where the building has it, else its second month (the
    first with a predecessor), else its only one. The set of a building's months is
    gathered in one aggregation; the calendar bounds it.
    """
    months = df.groupBy("building_id").agg(
        F.array_sort(F.collect_set(periods.month_key(period))).alias("months")
    )
    wishes = df.sparkSession.createDataFrame(
        list((preferred or {}).items()), "building_id bigint, wanted string"
    )
    wished = F.when(F.array_contains("months", F.col("wanted")), F.col("wanted"))
    return months.join(wishes, "building_id", "left").select(
        "building_id",
        F.coalesce(wished, F.get("months", F.lit(1)), F.get("months", F.lit(0))).alias("default_month"),
    )


def monthly_series(monthly: DataFrame) -> DataFrame:
    """Month label and use of each building in month order."""
    return monthly.orderBy("building_id", "usage_month").select(
        "building_id",
        periods.month_key("usage_month").alias("month_key"),
        periods.month_label("usage_month").alias("month"),
        "electricity_kwh",
    )


def daily_series(daily: DataFrame, month: str | None = None) -> DataFrame:
    """Day and use of each building in date order, for one month or all.

    A month is a date range, so the filter reaches the scan.
    """
    if month is not None:
        start = F.lit(f"{month}-01").cast("date")
        daily = daily.filter(
            (F.col("usage_date") >= start) & (F.col("usage_date") < F.add_months(start, 1))
        )
    return daily.orderBy("building_id", "usage_date").select(
        "building_id", periods.date_key("usage_date").alias("date"), "electricity_kwh"
    )


def positive_zero(value: str | Column) -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return F.when(value == F.lit(0.0), F.lit(0.0)).otherwise(value)


def end_use_composition(monthly: DataFrame) -> DataFrame:
    """Use by end use and month; a residual below a hundredth shows as zero."""
    other = (
        F.col("electricity_kwh")
        - F.col("cooling_system_kwh")
        - F.col("heating_system_kwh")
        - F.col("hot_water_kwh")
    )
    shown = F.when(F.abs(other) < F.lit(RESIDUAL_EPSILON), F.lit(0.0)).otherwise(other)
    return monthly.select(
        "building_id",
        periods.month_key("usage_month").alias("month_key"),
        periods.month_label("usage_month").alias("month"),
        positive_zero("cooling_system_kwh").alias("cooling"),
        positive_zero("heating_system_kwh").alias("heating"),
        positive_zero("hot_water_kwh").alias("hot_water"),
        positive_zero(shown).alias("other"),
    )


def end_use_changes(comparison: DataFrame) -> DataFrame:
    """Comparison rows as one row per end-use category."""
    columns = [F.col(source).alias(name) for name, source in CHANGE_CATEGORIES.items()]
    return comparison.select("building_id", "usage_month", *columns).unpivot(
        ["building_id", "usage_month"], list(CHANGE_CATEGORIES), "category", "change_kwh"
    )


def formatted_comparison(comparison: DataFrame) -> DataFrame:
    """The texts a reader sees for one comparison row."""
    return comparison.select(
        "building_id",
        periods.month_key("usage_month").alias("month_key"),
        text.energy("electricity_kwh").alias("electricity"),
        text.signed("electricity_change_kwh").alias("electricity_change"),
        text.percent("daily_usage_change_pct").alias("daily_change"),
        text.percent("cooling_share_of_net_change_pct").alias("cooling_share"),
        text.number("other_electricity_change_kwh").alias("other_change"),
        text.temperature("average_temperature_f").alias("temperature"),
        text.temperature_change("average_temperature_change_f").alias("temperature_change"),
        text.degree_days("cooling_degree_days_65").alias("cooling_degree_days"),
        text.degree_days_change("heating_degree_days_change_65").alias(
            "heating_degree_days_change"
        ),
    )


def building_labels(accounts: DataFrame) -> DataFrame:
    """Attribute texts of each building."""
    return accounts.select(
        "building_id",
        text.label("building_type").alias("building_type"),
        text.floor_area("floor_area_sqft").alias("floor_area"),
        text.label("construction_vintage").alias("construction_vintage"),
        text.label("heating_fuel").alias("heating_fuel"),
        text.label("heating_system").alias("heating_system"),
        text.label("cooling_system").alias("cooling_system"),
        text.label("state").alias("state"),
        text.label("county_code").alias("county_code"),
    )
