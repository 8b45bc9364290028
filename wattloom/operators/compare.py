"""Month-over-month comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom import schemas
from wattloom.functions import measures


def with_previous(monthly: DataFrame) -> DataFrame:
    """Each month with the measures of the building's preceding month row.

    "Preceding" is the row before, so a comparison spans a missing month. All lags
    share one window. A window partition holds one row per month of a building,
    which the calendar bounds.
    """
    by_month = Window.partitionBy("building_id").orderBy("usage_month")
    lags = {"previous_month": F.lag("usage_month").over(by_month)}
    lags.update({f"previous_{name}": F.lag(name).over(by_month) for name in schemas.LAGGED})
    return monthly.withColumns(lags)


def change(measure: str) -> Column:
    return F.col(measure) - F.col(f"previous_{measure}")


def deltas(pairs: DataFrame) -> DataFrame:
    """Absolute change of each compared measure."""
    return pairs.withColumns({name: change(m) for name, m in schemas.CHANGES.items()})


def daily_change_pct() -> Column:
    """Change of the average daily use in percent of the previous month's."""
    return measures.ratio_pct(change("average_daily_kwh"), "previous_average_daily_kwh")


def residual_change() -> Column:
    """Net change that no metered end use accounts for; may be negative."""
    rest = F.col("electricity_change_kwh")
    for part in ("cooling_change_kwh", "heating_change_kwh", "hot_water_change_kwh"):
        rest = rest - F.col(part)
    return rest


def cooling_share_pct() -> Column:
    """Cooling's change in percent of the net change; may exceed 100 or be negative."""
    return measures.ratio_pct(F.col("cooling_change_kwh"), "electricity_change_kwh")


def investigation(monthly: DataFrame) -> DataFrame:
    """The comparison row of every building and month."""
    changed = deltas(with_previous(monthly)).withColumns(
        {
            "daily_usage_change_pct": daily_change_pct(),
            "other_electricity_change_kwh": residual_change(),
            "cooling_share_of_net_change_pct": cooling_share_pct(),
        }
    )
    return changed.select(*schemas.INVESTIGATION_COLUMNS)


def first_periods(comparison: DataFrame) -> DataFrame:
    """Rows without a predecessor."""
    return comparison.filter(F.col("previous_month").isNull())


def first_period_violations(comparison: DataFrame) -> DataFrame:
    """First months that carry a comparison, and later months that carry none."""
    first = Window.partitionBy("building_id")
    carries = F.col("previous_month").isNotNull()
    for name in [f"previous_{m}" for m in schemas.LAGGED] + schemas.DERIVED:
        carries = carries | F.col(name).isNotNull()
    return (
        comparison.withColumn("_first", F.min("usage_month").over(first))
        .withColumn("_is_first", F.col("usage_month") == F.col("_first"))
        .filter(
            (F.col("_is_first") & carries)
            | (~F.col("_is_first") & F.col("previous_month").isNull())
        )
        .select("building_id", "usage_month", "previous_month")
    )
