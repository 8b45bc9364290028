"""Display text for measures.

Null, NaN and infinite values read "Not available", never zero. Decimals are
rounded from the exact binary value of the double: 1.005 shows as 1.00.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts and signs a reader of the reports sees.
NOT_AVAILABLE = "Not available"
MINUS = "−"
ENERGY_UNIT = "kWh"
DEMAND_UNIT = "kW"
TEMPERATURE_UNIT = "°F"
AREA_UNIT = "sq ft"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fixed(value: str | Column, decimals: int = 2) -> Column:
    """Fixed-point text; values exactly half way go to the even digit."""
    return F.regexp_replace(F.format_number(_col(value), decimals), ",", "")


def fixed_half_up(value: str | Column, decimals: int = 2) -> Column:
    """Fixed-point text; values exactly half way go away from zero.

    A double lies exactly half way only if it is an odd multiple of
    ``2**-(decimals + 1)``; scaling by a power of two tests that without rounding.
    """
    value = _col(value)
    half_way = F.abs(value) * F.lit(float(2 ** (decimals + 1))) % F.lit(2.0) == F.lit(1.0)
    return F.when(half_way, F.format_string(f"%.{decimals}f", value)).otherwise(
        fixed(value, decimals)
    )


def _shown(value: Column, text: Column) -> Column:
    missing = value.isNull() | F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.when(missing, F.lit(NOT_AVAILABLE)).otherwise(text)


def number(value: str | Column, decimals: int = 2, unit: str | None = None) -> Column:
    """Plain number, optionally with a unit; -0 reads as 0."""
    value = _col(value)
    magnitude = fixed_half_up(F.abs(value), decimals)
    text = F.concat(F.when(value < 0, F.lit("-")).otherwise(F.lit("")), magnitude)
    return _shown(value, F.concat(text, F.lit(f" {unit}")) if unit else text)


def signed(value: str | Column, decimals: int = 2, suffix: str = "") -> Column:
    """Change with an explicit sign; zero carries none."""
    value = _col(value)
    sign = F.when(value > 0, F.lit("+")).when(value < 0, F.lit(MINUS)).otherwise(F.lit(""))
    return _shown(
        value, F.concat(sign, fixed_half_up(F.abs(value), decimals), F.lit(suffix))
    )


def percent(value: str | Column, decimals: int = 2) -> Column:
    return signed(value, decimals, "%")


def energy(value: str | Column) -> Column:
    return number(value, 2, ENERGY_UNIT)


def demand(value: str | Column) -> Column:
    return number(value, 2, DEMAND_UNIT)


def temperature(value: str | Column) -> Column:
    return number(value, 1, TEMPERATURE_UNIT)


def temperature_change(value: str | Column) -> Column:
    return signed(value, 1, f" {TEMPERATURE_UNIT}")


def degree_days(value: str | Column) -> Column:
    return number(value, 1)


def degree_days_change(value: str | Column) -> Column:
    return signed(value, 1)


def label(value: str | Column) -> Column:
    """Attribute text; null or empty reads as not available."""
    return F.coalesce(F.nullif(_col(value).cast("string"), F.lit("")), F.lit(NOT_AVAILABLE))


def floor_area(value: str | Column) -> Column:
    """Floor area with unit; zero counts as missing. Whole numbers show no decimals."""
    value = F.nullif(_col(value).cast("double"), F.lit(0.0))
    whole = value.cast("bigint")
    text = F.when(value == whole.cast("double"), whole.cast("string")).otherwise(
        value.cast("string")
    )
    return F.coalesce(F.concat(text, F.lit(f" {AREA_UNIT}")), F.lit(NOT_AVAILABLE))
