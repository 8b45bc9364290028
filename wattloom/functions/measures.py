"""Energy and weather arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEGREE_DAY_BASE_F = 65.0
READING_SECONDS = 15 * 60

# Decimal places for exact sums of data with few decimals: readings carry three, means
# of temperatures repeat and keep nine.
ENERGY_DIGITS = 6
WEATHER_DIGITS = 9


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_sum(value: str | Column, digits: int | None = None) -> Column:
    """Sum of doubles; with ``digits`` one that does not depend on the order of rows.

    ``digits`` is for data known to have that many decimals at most: values are then
    counted in units of ``10**-digits`` as 64-bit integers, and a re-run after a lost
    executor reproduces the same bits. Anything finer is rounded away, NaN and overflow
    raise. Without ``digits`` it is a plain floating-point sum.
    """
    value = _col(value)
    if digits is None:
        return F.sum(value)
    unit = F.lit(float(10**digits))
    return F.sum(F.rint(value * unit).cast("bigint")).cast("double") / unit


def exact_avg(value: str | Column, digits: int | None = None) -> Column:
    """Mean; with ``digits`` one division of an exact sum. Null when there is no value."""
    value = _col(value)
    if digits is None:
        return F.avg(value)
    return exact_sum(value, digits) / F.nullif(F.count(value), F.lit(0))


def demand_kw(kwh: str | Column, interval_seconds: int = READING_SECONDS) -> Column:
    """Average power over one metering interval."""
    return _col(kwh) * F.lit(3600.0 / interval_seconds)


def celsius_to_fahrenheit(celsius: str | Column) -> Column:
    # Multiply before dividing: the order decides the last bit of the double.
    return _col(celsius) * F.lit(9.0) / F.lit(5.0) + F.lit(32.0)


def total_of(*parts: str | Column) -> Column:
    """Left-to-right sum of columns; null if any part is null."""
    total, *rest = [_col(p) for p in parts]
    for part in rest:
        total = total + part
    return total


def cooling_degree_days(mean_f: str | Column, base: float = DEGREE_DAY_BASE_F) -> Column:
    """Degrees of the daily mean above the base; 0.0 when the mean is null."""
    return F.greatest(_col(mean_f) - F.lit(base), F.lit(0.0))


def heating_degree_days(mean_f: str | Column, base: float = DEGREE_DAY_BASE_F) -> Column:
    """Degrees of the daily mean below the base; 0.0 when the mean is null."""
    return F.greatest(F.lit(base) - _col(mean_f), F.lit(0.0))


def ratio_pct(part: Column, whole: str | Column) -> Column:
    """``part / whole`` in percent, null for a null or zero ``whole``, unclamped."""
    return part / F.nullif(_col(whole), F.lit(0.0)) * F.lit(100.0)
