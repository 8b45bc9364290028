"""Reporting periods as column expressions.

Stamps are naive local standard time and mark the *end* of an interval, so a
stamp exactly on a boundary belongs to the period it closes. Every expression
here stays on ``timestamp_ntz``/``date`` and is therefore free of the session
time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _inside(stamp: str | Column) -> Column:
    """A moment inside the interval that ``stamp`` closes."""
    return _col(stamp) - F.expr("INTERVAL '1' SECOND")


def hour_ending(stamp: str | Column) -> Column:
    """End of the hour that contains the interval closed by ``stamp``."""
    inside = _inside(stamp)
    midnight = inside.cast("date").cast("timestamp_ntz")
    return midnight + F.make_dt_interval(hours=F.hour(inside) + F.lit(1))


def usage_date(stamp: str | Column) -> Column:
    """Calendar day of the interval closed by ``stamp``."""
    return _inside(stamp).cast("date")


def usage_month(day: str | Column) -> Column:
    """First instant of the month of ``day``."""
    return F.trunc(_col(day).cast("date"), "month").cast("timestamp_ntz")


def date_key(period: str | Column) -> Column:
    """``YYYY-MM-DD`` text of a date or naive timestamp."""
    return F.substring(_col(period).cast("string"), 1, 10)


def month_key(period: str | Column) -> Column:
    """``YYYY-MM`` text of a date or naive timestamp."""
    return F.substring(_col(period).cast("string"), 1, 7)


def month_label(period: str | Column) -> Column:
    """English month name and year, such as ``May 2018``."""
    return F.date_format(_col(period).cast("date"), "MMMM yyyy")
