"""Dates, periods and day groups as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    """A column by exact name (dots, slashes and spaces allowed), or the column itself."""
    return c if isinstance(c, Column) else F.col(f"`{c}`")


def service_day(ts: str | Column) -> Column:
    return F.to_date(col(ts))


def is_weekend(ts: str | Column) -> Column:
    return F.dayofweek(col(ts)).isin(1, 7)


def day_group(ts: str | Column) -> Column:
    """``weekday`` for Monday to Friday, else ``weekend``."""
    return F.when(is_weekend(ts), "weekend").otherwise("weekday")


def month_start(year: str | Column, month: str | Column) -> Column:
    return F.make_date(col(year), col(month), F.lit(1))


def period_label(year: str | Column, month: str | Column) -> Column:
    """The period as text, ``YYYY-MM-01``."""
    return month_start(year, month).cast("string")


def month_label(year: str | Column, month: str | Column) -> Column:
    """A short label such as ``Feb 2026``."""
    return F.date_format(month_start(year, month), "MMM yyyy")


def days_in_month(year: str | Column, month: str | Column) -> Column:
    return F.dayofmonth(F.last_day(month_start(year, month)))


def day_bit(ts: str | Column) -> Column:
    """The day of the month as one bit; OR-ing them keeps the exact set of days in 31 bits."""
    return F.call_function("shiftleft", F.lit(1), F.dayofmonth(col(ts)) - 1)


def day_name(day: str | Column) -> Column:
    return F.date_format(col(day), "EEEE")


def is_weekday(day: str | Column) -> Column:
    return F.weekday(col(day)) < 5


def reading_time(day: str | Column, clock: str | Column) -> Column:
    """A timestamp without zone from ``MM/DD/YYYY`` and ``HH:MM:SS``."""
    return F.to_timestamp_ntz(F.concat_ws(" ", col(day), col(clock)), F.lit("MM/dd/yyyy HH:mm:ss"))


def reading_date_text(day: str | Column) -> Column:
    return F.date_format(col(day), "MM/dd/yyyy")


def minute_second(clock: str | Column) -> Column:
    """The ``MM:SS`` tail of a clock text."""
    return F.substring(col(clock), -5, 5)


def in_months(ts: str | Column, months: list[tuple[int, int]]) -> Column:
    """Rows of the given months as half-open ranges on the raw column, one per unbroken run.

    Ranges on the raw column reach the scan as pushed filters, which ``year(ts) = ...`` does not.
    The list is a plan parameter, bounded by the calendar.
    """
    serials = sorted({12 * y + (m - 1) for y, m in months})
    runs: list[list[int]] = []
    for serial in serials:
        if runs and serial == runs[-1][1]:
            runs[-1][1] = serial + 1
        else:
            runs.append([serial, serial + 1])

    def edge(serial: int) -> Column:
        return F.lit(f"{serial // 12:04d}-{serial % 12 + 1:02d}-01 00:00:00").cast("timestamp_ntz")

    ranges = [(col(ts) >= edge(a)) & (col(ts) < edge(b)) for a, b in runs]
    return reduce(lambda a, b: a | b, ranges, F.lit(False)) if ranges else F.lit(False)
