"""Date expressions. All stay inside Spark's expression engine."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from forecourt.fixed_values import MONTH_LABELS, SPREADSHEET_DAY_ZERO

# Spark's dayofweek(): Sunday is 1, Monday is 2.
MONDAY = 2

# Serial of 9999-12-31.
LAST_SPREADSHEET_DAY = 2_958_465


def parse_date(text: Column, *formats: str) -> Column:
    """Text to date, trying the formats in order; null when none fits."""
    cleaned = F.trim(text)
    return F.coalesce(*[F.try_to_date(cleaned, f) for f in formats])


def excel_serial_date(serial: Column) -> Column:
    """Spreadsheet serial day (text or number) to date.

    Null when it is not a number or not a day of the years that sheets know, up to
    9999; so a date that is written as a number, 20230401, is no serial.
    """
    days = serial.cast("string").try_cast("double").try_cast("int")
    return F.when(days.between(1, LAST_SPREADSHEET_DAY),
                  F.date_add(F.lit(SPREADSHEET_DAY_ZERO).cast("date"), days))


def sales_through(report_date: Column) -> Column:
    """A report covers sales through the day before it."""
    return F.date_sub(report_date, 1)


def previous_report_date(report_date: Column, look_back: Mapping[int, int] | None = None) -> Column:
    """The report date to difference against.

    One day back, except for the weekdays in ``look_back`` (``dayofweek``
    number -> days). By default Monday looks back two days, since no report is
    loaded for it. One computed date keeps the self join an equality join.
    """
    if look_back is None:
        look_back = {MONDAY: 2}
    days = F.lit(1)
    for weekday, back in look_back.items():
        days = F.when(F.dayofweek(report_date) == weekday, F.lit(back)).otherwise(days)
    return F.date_sub(report_date, days)


def is_load_day(date: Column, closed: Sequence[int] = (MONDAY,)) -> Column:
    """False on weekdays without a load (Mondays by default)."""
    return ~F.dayofweek(date).isin(*closed)


def loads_on(as_of: dt.date, closed: Sequence[int] = (MONDAY,)) -> bool:
    """The same rule for one day, before a job starts."""
    return (as_of.isoweekday() % 7) + 1 not in closed


def month_label(date: Column) -> Column:
    """Three-letter month name, independent of the locale."""
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_LABELS]), F.month(date))


def zone_timestamp(zone: str) -> Column:
    """Time of the run as a wall clock in ``zone``, for the audit stamp."""
    return F.convert_timezone(None, F.lit(zone), F.current_timestamp().cast("timestamp_ntz"))


def within_days(date: Column, before: Column, days: int) -> Column:
    """True for dates of less than ``days`` before a day, and for later ones."""
    return F.datediff(before, date) < days
