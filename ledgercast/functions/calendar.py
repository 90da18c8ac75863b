"""Month arithmetic. A report month is always the date of its last day."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column, functions as F


def month_end(day: dt.date | str, months: int = 0) -> dt.date:
    """Last day of the month that lies ``months`` after the month of ``day``."""
    if isinstance(day, str):
        day = dt.date.fromisoformat(day)
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    return dt.date(year, month + 1, calendar.monthrange(year, month + 1)[1])


def month_range(first: dt.date | str, last: dt.date | str) -> list[dt.date]:
    """Month ends from ``first`` to ``last``, both included."""
    start, stop = month_end(first), month_end(last)
    count = (stop.year - start.year) * 12 + stop.month - start.month + 1
    return [month_end(start, i) for i in range(max(count, 0))]


def month_end_col(day: Column, months: int | Column = 0) -> Column:
    """Column form of :func:`month_end`."""
    return F.last_day(F.add_months(F.last_day(day), months))


def month_end_offset(day: Column, n: int) -> Column:
    """``day`` plus ``n`` month-end offsets.

    From a month end this moves ``n`` months. From any other day the first step forward only
    completes the current month, so offsets 0 and 1 both give the end of that month.
    """
    if n <= 0:
        return month_end_col(day, n)
    on_month_end = F.last_day(day) == day.cast("date")
    return F.when(on_month_end, month_end_col(day, n)).otherwise(month_end_col(day, n - 1))


def month_index(day: Column) -> Column:
    """Months since year 0, so that a difference of two indexes is an exact month offset."""
    return F.year(day) * 12 + F.month(day)


def report_months_window(report_dt: Column, history: int, predict: int) -> Column:
    """Array of the ``history + predict`` month ends around ``report_dt``."""
    offsets = F.sequence(F.lit(1 - history), F.lit(predict))
    return F.transform(offsets, lambda k: F.last_day(F.add_months(F.last_day(report_dt), k)))
