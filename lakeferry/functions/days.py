"""Calendar days, as columns and (for naming tables and partitions) in Python.

Days move by the calendar, never by 86400 seconds, and the run day is always
an argument.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# The spellings of a day that are understood.
DAY_SPELLINGS = ("yyyy-MM-dd", "yyyy/MM/dd", "yyyyMMdd")
_PYTHON_SPELLINGS = ("%Y-%m-%d", "%Y/%m/%d", "%Y%m%d")


def parse_day(column: Column) -> Column:
    """Text in any of the spellings to a DATE; NULL for anything else."""
    return F.coalesce(*[F.try_to_date(column, spelling) for spelling in DAY_SPELLINGS])


def format_day(column: Column, separator: str = "") -> Column:
    """Year, month and day with ``separator`` between them."""
    quoted = "'" + separator.replace("'", "''") + "'" if separator else ""
    return F.date_format(column, quoted.join(("yyyy", "MM", "dd")))


def day_key(column: Column) -> Column:
    """The INT that names a day's partition: 20180420.

    Plain arithmetic, because formatting every row of a log as text costs more.
    """
    return F.year(column) * 10000 + F.month(column) * 100 + F.dayofmonth(column)


def day_range(start: Column, end: Column) -> Column:
    """All days from start to end, both included; none if start is later."""
    days = F.sequence(start, end, F.expr("interval 1 day"))
    return F.when(start <= end, days).otherwise(F.array().cast("array<date>"))


def days_before(column: Column, count: int) -> Column:
    return F.date_sub(column, count)


def as_day(value: str | date) -> date:
    """A date from a date or from text in any of the spellings."""
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    for spelling in _PYTHON_SPELLINGS:
        try:
            return datetime.strptime(value, spelling).date()
        except ValueError:
            continue
    raise ValueError(f"not a day: {value!r}")


def back(value: str | date, count: int) -> date:
    return as_day(value) - timedelta(days=count)


def list_days(start: str | date, end: str | date) -> list[date]:
    first, last = as_day(start), as_day(end)
    return [first + timedelta(days=n) for n in range((last - first).days + 1)]


def partition_value(value: str | date) -> int:
    return int(as_day(value).strftime("%Y%m%d"))
