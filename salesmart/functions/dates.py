"""Date expressions (DAT-1..5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def days_between(start, end) -> Column:
    """T-SQL ``datediff(day, start, end)`` = end - start in days."""
    return F.datediff(_c(end), _c(start))


def month_name(d) -> Column:
    """English month name, as ``datename(month, d)``."""
    return F.date_format(_c(d), "MMMM")


def day_name(d) -> Column:
    """English weekday name, as ``datename(weekday, d)``."""
    return F.date_format(_c(d), "EEEE")


def as_of_date(as_of) -> Column:
    """The run's reference date (replaces ``getdate()`` for the whole run)."""
    return F.to_date(F.lit(str(as_of))) if as_of is not None else F.current_date()


def as_of_ts(as_of) -> Column:
    return F.to_timestamp_ntz(F.lit(str(as_of))) if as_of is not None else F.localtimestamp()
