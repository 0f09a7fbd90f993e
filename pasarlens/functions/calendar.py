"""Calendar expressions. ``as_of`` is always a parameter, so a rerun of an old day gives the old result."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def window_start(as_of: date, *, days: int = 0, weeks: int = 0, months: int = 0) -> Column:
    """First day of the look-back window; a constant that the optimizer folds into the scan filter."""
    start = F.add_months(F.lit(as_of), -months) if months else F.lit(as_of)
    return F.date_sub(start, days + 7 * weeks)


def in_window(day: Column | str, as_of: date, *, days: int = 0, weeks: int = 0, months: int = 0) -> Column:
    """True for days from the window start up to and including ``as_of``."""
    day = F.col(day) if isinstance(day, str) else day
    return (day >= window_start(as_of, days=days, weeks=weeks, months=months)) & (day <= F.lit(as_of))


def week_start(day: Column | str) -> Column:
    """The Sunday on or before the day (``date_trunc('week')`` would give the Monday)."""
    return F.date_sub(day, F.dayofweek(day) - 1)


def is_weekend(day: Column | str) -> Column:
    """1 on Saturday and Sunday, otherwise 0."""
    return F.when(F.dayofweek(day).isin(1, 7), 1).otherwise(0)


def month_text(day: Column | str) -> Column:
    return F.date_format(day, "yyyy-MM")


def weekday_name(day: Column | str) -> Column:
    return F.date_format(day, "EEEE")
