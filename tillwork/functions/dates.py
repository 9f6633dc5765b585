"""Calendar functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import as_col

# Day names in weekday order, Monday = 0.
WEEKDAYS = ("MON", "TUE", "WED", "THU", "FRI", "SAT", "SUN")


def year_label(c: Column | str) -> Column:
    return F.date_format(as_col(c), "yyyy")


def month_name(c: Column | str) -> Column:
    return F.date_format(as_col(c), "MMMM")


def week_label(c: Column | str) -> Column:
    """Monday-first week of the year, 00 to 53, days before the first Monday in week 00."""
    c = as_col(c)
    week = F.floor((F.dayofyear(c) + 6 - F.weekday(c)) / 7)
    return F.lpad(week.cast("string"), 2, "0")


def quarter_label(c: Column | str, sep: str = "Q") -> Column:
    """``2024Q1``; pass ``sep='-Q'`` for ``2024-Q1``."""
    c = as_col(c)
    return F.concat(F.year(c).cast("string"), F.lit(sep), F.quarter(c).cast("string"))


def roll_to_weekday(c: Column | str, target_day: int = 6) -> Column:
    """Move forward to the weekday (0 = Monday .. 6 = Sunday); a date already on it stays."""
    return F.next_day(F.date_sub(as_col(c), 1), WEEKDAYS[target_day])


def roll_to_month_end(c: Column | str) -> Column:
    return F.last_day(as_col(c))


def parse_date(c: Column | str, pattern: str = "dd/MM/yyyy") -> Column:
    """Parse text dates; text that does not match becomes NULL."""
    return F.try_to_timestamp(as_col(c), F.lit(pattern)).cast("date")
