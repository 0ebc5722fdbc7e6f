"""Date helpers (SCA6, SCA9)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def day_of_week(date_col) -> Column:
    """Monday = 0 ... Sunday = 6, one convention for training and scoring."""
    return F.weekday(_c(date_col))


def date_parts(date_col) -> dict[str, Column]:
    """ISO date -> DayOfYear, DayOfMonth, DayOfWeek columns (all INT)."""
    d = _c(date_col)
    return {
        "DayOfYear": F.dayofyear(d),
        "DayOfMonth": F.dayofmonth(d),
        "DayOfWeek": day_of_week(d),
    }


def iso_day(text_col) -> Column:
    """ISO date or date-time text -> the calendar day it is written with (DATE), whatever
    its offset from UTC; null if unparsable."""
    text = F.trim(_c(text_col).cast("string"))
    day = F.regexp_extract(text, r"^([0-9]{4}-[0-9]{2}-[0-9]{2})(?:$|[T ])", 1)
    return F.when(F.try_to_timestamp(text).isNotNull(), day.try_cast("date"))


def day_after(text_col) -> Column:
    """Day of an ISO date-time plus one day (DATE)."""
    return F.date_add(iso_day(text_col), 1)
