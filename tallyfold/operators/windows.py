"""Report date windows. Days are UTC days."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def utc_today() -> Column:
    return F.to_date(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()))


def _day(text):
    try:
        return datetime.strptime(text, "%Y-%m-%d").date()
    except (TypeError, ValueError):
        return None


def report_window(start=None, end=None) -> tuple[Column, Column]:
    """First and last day: both when both are valid days, else yesterday."""
    first, last = _day(start), _day(end)
    if first and last:
        return F.lit(first), F.lit(last)
    yesterday = F.date_sub(utc_today(), 1)
    return yesterday, yesterday


def month_window(month) -> tuple[Column, Column]:
    """First and last day of a `YYYY-MM` text; blank or invalid is this month."""
    month = F.lit(month) if month is None or isinstance(month, str) else month
    day = F.coalesce(F.try_to_date(month, "yyyy-M"), utc_today())
    return F.trunc(day, "MM"), F.last_day(day)


def in_window(rows: DataFrame, date, window) -> DataFrame:
    return rows.filter(F.col(date).between(*window))
