"""Epidemiological calendar: ISO weeks that start on Monday."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_year(day: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), day).cast("int")


def iso_week(day: Column) -> Column:
    return F.weekofyear(day)


def week_start(day: Column) -> Column:
    """Monday of the day's week."""
    return F.trunc(day, "week")


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def date_bucket(day: Column, width: int) -> Column:
    """First day of the fixed ``width``-day bucket, counted in days of the year."""
    if width <= 0:
        raise ValueError("bucket width must be at least one day")
    return F.date_sub(day, F.dayofyear(day) % width)
