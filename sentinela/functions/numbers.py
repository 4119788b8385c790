"""Exact rounded ratios, computed on integers so that every engine agrees on the last digit."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded_ratio(part: Column, whole: Column, digits: int, factor: int = 1) -> Column:
    """``round(factor * part / whole, digits)``, half up, for ``part >= 0``; NULL if ``whole`` is 0."""
    scaled = part.cast("bigint") * F.lit(2 * factor * 10**digits).cast("bigint")
    whole = F.nullif(whole.cast("bigint"), F.lit(0).cast("bigint"))
    units = F.call_function("div", scaled + whole, whole * 2)
    return (units.cast("decimal(20,0)") * F.lit(Decimal(1).scaleb(-digits))).cast(f"decimal(18,{digits})")


def safe_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage of ``whole``, NULL for an empty whole."""
    return rounded_ratio(part, whole, digits, factor=100)


def hundredths(amount: Column) -> Column:
    """A two-decimal amount as a whole number of hundredths."""
    return (amount * 100).cast("bigint")


def median_of_hundredths(value: Column, frequency: Column) -> Column:
    """Median of a value histogram in hundredths, rounded half up to two decimals.

    The median of integers is an integer or ends in .5, both exact in a double.
    """
    median = F.floor(F.percentile(value, 0.5, frequency) + 0.5)
    return (median.cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,2)")


def mirror_male(sex_label: Column, count: Column) -> Column:
    """Counts of men as negative numbers, for the left side of a pyramid."""
    return F.when(sex_label == "Masculino", -count).otherwise(count)
