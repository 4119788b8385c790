"""Coded ages and age bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sentinela.schemas import AGE_BANDS, BAND_ORDER, OLDEST_BAND, UNKNOWN_BAND

# How many hours, days, months and years make a year, for leading digits 1 to 4.
UNITS_PER_YEAR = [365.25 * 24, 365.25, 12.0, 1.0]


def decode_age(code: Column) -> Column:
    """Age in years, to three decimals, of a coded age such as 4025 (25 years) or 3006 (6 months)."""
    per_year = F.get(F.array(*[F.lit(units) for units in UNITS_PER_YEAR]), F.floor(code / 1000).cast("int") - 1)
    return F.when(code > 0, (code % 1000) / per_year).cast("decimal(6,3)")


def stored_age(code: Column) -> Column:
    """The decoded age as the fact stores it, rounded a second time to two decimals."""
    return decode_age(code).cast("decimal(5,2)")


def age_band(age: Column) -> Column:
    """Age band label; an unknown age has a band of its own."""
    band = F.when(age.isNull(), UNKNOWN_BAND)
    for upper, label in AGE_BANDS:
        band = band.when(age < upper, label)
    return band.otherwise(OLDEST_BAND)


def category_order(value: Column, order: list[str] = BAND_ORDER) -> Column:
    """Position of a label in a fixed order, NULL for labels outside it."""
    place = F.array_position(F.array(*[F.lit(label) for label in order]), value)
    return F.nullif(place, F.lit(0)).cast("int")
