"""Guarded casts from raw text.

A guard first checks the text's shape and only then casts, because Spark's casts accept more
than the rules allow (blank padding, one-digit months). Patterns end in ``\\z``: in Java ``$``
also matches before a final line break.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = r"^[0-9]+\z"
ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
FOUR_DIGITS = r"^[0-9]{4}\z"


def is_digits(text: Column) -> Column:
    return text.rlike(DIGITS)


def is_iso_date(text: Column) -> Column:
    return (F.length(text) == 10) & text.rlike(ISO_DATE)


def guard_int(text: Column, type_name: str = "int") -> Column:
    """Digits-only text as an integer, anything else as NULL."""
    return F.when(is_digits(text), text.try_cast(type_name))


def guard_date(text: Column) -> Column:
    """``YYYY-MM-DD`` text as a date; other shapes and impossible days as NULL."""
    return F.when(is_iso_date(text), text.try_cast("date"))


def file_year(text: Column) -> Column:
    """Year of the source file: four digits, or the first four characters of longer text."""
    four = F.when(text.rlike(FOUR_DIGITS), text.try_cast("bigint"))
    longer = F.when(F.length(text) > 4, F.substring(text, 1, 4).try_cast("bigint"))
    return F.coalesce(four, longer)


def canon_municipality(text: Column) -> Column:
    """Municipality key: the first six digits, so 6- and 7-digit codes share one key."""
    return F.when(is_digits(text), F.substring(text, 1, 6).try_cast("int"))


def municipality_state(code: Column) -> Column:
    """State code held in the first two digits of a six-digit municipality key."""
    return F.floor(code / 10000).cast("int")


def clean_sex(text: Column) -> Column:
    """Only upper-case ``M`` and ``F`` are kept."""
    return F.when(text.isin("M", "F"), text)


def clean_birth_year(text: Column) -> Column:
    return F.when(text.rlike(FOUR_DIGITS), text.try_cast("bigint"))


def clean_occupation(text: Column) -> Column:
    """Occupation codes stay text; leading zeros matter."""
    return F.when(is_digits(text), text)


def label_code(prefix: str, code: Column) -> Column:
    """Placeholder name of a code without a known name."""
    return F.concat(F.lit(f"{prefix}-"), code.cast("string"))
