"""Row filters shared by marts and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentinela.functions.cleaning import is_iso_date
from sentinela.functions.dates import days_between
from sentinela.schemas import PREGNANT, UNKNOWN_BAND


def admit_rows(staging: DataFrame) -> DataFrame:
    """Staging rows whose symptom date has the ISO shape."""
    return staging.where(is_iso_date(F.col("dt_sin_pri")))


def valid_week() -> Column:
    return F.col("dt_sintomas").isNotNull() & F.col("sem_sintomas").between(1, 53)


def sex_known() -> Column:
    return F.col("cod_sexo").isin("M", "F")


def pregnant(codes: tuple[int, ...] = PREGNANT) -> Column:
    return F.col("cod_gestante").isin(*codes)


def latency_window(longest: int = 365) -> Column:
    """Notification 0 to ``longest`` days after the first symptoms."""
    return days_between(F.col("dt_notificacao"), F.col("dt_sintomas")).between(0, longest)


def band_known() -> Column:
    return F.col("faixa_etaria") != UNKNOWN_BAND


def optional_filter(rows: DataFrame, **equals) -> DataFrame:
    """Keep rows equal to each given value; arguments left ``None`` do not filter."""
    for name, value in equals.items():
        if value is not None:
            rows = rows.where(F.col(name) == F.lit(value))
    return rows


def report_filter(
    mart: DataFrame, states: list[str] | None = None, years: tuple[int, int] | None = None
) -> DataFrame:
    """Keep a mart's rows of the chosen states and year range."""
    if states:
        mart = mart.where(F.col("uf").isin(*states))
    if years:
        mart = mart.where(F.col("ano").between(*years))
    return mart


def having_min_rows(grouped: DataFrame, count: str, least: int) -> DataFrame:
    return grouped.where(F.col(count) >= least)
