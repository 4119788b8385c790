"""Marts that follow changes of the fact instead of being built anew.

The stored base holds additive counts per state, year, week and day of onset, partitioned by year.
A change of the fact becomes signed counts of the rows that differ; they are added to the years
they touch, and only those years are written again, in the base and in the mart made from it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentinela.functions.dates import week_start
from sentinela.operators.audit import snapshot_join
from sentinela.operators.filters import valid_week
from sentinela.plans.marts import confirmed, state_of
from sentinela.session import written
from sentinela.sources.warehouse import remove_folder, replace_years

DAY_KEYS = ["cod_uf_resi", "nu_ano", "sem_sintomas", "dt_sintomas"]
DAY_COUNTS = ["casos_total", "casos_confirmados"]
DAY_SCHEMA = "cod_uf_resi int, sem_sintomas int, dt_sintomas date, casos_total bigint, casos_confirmados bigint, nu_ano int"
MART_SCHEMA = "uf string, regiao string, semana_epi int, inicio_sem date, casos_total bigint, casos_confirmados bigint, ano int"


def day_counts(fact: DataFrame, sign: Column | None = None) -> DataFrame:
    """Counts per state, year, week and day of onset; each row counts as its ``sign``."""
    sign = F.lit(1) if sign is None else sign
    counted = fact.where(valid_week() & F.col("cod_uf_resi").isNotNull())
    return counted.groupBy(*DAY_KEYS).agg(
        F.sum(sign.cast("bigint")).alias("casos_total"),
        F.sum(F.when(confirmed(), sign).otherwise(0).cast("bigint")).alias("casos_confirmados"),
    )


def count_deltas(before: DataFrame, after: DataFrame, key: str = "id_notif") -> DataFrame:
    """Signed counts of what differs between two states of the fact.

    Only the columns that the counts need are compared.
    """
    columns = [key, *DAY_KEYS, "cod_classificacao"]
    paired = snapshot_join(before.select(columns), after.select(columns), [key]).where("NOT (antes <=> depois)")
    sides = F.array(
        F.struct(F.lit(-1).alias("sinal"), F.col("antes").alias("linha")),
        F.struct(F.lit(1).alias("sinal"), F.col("depois").alias("linha")),
    )
    changed = paired.select(F.inline(sides)).where("linha IS NOT NULL").select("sinal", "linha.*")
    deltas = day_counts(changed, F.col("sinal"))
    return deltas.where(reduce(Column.__or__, [F.col(name) != 0 for name in DAY_COUNTS]))


def weekly_of_days(days: DataFrame, dim_uf: DataFrame) -> DataFrame:
    """The weekly mart per state from day counts; equal to ``weekly_series_state`` of the fact."""
    weekly = days.groupBy("cod_uf_resi", "nu_ano", "sem_sintomas").agg(
        F.min("dt_sintomas").alias("primeiro_dia"), *[F.sum(name).alias(name) for name in DAY_COUNTS]
    )
    return state_of(weekly, dim_uf, "cod_uf_resi", "inner").select(
        F.col("sigla").alias("uf"),
        "regiao",
        F.col("nu_ano").alias("ano"),
        F.col("sem_sintomas").alias("semana_epi"),
        week_start(F.col("primeiro_dia")).alias("inicio_sem"),
        *DAY_COUNTS,
    )


def in_years(rows: DataFrame, column: str, years: list[int | None]) -> DataFrame:
    """Rows of the given years, as a filter that prunes partitions; None stands for a missing year."""
    known = F.col(column).isin([year for year in years if year is not None])
    return rows.where(known | F.col(column).isNull() if None in years else known)


def build_weekly(fact: DataFrame, root: str, dim_uf: DataFrame) -> DataFrame:
    """Store day counts and the weekly mart of the whole fact below ``root`` and return the mart."""
    replace_years(day_counts(fact), f"{root}/dias")
    return _rewritten(fact.sparkSession, root, dim_uf, None)


def refresh_weekly(spark: SparkSession, root: str, before: DataFrame, after: DataFrame, dim_uf: DataFrame) -> DataFrame:
    """Bring the stored mart from one state of the fact to the next; files of untouched years stay.

    Fails, and leaves everything as it was, if ``before`` is not the state that was stored.
    """
    deltas = written(count_deltas(before, after), "deltas")
    years = sorted((row["nu_ano"] for row in deltas.select("nu_ano").distinct().collect()), key=str)
    if not years:
        return weekly_mart(spark, root)
    stored = in_years(spark.read.schema(DAY_SCHEMA).parquet(f"{root}/dias"), "nu_ano", years)
    merged = stored.unionByName(deltas).groupBy(*DAY_KEYS).agg(*[F.sum(name).alias(name) for name in DAY_COUNTS])
    merged = written(merged.where(reduce(Column.__or__, [F.col(name) != 0 for name in DAY_COUNTS])), "dias")
    if not merged.where("casos_total < casos_confirmados OR casos_confirmados < 0 OR casos_total <= 0").isEmpty():
        raise ValueError("the state before is not the one the stored counts were made from")
    _replace(merged, f"{root}/dias", "nu_ano", years)
    return _rewritten(spark, root, dim_uf, years)


def weekly_mart(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(MART_SCHEMA).parquet(f"{root}/semanas")


def _rewritten(spark: SparkSession, root: str, dim_uf: DataFrame, years: list[int | None] | None) -> DataFrame:
    days = spark.read.schema(DAY_SCHEMA).parquet(f"{root}/dias")
    if years is None:
        replace_years(weekly_of_days(days, dim_uf), f"{root}/semanas", "ano")
    else:
        _replace(weekly_of_days(in_years(days, "nu_ano", years), dim_uf), f"{root}/semanas", "ano", years)
    return weekly_mart(spark, root)


def _replace(rows: DataFrame, path: str, column: str, years: list[int | None]) -> None:
    """Write the given years anew; a year without rows any more loses its folder."""
    left = {row[column] for row in rows.select(column).distinct().collect()}  # no more than the years given
    replace_years(rows, path, column)
    for year in years:
        if year not in left:
            name = "__HIVE_DEFAULT_PARTITION__" if year is None else year
            remove_folder(rows.sparkSession, f"{path}/{column}={name}")
