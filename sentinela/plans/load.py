"""The batch load: raw file to published staging, dimensions, fact and weekly mart."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from sentinela.operators.dimensions import distinct_health_units, distinct_municipalities
from sentinela.operators.staging import judged_staging, split_judged
from sentinela.plans.incremental import build_weekly, refresh_weekly
from sentinela.plans.marts import load_summary, weekly_series_state
from sentinela.schemas import states
from sentinela.session import wide_rows, written
from sentinela.sources.warehouse import current_or_none, load_fact, load_staging, materialize_mart, publish


class Warehouse(NamedTuple):
    staging: DataFrame
    refused: DataFrame
    municipalities: DataFrame
    health_units: DataFrame
    fact: DataFrame
    weekly_by_state: DataFrame
    summary: DataFrame


def run_load(
    spark: SparkSession,
    csv_path: str | list[str],
    root: str,
    multi_line: bool = False,
    follow: bool = False,
    mixed_headers: bool = False,
) -> Warehouse:
    """Load everything; each step reads the table the step before has published.

    Staging is judged and typed in one pass, whose stored result is split into fact and refused rows.
    With ``follow``, the weekly mart is not built anew but follows what changed since the load before;
    files of years without changes stay. The fact's ids follow from its rows, so a form that comes
    again is no change.
    """
    dim_uf = states(spark)
    staging = load_staging(spark, csv_path, f"{root}/staging", multi_line, mixed_headers)
    with wide_rows(spark):
        judged = written(judged_staging(staging, hashed=False), "julgadas")
    accepted, rejected = split_judged(judged, staging.columns)
    refused = publish(rejected, f"{root}/recusadas")
    municipalities = publish(distinct_municipalities(staging, dim_uf), f"{root}/dim_municipio", unique=["cod_municipio"])
    health_units = publish(distinct_health_units(staging), f"{root}/dim_unidade_saude", unique=["cod_cnes"])
    before = current_or_none(spark, f"{root}/fato_notificacao")
    fact = load_fact(accepted, f"{root}/fato_notificacao", stored=True)
    if not follow:
        weekly = materialize_mart(
            weekly_series_state(fact, dim_uf), f"{root}/serie_semanal_uf", ["uf", "ano", "semana_epi"]
        )
    elif before is None:
        weekly = build_weekly(fact, f"{root}/serie_semanal_uf_viva", dim_uf)
    else:
        weekly = refresh_weekly(spark, f"{root}/serie_semanal_uf_viva", before, fact, dim_uf)
    return Warehouse(staging, refused, municipalities, health_units, fact, weekly, load_summary(fact))
