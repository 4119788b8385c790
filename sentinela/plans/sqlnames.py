"""Views and functions for users who query in SQL.

The views are lazy: a filter in the query reaches the fact wherever it can. Their names and the
functions' parameters are those surveillance analysts already use.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from sentinela.functions.ages import UNITS_PER_YEAR
from sentinela.plans import marts
from sentinela.schemas import AGE_BANDS, CODE_LISTS, OLDEST_BAND, UNKNOWN_BAND, code_list, states


class Dimensions(NamedTuple):
    uf: DataFrame
    municipio: DataFrame
    lists: dict[str, DataFrame]


def fixed_dimensions(spark: SparkSession, municipio: DataFrame) -> Dimensions:
    return Dimensions(states(spark), municipio, {name: code_list(spark, name) for name in CODE_LISTS})


def views(fact: DataFrame, dims: Dimensions) -> dict[str, DataFrame]:
    lists = dims.lists
    return {
        "fato_notificacao": fact,
        "dim_uf": dims.uf,
        "dim_municipio": dims.municipio,
        **{f"dim_{name}": rows for name, rows in lists.items()},
        "vw_serie_semanal": marts.weekly_series(fact),
        "vw_serie_semanal_uf": marts.weekly_series_state(fact, dims.uf),
        "vw_casos_uf_ano": marts.state_year_cases(fact, dims.uf),
        "vw_piramide_etaria": marts.age_pyramid(fact, lists["sexo"]),
        "vw_gestantes": marts.pregnancy_watch(fact, dims.uf, lists["gestante"]),
        "vw_municipios_top": marts.municipality_ranking(fact, dims.municipio, dims.uf),
        "vw_perfil_demografico": marts.demographic_profile(
            fact, lists["sexo"], lists["raca"], lists["escolaridade"]
        ),
        "vw_kpis": marts.kpis(fact),
        "vw_latencia_notificacao": marts.notification_latency(fact, dims.uf),
        "vw_completude": marts.completeness(fact),
        "resumo_por_uf_ano": marts.epi_summary(fact, dims.uf, with_code=True),
        "curva_por_uf": marts.weekly_curve_by_state(fact, dims.uf),
    }


def of_state(dim_uf: DataFrame) -> str:
    """Condition on ``cod_uf`` for the parameter ``p_uf``.

    A subquery may not refer to a function's parameter, so the states' codes, a few dozen, stand in
    the function's body. With a literal argument the condition folds to an equality that goes through
    the grouping and the join to the fact's files; without one it folds away.
    """
    codes = ", ".join(f"'{row['sigla']}', {row['cod_uf']}" for row in dim_uf.select("sigla", "cod_uf").orderBy("sigla").collect())
    return f"(p_uf IS NULL OR cod_uf = try_element_at(map({codes}), p_uf))"


def band_cases() -> str:
    cases = " ".join(f"WHEN idade < {upper} THEN '{label}'" for upper, label in AGE_BANDS)
    return f"CASE WHEN idade IS NULL THEN '{UNKNOWN_BAND}' {cases} ELSE '{OLDEST_BAND}' END"


def functions(summary: DataFrame, dim_uf: DataFrame) -> dict[str, str]:
    """Signature and body of each SQL function."""
    def table_of(rows: DataFrame) -> str:
        return "TABLE (" + ", ".join(f"{name} {kind}" for name, kind in rows.dtypes) + ")"

    shown = summary.drop("cod_uf")
    state = of_state(dim_uf)
    units = ", ".join(f"{units}D" for units in UNITS_PER_YEAR)
    return {
        "fn_decodifica_idade(codigo INT) RETURNS DECIMAL(6,3)": (
            f"CASE WHEN codigo > 0 THEN CAST((codigo % 1000) / get(array({units}), codigo div 1000 - 1) AS DECIMAL(6,3)) END"
        ),
        "fn_faixa_etaria(idade DECIMAL(10,3)) RETURNS STRING": band_cases(),
        f"fn_resumo_epidemiologico(p_uf STRING DEFAULT NULL, p_ano INT DEFAULT NULL) RETURNS {table_of(shown)}": (
            f"SELECT {', '.join(shown.columns)} FROM resumo_por_uf_ano "
            f"WHERE (p_ano IS NULL OR ano = p_ano) AND {state}"
        ),
        "fn_curva_semanal(p_uf STRING DEFAULT NULL, p_ano_inicio INT DEFAULT NULL, p_ano_fim INT DEFAULT NULL) "
        "RETURNS TABLE (ano INT, semana_epi INT, inicio_sem DATE, casos_total BIGINT, casos_confirmado BIGINT)": (
            "SELECT ano, semana_epi, inicio_sem, SUM(casos_total), SUM(casos_confirmado) FROM curva_por_uf "
            "WHERE (p_ano_inicio IS NULL OR ano >= p_ano_inicio) AND (p_ano_fim IS NULL OR ano <= p_ano_fim) "
            f"AND {state} GROUP BY ano, semana_epi, inicio_sem"
        ),
        "fn_detectar_duplicatas(p_janela_dias INT DEFAULT 3) RETURNS TABLE (grupo_hash STRING, n_ocorrencias BIGINT, "
        "cod_mun_resi INT, cod_sexo STRING, idade_anos DECIMAL(6,2), dt_sintomas_min DATE, dt_sintomas_max DATE)": (
            "SELECT md5(concat(cod_mun_resi, cod_sexo, idade, balde)), count(*), cod_mun_resi, cod_sexo, "
            "CAST(idade AS DECIMAL(6,2)), min(dt_sintomas), max(dt_sintomas) FROM ("
            "SELECT cod_mun_resi, cod_sexo, dt_sintomas, CAST(round(idade_anos, 0) AS INT) AS idade, "
            "CASE WHEN idade_anos IS NOT NULL THEN date_sub(dt_sintomas, dayofyear(dt_sintomas) % p_janela_dias) END AS balde "
            "FROM fato_notificacao WHERE cod_mun_resi IS NOT NULL AND cod_sexo IS NOT NULL AND dt_sintomas IS NOT NULL) "
            "GROUP BY cod_mun_resi, cod_sexo, idade, balde HAVING count(*) > 1"
        ),
    }


def register_sql(fact: DataFrame, dims: Dimensions) -> SparkSession:
    """Register the temporary views and functions in the fact's session."""
    spark = fact.sparkSession
    made = views(fact, dims)
    for name, rows in made.items():
        rows.createOrReplaceTempView(name)
    for signature, body in functions(made["resumo_por_uf_ano"], dims.uf).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
    return spark
