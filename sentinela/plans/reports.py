"""Report frames over marts.

Marts have at most a few thousand groups per state and year, so the global sorts, limits and
ranks here handle grouped rows only. Ties break by key to make every order total.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentinela.functions.ages import category_order
from sentinela.functions.numbers import mirror_male, safe_pct
from sentinela.plans.marts import whole


def choose_measure(only_confirmed: bool, confirmed: str = "casos_confirmados", every: str = "casos_total") -> str:
    """Name of the mart column a report counts."""
    return confirmed if only_confirmed else every


def descending(measure: str, *ties: str) -> list[Column]:
    return [F.desc_nulls_last(measure), *[F.asc_nulls_last(tie) for tie in ties]]


def national_curve(weekly_state: DataFrame, measure: str = "casos_total") -> DataFrame:
    return weekly_state.groupBy("inicio_sem").agg(F.sum(measure).alias("casos")).orderBy("inicio_sem")


def top_members(rows: DataFrame, key: str, measure: str, n: int) -> DataFrame:
    """The ``n`` keys with the largest sum of ``measure``."""
    return rows.groupBy(key).agg(F.sum(measure).alias(measure)).orderBy(*descending(measure, key)).limit(n)


def top_state_curves(weekly_state: DataFrame, measure: str = "casos_total", n: int = 10) -> DataFrame:
    """Weekly rows of the ``n`` states with most cases."""
    best = top_members(weekly_state, "uf", measure, n).select(F.col("uf").alias("_uf"))
    return weekly_state.join(best, F.col("uf").eqNullSafe(F.col("_uf")), "left_semi")


def seasonal_profile(weekly_state: DataFrame, measure: str = "casos_total") -> DataFrame:
    return weekly_state.groupBy("ano", "semana_epi").agg(F.sum(measure).alias(measure))


def state_totals(state_year: DataFrame, measure: str = "casos_total") -> DataFrame:
    """Cases and deaths per state over the years.

    The confirmation rate comes from the summed counts; ``taxa_somada`` adds up the yearly rates.
    """
    return (
        state_year.groupBy("cod_uf", "uf", "uf_nome", "regiao")
        .agg(
            F.sum(measure).alias("casos"),
            F.sum("obitos").alias("obitos"),
            F.sum("casos_confirmados").alias("_confirmados"),
            F.sum("casos_total").alias("_total"),
            F.sum("taxa_confirmacao_pct").cast("decimal(18,2)").alias("taxa_somada"),
        )
        .withColumn("taxa_confirmacao_pct", safe_pct(F.col("_confirmados"), F.col("_total")))
        .drop("_confirmados", "_total")
    )


def state_rank(state_year: DataFrame, measure: str = "casos_total") -> DataFrame:
    """States by descending cases with a rank that starts at 1.

    The single window partition holds one row per state.
    """
    totals = state_totals(state_year, measure)
    place = F.row_number().over(Window.orderBy(*descending("casos", "uf")))
    return totals.select(
        place.alias("posicao"), "uf", "uf_nome", "regiao", "casos", "obitos", "taxa_confirmacao_pct"
    )


def top_states(state_year: DataFrame, measure: str = "casos_total", n: int = 8) -> DataFrame:
    return state_totals(state_year, measure).orderBy(*descending("casos", "uf")).limit(n).select("uf", "casos")


def state_year_matrix(state_year: DataFrame, years: list[int], measure: str = "casos_total") -> DataFrame:
    """States as rows, the listed years as columns, 0 where a state has no row."""
    return state_year.groupBy("uf").pivot("ano", years).agg(F.sum(measure)).na.fill(0).orderBy("uf")


def pyramid_mirrored(pyramid: DataFrame, measure: str = "casos_total") -> DataFrame:
    """Band by sex in age order, men negative; unknown ages close the list."""
    grouped = pyramid.groupBy("faixa_etaria", "sexo").agg(F.sum(measure).alias("casos"))
    return grouped.select(
        category_order(F.col("faixa_etaria")).alias("ordem"),
        "faixa_etaria",
        "sexo",
        mirror_male(F.col("sexo"), F.col("casos")).alias("casos"),
    ).orderBy(F.asc_nulls_last("ordem"), "sexo")


def pyramid_pivot(pyramid_totals: DataFrame) -> DataFrame:
    """Band by sex as two columns, in age order."""
    wide = (
        pyramid_totals.groupBy("faixa_etaria")
        .pivot("sexo", ["Masculino", "Feminino"])
        .agg(F.sum("n"))
        .na.fill(0)
    )
    return wide.orderBy(F.asc_nulls_last(category_order(F.col("faixa_etaria"))))


def by_category(profile: DataFrame, category: str, measure: str = "notificados") -> DataFrame:
    """Cases per known value of one demographic column, ascending."""
    return (
        profile.where(F.col(category).isNotNull())
        .groupBy(category)
        .agg(F.sum(measure).alias(measure))
        .orderBy(measure, category)
    )


def by_race(profile: DataFrame, measure: str = "notificados") -> DataFrame:
    return by_category(profile, "raca_cor", measure)


def by_schooling(profile: DataFrame, measure: str = "notificados") -> DataFrame:
    return by_category(profile, "escolaridade", measure)


def pregnancy_totals(pregnancies: DataFrame) -> DataFrame:
    """One row: notified, confirmed, deaths and the confirmation rate (0 without notifications)."""
    summed = pregnancies.agg(*[whole(name) for name in ("gestantes_notificadas", "gestantes_confirmadas", "obitos")])
    notified = F.greatest(F.col("gestantes_notificadas"), F.lit(1).cast("bigint"))
    return summed.withColumn("taxa_pct", safe_pct(F.col("gestantes_confirmadas"), notified, 1))


def pregnancy_by_trimester(pregnancies: DataFrame) -> DataFrame:
    return pregnancies.groupBy("ano", "trimestre").agg(
        F.sum("gestantes_confirmadas").alias("gestantes_confirmadas")
    )


def pregnancy_top_states(pregnancies: DataFrame, n: int = 15) -> DataFrame:
    known = pregnancies.where(F.col("uf").isNotNull())
    return top_members(known, "uf", "gestantes_confirmadas", n).orderBy("gestantes_confirmadas", F.desc("uf"))


def pregnancy_table(pregnancies: DataFrame) -> DataFrame:
    return pregnancies.orderBy(*descending("gestantes_confirmadas", "ano", "uf", "trimestre"))


def completeness_long(completeness: DataFrame, target: int = 80) -> DataFrame:
    """One row per year and watched column, flagged against the target share."""
    percentages = [name for name in completeness.columns if name.endswith("_pct")]
    melted = completeness.unpivot(["ano"], percentages, "campo", "completude")
    return melted.withColumn("atinge_meta", F.col("completude") >= target)


def latency_box(latency: DataFrame) -> DataFrame:
    """Five-number summary per year of the states' mean latency."""
    spread = F.percentile(F.col("latencia_media_dias").cast("double"), [0.0, 0.25, 0.5, 0.75, 1.0])
    names = ["minimo", "q1", "mediana", "q3", "maximo"]
    boxes = latency.groupBy("ano").agg(spread.alias("_box"))
    return boxes.select("ano", *[F.col("_box")[i].alias(name) for i, name in enumerate(names)])


def duplicate_top(groups: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` largest duplicate groups, earliest first among equals."""
    ties = ["dt_sintomas_min", "cod_mun_resi", "cod_sexo", "idade_anos", "dt_sintomas_max", "grupo_hash"]
    return groups.orderBy(*descending("n_ocorrencias", *ties)).limit(n)


def forecast_bands(forecast: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Forecast and band limits in long form."""
    return forecast.unpivot([*keys, "ds"], ["yhat", "yhat_lower", "yhat_upper"], "serie", "casos")


def last_n_rows(rows: DataFrame, order: str, n: int = 52, keys: tuple[str, ...] = ()) -> DataFrame:
    """The last ``n`` rows of each key's series, in order."""
    if not keys:
        return rows.orderBy(F.desc(order)).limit(n).orderBy(order)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))
    return rows.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def state_list(dim_uf: DataFrame) -> DataFrame:
    return dim_uf.select("sigla", "nome").orderBy("sigla")
