"""Aggregates over the notification fact.

Every mart reduces the fact on its own code columns before it meets a dimension. The fact is
thus scanned once, combined on the map side and never shuffled row by row, a hot state or
municipality costs one partial row per task, and the join that adds labels has only grouped rows
on its left. No join carries a broadcast hint: Spark compares the dimension's size with
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and merges.

Dimension keys and state abbreviations are unique, so an inner join keeps the groups as they are.
A second, small grouping follows only the left joins, whose missing labels may merge groups.
Medians are taken from value histograms (value, frequency) and means from exact sums.
Marts are unsorted; reports sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentinela.functions.dates import days_between, week_start
from sentinela.functions.numbers import hundredths, median_of_hundredths, rounded_ratio, safe_pct
from sentinela.operators.filters import (
    band_known,
    having_min_rows,
    latency_window,
    pregnant,
    sex_known,
    valid_week,
)
from sentinela.schemas import (
    CONFIRMED,
    DIED,
    DISCARDED,
    INVESTIGATING,
    PREGNANT,
    PREGNANT_KNOWN_TRIMESTER,
)


def confirmed() -> Column:
    return F.col("cod_classificacao") == CONFIRMED


def died() -> Column:
    return F.col("cod_evolucao") == DIED


def total(name: str = "casos_total") -> Column:
    return F.count(F.lit(1)).alias(name)


def count_of(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def sums(*names: str) -> list[Column]:
    return [F.sum(name).alias(name) for name in names]


def whole(name: str) -> Column:
    """Sum of partial counts in a one-row result: 0 for an empty table."""
    return F.coalesce(F.sum(name), F.lit(0).cast("bigint")).alias(name)


def state_of(grouped: DataFrame, dim_uf: DataFrame, code: str, how: str) -> DataFrame:
    """Add the state row of a code column to grouped data."""
    return grouped.join(dim_uf, grouped[code] == dim_uf["cod_uf"], how)


def label_of(grouped: DataFrame, dim: DataFrame, code: str, label: str) -> DataFrame:
    """Add a category's description under ``label``; unknown codes get NULL."""
    named = dim.select(F.col("cod").alias(f"{label}_cod"), F.col("descricao").alias(label))
    return grouped.join(named, grouped[code] == named[f"{label}_cod"], "left")


def of_state(fact: DataFrame, dim_uf: DataFrame, uf: str | None, code: str) -> DataFrame:
    """Restrict the fact to one state before it is grouped.

    The state's code is a scalar subquery, so the scan gets a plain equality to skip row groups by.
    """
    if uf is None:
        return fact
    return fact.where(F.col(code) == dim_uf.where(F.col("sigla") == uf).select("cod_uf").scalar())


def weekly_series(fact: DataFrame) -> DataFrame:
    """National epidemic curve: one row per year and week."""
    return (
        fact.where(valid_week())
        .groupBy(F.col("nu_ano").alias("ano"), F.col("sem_sintomas").alias("semana_epi"))
        .agg(
            week_start(F.min("dt_sintomas")).alias("inicio_sem"),
            total(),
            count_of(confirmed(), "casos_confirmados"),
            count_of(F.col("cod_classificacao") == DISCARDED, "casos_descartados"),
            count_of(F.col("cod_classificacao") == INVESTIGATING, "casos_em_invest"),
            count_of(died(), "obitos"),
        )
    )


def weekly_series_state(fact: DataFrame, dim_uf: DataFrame, role: str = "resi") -> DataFrame:
    """Epidemic curve per state, year and week; ``role`` is resi, notif or infec."""
    code = f"cod_uf_{role}"
    weekly = (
        fact.where(valid_week() & F.col(code).isNotNull())
        .groupBy(code, "nu_ano", "sem_sintomas")
        .agg(
            F.min("dt_sintomas").alias("primeiro_dia"),
            total(),
            count_of(confirmed(), "casos_confirmados"),
        )
    )
    return state_of(weekly, dim_uf, code, "inner").select(
        F.col("sigla").alias("uf"),
        "regiao",
        F.col("nu_ano").alias("ano"),
        F.col("sem_sintomas").alias("semana_epi"),
        week_start(F.col("primeiro_dia")).alias("inicio_sem"),
        "casos_total",
        "casos_confirmados",
    )


def state_year_cases(fact: DataFrame, dim_uf: DataFrame, role: str = "resi") -> DataFrame:
    """Cases, deaths and confirmation rate per state and year."""
    code = f"cod_uf_{role}"
    yearly = (
        fact.where(F.col(code).isNotNull())
        .groupBy(code, F.col("nu_ano").alias("ano"))
        .agg(total(), count_of(confirmed(), "casos_confirmados"), count_of(died(), "obitos"))
    )
    return state_of(yearly, dim_uf, code, "inner").select(
        "cod_uf",
        F.col("sigla").alias("uf"),
        F.col("nome").alias("uf_nome"),
        "regiao",
        "ano",
        "casos_total",
        "casos_confirmados",
        "obitos",
        safe_pct(F.col("casos_confirmados"), F.col("casos_total")).alias("taxa_confirmacao_pct"),
    )


def age_pyramid(fact: DataFrame, dim_sexo: DataFrame) -> DataFrame:
    """Cases per age band, sex and year."""
    bands = (
        fact.where(F.col("faixa_etaria").isNotNull() & sex_known())
        .groupBy("faixa_etaria", "cod_sexo", F.col("nu_ano").alias("ano"))
        .agg(count_of(confirmed(), "casos_confirmados"), total())
    )
    return (
        label_of(bands, dim_sexo, "cod_sexo", "sexo")
        .groupBy("faixa_etaria", "sexo", "ano")
        .agg(*sums("casos_confirmados", "casos_total"))
    )


def pregnancy_watch(
    fact: DataFrame, dim_uf: DataFrame, dim_gestante: DataFrame, codes: tuple[int, ...] = PREGNANT
) -> DataFrame:
    """Notified pregnancies per year, state and trimester, with mean age."""
    grouped = (
        fact.where(pregnant(codes))
        .groupBy("nu_ano", "cod_uf_resi", "cod_gestante")
        .agg(
            count_of(confirmed(), "gestantes_confirmadas"),
            total("gestantes_notificadas"),
            F.sum(hundredths(F.col("idade_anos"))).alias("soma_idade"),
            F.count("idade_anos").alias("n_idade"),
            count_of(died(), "obitos"),
        )
    )
    labelled = label_of(
        state_of(grouped, dim_uf, "cod_uf_resi", "left"), dim_gestante, "cod_gestante", "trimestre"
    )
    return (
        labelled.groupBy(F.col("nu_ano").alias("ano"), F.col("sigla").alias("uf"), "trimestre")
        .agg(*sums("gestantes_confirmadas", "gestantes_notificadas", "soma_idade", "n_idade", "obitos"))
        .select(
            "ano",
            "uf",
            "trimestre",
            "gestantes_confirmadas",
            "gestantes_notificadas",
            rounded_ratio(F.col("soma_idade"), F.col("n_idade") * 100, 1).alias("idade_media"),
            "obitos",
        )
    )


def municipality_of(grouped: DataFrame, dim_municipio: DataFrame, dim_uf: DataFrame, code: str) -> DataFrame:
    """Add municipality and the municipality's own state; rows without both are left out."""
    places = dim_municipio.select(
        "cod_municipio", F.col("nome").alias("municipio"), F.col("cod_uf").alias("uf_do_municipio")
    )
    ufs = dim_uf.select(F.col("cod_uf").alias("uf_chave"), F.col("sigla").alias("uf"))
    return grouped.join(places, grouped[code] == places["cod_municipio"]).join(
        ufs, F.col("uf_do_municipio") == F.col("uf_chave")
    )


def municipality_ranking(fact: DataFrame, dim_municipio: DataFrame, dim_uf: DataFrame) -> DataFrame:
    """Cases, deaths and pregnancies per municipality and year."""
    yearly = (
        fact.where(F.col("cod_mun_resi").isNotNull())
        .groupBy("cod_mun_resi", F.col("nu_ano").alias("ano"))
        .agg(
            count_of(confirmed(), "casos_confirmados"),
            total(),
            count_of(died(), "obitos"),
            count_of(pregnant(), "gestantes"),
        )
    )
    return municipality_of(yearly, dim_municipio, dim_uf, "cod_mun_resi").select(
        "cod_municipio", "municipio", "uf", "ano", "casos_confirmados", "casos_total", "obitos", "gestantes"
    )


def demographic_profile(
    fact: DataFrame, dim_sexo: DataFrame, dim_raca: DataFrame, dim_escolaridade: DataFrame
) -> DataFrame:
    """Cases per year, sex, race and schooling; missing categories stay as NULL groups."""
    grouped = fact.groupBy("nu_ano", "cod_sexo", "cod_raca", "cod_escolaridade").agg(
        count_of(confirmed(), "confirmados"), total("notificados")
    )
    labelled = label_of(grouped, dim_sexo, "cod_sexo", "sexo")
    labelled = label_of(labelled, dim_raca, "cod_raca", "raca_cor")
    labelled = label_of(labelled, dim_escolaridade, "cod_escolaridade", "escolaridade")
    return labelled.groupBy(F.col("nu_ano").alias("ano"), "sexo", "raca_cor", "escolaridade").agg(
        *sums("confirmados", "notificados")
    )


# Logarithm of a sketch's size: a relative standard error of 1.04 / sqrt(4096), or 1.6 %.
SKETCH_LOG = 12


def kpi_sketches(fact: DataFrame, log_size: int = SKETCH_LOG) -> DataFrame:
    """Mergeable headline figures per year and state, to be stored; places as HyperLogLog sketches.

    A sketch is at most a few kilobytes, however many rows it stands for; a new year is added
    without reading the others.
    """
    return fact.groupBy(F.col("nu_ano").alias("ano"), "cod_uf_resi").agg(
        total("total_notificacoes"),
        count_of(confirmed(), "total_confirmados"),
        count_of(F.col("cod_classificacao") == DISCARDED, "total_descartados"),
        count_of(died(), "total_obitos"),
        count_of(pregnant() & confirmed(), "gestantes_confirmadas"),
        F.hll_sketch_agg("cod_mun_resi", log_size).alias("municipios"),
        F.min("dt_sintomas").alias("dt_inicio"),
        F.max("dt_sintomas").alias("dt_fim"),
    )


def kpis_of_sketches(sketches: DataFrame) -> DataFrame:
    """``kpis`` from stored sketches of any years and states; ``municipios_afetados`` is an estimate."""
    counts = ["total_notificacoes", "total_confirmados", "total_descartados", "total_obitos", "gestantes_confirmadas"]
    merged = sketches.agg(
        *[whole(name) for name in counts],
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("municipios")), F.lit(0).cast("bigint")).alias("municipios_afetados"),
        F.count_distinct("cod_uf_resi").alias("ufs_afetadas"),
        F.min("dt_inicio").alias("dt_inicio"),
        F.max("dt_fim").alias("dt_fim"),
    )
    return _headline(merged, counts)


def _headline(merged: DataFrame, counts: list[str]) -> DataFrame:
    return merged.select(
        *counts,
        "municipios_afetados",
        "ufs_afetadas",
        safe_pct(F.col("total_confirmados"), F.col("total_notificacoes")).alias("taxa_confirmacao_pct"),
        safe_pct(F.col("total_obitos"), F.col("total_confirmados")).alias("letalidade_pct"),
        "dt_inicio",
        "dt_fim",
    )


def kpis(fact: DataFrame) -> DataFrame:
    """One row of headline figures, exact; ``kpis_of_sketches`` estimates the municipalities from stored sketches.

    Grouping by place first leaves the two distinct counts a few rows per municipality, so their
    row expansion does not touch the fact.
    """
    places = fact.groupBy("cod_mun_resi", "cod_uf_resi").agg(
        total("total_notificacoes"),
        count_of(confirmed(), "total_confirmados"),
        count_of(F.col("cod_classificacao") == DISCARDED, "total_descartados"),
        count_of(died(), "total_obitos"),
        count_of(pregnant() & confirmed(), "gestantes_confirmadas"),
        F.min("dt_sintomas").alias("dt_inicio"),
        F.max("dt_sintomas").alias("dt_fim"),
    )
    counts = ["total_notificacoes", "total_confirmados", "total_descartados", "total_obitos", "gestantes_confirmadas"]
    merged = places.agg(
        *[whole(name) for name in counts],
        F.count_distinct("cod_mun_resi").alias("municipios_afetados"),
        F.count_distinct("cod_uf_resi").alias("ufs_afetadas"),
        F.min("dt_inicio").alias("dt_inicio"),
        F.max("dt_fim").alias("dt_fim"),
    )
    return _headline(merged, counts)


def notification_latency(fact: DataFrame, dim_uf: DataFrame) -> DataFrame:
    """Days from symptoms to notification per year and state: count, mean, median."""
    histogram = (
        fact.where(latency_window())
        .groupBy(
            "nu_ano",
            "cod_uf_resi",
            days_between(F.col("dt_notificacao"), F.col("dt_sintomas")).alias("dias"),
        )
        .agg(total("fichas"))
    )
    return (
        state_of(histogram, dim_uf, "cod_uf_resi", "left")
        .groupBy(F.col("nu_ano").alias("ano"), F.col("sigla").alias("uf"))
        .agg(
            F.sum("fichas").alias("n"),
            F.sum(F.col("dias") * F.col("fichas")).alias("soma_dias"),
            F.percentile("dias", 0.5, F.col("fichas")).alias("latencia_mediana"),
        )
        .select(
            "ano",
            "uf",
            "n",
            rounded_ratio(F.col("soma_dias"), F.col("n"), 1).alias("latencia_media_dias"),
            "latencia_mediana",
        )
    )


# Completeness column -> fact column it watches.
WATCHED_COLUMNS = {
    "raca_pct": "cod_raca",
    "escolaridade_pct": "cod_escolaridade",
    "gestante_pct": "cod_gestante",
    "idade_pct": "idade_anos",
    "uf_resi_pct": "cod_uf_resi",
    "mun_resi_pct": "cod_mun_resi",
    "evolucao_pct": "cod_evolucao",
}


def completeness(fact: DataFrame, watched: dict[str, str] = WATCHED_COLUMNS) -> DataFrame:
    """Share of filled values per year for the watched columns."""
    filled = fact.groupBy(F.col("nu_ano").alias("ano")).agg(
        total("total"), *[F.count(column).alias(name) for name, column in watched.items()]
    )
    return filled.select(
        "ano", "total", *[safe_pct(F.col(name), F.col("total"), 1).alias(name) for name in watched]
    )


def epi_summary(
    fact: DataFrame,
    dim_uf: DataFrame,
    uf: str | None = None,
    year: int | None = None,
    codes: tuple[int, ...] = PREGNANT_KNOWN_TRIMESTER,
    with_code: bool = False,
) -> DataFrame:
    """Cases, rates, deaths, confirmed pregnancies and median age per state and year.

    ``with_code`` adds the state's code, a column by which a filter reaches the fact's files.
    """
    code = ["cod_uf"] if with_code else []
    if year is not None:
        fact = fact.where(F.col("nu_ano") == year)
    by_age = (
        of_state(fact, dim_uf, uf, "cod_uf_resi")
        .groupBy("cod_uf_resi", "nu_ano", hundredths(F.col("idade_anos")).alias("idade"))
        .agg(
            total("total_notificacoes"),
            count_of(confirmed(), "total_confirmados"),
            count_of(died(), "total_obitos"),
            count_of(confirmed() & pregnant(codes), "gestantes_confirmadas"),
        )
    )
    return (
        state_of(by_age, dim_uf, "cod_uf_resi", "left")
        .groupBy(F.col("sigla").alias("uf_sigla"), F.col("nu_ano").alias("ano"), *code)
        .agg(
            median_of_hundredths(F.col("idade"), F.col("total_notificacoes")).alias("idade_mediana_anos"),
            *sums("total_notificacoes", "total_confirmados", "total_obitos", "gestantes_confirmadas"),
        )
        .select(
            "uf_sigla",
            "ano",
            "total_notificacoes",
            "total_confirmados",
            safe_pct(F.col("total_confirmados"), F.col("total_notificacoes")).alias("taxa_confirmacao_pct"),
            "total_obitos",
            safe_pct(F.col("total_obitos"), F.col("total_confirmados")).alias("letalidade_pct"),
            "gestantes_confirmadas",
            "idade_mediana_anos",
            *code,
        )
    )


def curve_rows(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("dt_sintomas").isNotNull() & F.col("sem_sintomas").isNotNull())


def curve_keys() -> list[Column]:
    return [
        F.col("nu_ano").alias("ano"),
        F.col("sem_sintomas").alias("semana_epi"),
        week_start(F.col("dt_sintomas")).alias("inicio_sem"),
    ]


def weekly_curve(
    fact: DataFrame,
    dim_uf: DataFrame,
    uf: str | None = None,
    first_year: int | None = None,
    last_year: int | None = None,
) -> DataFrame:
    """Epidemic curve per year, week and Monday, open-ended unless years are given; weeks outside 1..53 are kept."""
    rows = curve_rows(fact)
    if first_year is not None:
        rows = rows.where(F.col("nu_ano") >= first_year)
    if last_year is not None:
        rows = rows.where(F.col("nu_ano") <= last_year)
    return (
        of_state(rows, dim_uf, uf, "cod_uf_resi")
        .groupBy(*curve_keys())
        .agg(total(), count_of(confirmed(), "casos_confirmado"))
    )


def weekly_curve_by_state(fact: DataFrame, dim_uf: DataFrame) -> DataFrame:
    """The epidemic curve of every state with its code, unknown states included under NULL."""
    counts = (
        curve_rows(fact)
        .groupBy("cod_uf_resi", *curve_keys())
        .agg(total(), count_of(confirmed(), "casos_confirmado"))
    )
    return (
        state_of(counts, dim_uf, "cod_uf_resi", "left")
        .groupBy(F.col("sigla").alias("uf"), "cod_uf", "ano", "semana_epi", "inicio_sem")
        .agg(*sums("casos_total", "casos_confirmado"))
    )


def municipality_features(
    fact: DataFrame, dim_municipio: DataFrame, dim_uf: DataFrame, least: int = 30
) -> DataFrame:
    """Epidemiological profile of each municipality with at least ``least`` notifications."""
    grouped = (
        fact.where(F.col("cod_mun_resi").isNotNull())
        .groupBy("cod_mun_resi")
        .agg(
            count_of(confirmed(), "confirmados"),
            count_of(died(), "obitos"),
            count_of(pregnant(), "gestantes"),
            F.sum(hundredths(F.col("idade_anos"))).alias("soma_idade"),
            F.count("idade_anos").alias("n_idade"),
            total("notificacoes"),
        )
    )
    profile = municipality_of(having_min_rows(grouped, "notificacoes", least), dim_municipio, dim_uf, "cod_mun_resi")
    return profile.select(
        "cod_municipio",
        "municipio",
        "uf",
        "confirmados",
        "obitos",
        "gestantes",
        rounded_ratio(F.col("soma_idade"), F.col("n_idade") * 100, 2).alias("idade_media"),
        "notificacoes",
    )


def pyramid_totals(pyramid: DataFrame) -> DataFrame:
    """Confirmed cases per known age band and sex over all years."""
    return pyramid.where(band_known()).groupBy("faixa_etaria", "sexo").agg(
        F.sum("casos_confirmados").alias("n")
    )


def load_summary(fact: DataFrame) -> DataFrame:
    """After-load diagnostics in one row; grouped by place first, like the headline figures."""
    places = fact.groupBy("cod_mun_notif", "cod_mun_resi").agg(
        total("total_notificacoes"),
        F.min("dt_sintomas").alias("primeira_data"),
        F.max("dt_sintomas").alias("ultima_data"),
        count_of(F.col("cod_mun_resi").isNull(), "sem_municipio_resi"),
        count_of(confirmed(), "confirmados"),
        count_of(died(), "obitos"),
    )
    return places.agg(
        whole("total_notificacoes"),
        F.count_distinct("cod_mun_notif").alias("municipios_notificacao"),
        F.count_distinct("cod_mun_resi").alias("municipios_residencia"),
        F.min("primeira_data").alias("primeira_data"),
        F.max("ultima_data").alias("ultima_data"),
        *[whole(name) for name in ("sem_municipio_resi", "confirmados", "obitos")],
    )
