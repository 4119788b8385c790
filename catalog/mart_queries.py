"""Joins, marts and report frames over the derived fact."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.given import FIRST_YEAR, LAST_YEAR, query, sql_pct, with_fact
from sentinela.plans import marts, reports, sqlnames
from sentinela.schemas import CODE_LISTS
from sentinela.session import written

YEARS = list(range(FIRST_YEAR, LAST_YEAR + 1))

CONF = "count(CASE WHEN cod_classificacao = 1 THEN 1 END)"
DEATHS = "count(CASE WHEN cod_evolucao = 2 THEN 1 END)"
MONDAY = "CAST(date_trunc('week', dt_sintomas) AS DATE)"
IN_WEEK = "dt_sintomas IS NOT NULL AND sem_sintomas BETWEEN 1 AND 53"

# Marts as the checking engine computes them; reports build on the same text.
SQL_WEEKLY_STATE = f"""SELECT u.sigla AS uf, u.regiao, nu_ano AS ano, sem_sintomas AS semana_epi,
  min({MONDAY}) AS inicio_sem, count(*) AS casos_total, {CONF} AS casos_confirmados
  FROM fato JOIN dim_uf u ON u.cod_uf = cod_uf_resi WHERE {IN_WEEK} GROUP BY ALL"""
SQL_STATE_YEAR = f"""SELECT u.cod_uf, u.sigla AS uf, u.nome AS uf_nome, u.regiao, nu_ano AS ano,
  count(*) AS casos_total, {CONF} AS casos_confirmados, {DEATHS} AS obitos, {sql_pct(CONF, 'count(*)')} AS taxa_confirmacao_pct
  FROM fato JOIN dim_uf u ON u.cod_uf = cod_uf_resi GROUP BY ALL"""
SQL_PYRAMID = f"""SELECT faixa_etaria, s.descricao AS sexo, nu_ano AS ano, {CONF} AS casos_confirmados, count(*) AS casos_total
  FROM fato LEFT JOIN dim_sexo s ON s.cod = cod_sexo WHERE faixa_etaria IS NOT NULL AND cod_sexo IN ('M', 'F') GROUP BY ALL"""
SQL_PREGNANCY = f"""SELECT nu_ano AS ano, u.sigla AS uf, t.descricao AS trimestre, {CONF} AS gestantes_confirmadas,
  count(*) AS gestantes_notificadas, {sql_pct('sum(idade_anos * 100)', '(100 * count(idade_anos))', 1, 1)} AS idade_media, {DEATHS} AS obitos
  FROM fato LEFT JOIN dim_uf u ON u.cod_uf = cod_uf_resi LEFT JOIN dim_gestante t ON t.cod = cod_gestante
  WHERE cod_gestante IN (1, 2, 3, 4) GROUP BY nu_ano, u.sigla, t.descricao"""
SQL_PROFILE = f"""SELECT nu_ano AS ano, s.descricao AS sexo, r.descricao AS raca_cor, e.descricao AS escolaridade,
  {CONF} AS confirmados, count(*) AS notificados
  FROM fato LEFT JOIN dim_sexo s ON s.cod = cod_sexo LEFT JOIN dim_raca r ON r.cod = cod_raca
  LEFT JOIN dim_escolaridade e ON e.cod = cod_escolaridade GROUP BY ALL"""
SQL_LATENCY = f"""SELECT nu_ano AS ano, u.sigla AS uf, count(*) AS n,
  {sql_pct('sum(dias)', 'count(*)', 1, 1)} AS latencia_media_dias,
  CAST(quantile_cont(CAST(dias AS DOUBLE), 0.5) AS DOUBLE) AS latencia_mediana
  FROM (SELECT *, date_diff('day', dt_sintomas, dt_notificacao) AS dias FROM fato) LEFT JOIN dim_uf u ON u.cod_uf = cod_uf_resi
  WHERE dias BETWEEN 0 AND 365 GROUP BY nu_ano, u.sigla"""
SQL_COMPLETENESS = "SELECT nu_ano AS ano, count(*) AS total, " + ", ".join(
    f"{sql_pct(f'count({column})', 'count(*)', 1)} AS {name}" for name, column in marts.WATCHED_COLUMNS.items()
) + " FROM fato GROUP BY nu_ano"
SQL_FEATURES = f"""SELECT m.cod_municipio, m.nome AS municipio, u.sigla AS uf, {CONF} AS confirmados, {DEATHS} AS obitos,
  count(CASE WHEN cod_gestante IN (1, 2, 3, 4) THEN 1 END) AS gestantes,
  {sql_pct('sum(idade_anos * 100)', '(100 * count(idade_anos))', 2, 1)} AS idade_media, count(*) AS notificacoes
  FROM fato JOIN dim_municipio m ON m.cod_municipio = cod_mun_resi JOIN dim_uf u ON u.cod_uf = m.cod_uf
  GROUP BY m.cod_municipio, m.nome, u.sigla HAVING count(*) >= 30"""


def weekly_state(g):
    return marts.weekly_series_state(g.fact, g.uf)


def state_year(g):
    return marts.state_year_cases(g.fact, g.uf)


def pyramid(g):
    return marts.age_pyramid(g.fact, g.list("sexo"))


def pregnancies(g):
    return marts.pregnancy_watch(g.fact, g.uf, g.list("gestante"))


def profile(g):
    return marts.demographic_profile(g.fact, g.list("sexo"), g.list("raca"), g.list("escolaridade"))


def latency(g):
    return marts.notification_latency(g.fact, g.uf)


# Joins.

@query(
    with_fact(
        """SELECT u.sigla AS uf, cod_classificacao, count(*) AS n_fichas
        FROM fato LEFT JOIN dim_uf u ON u.cod_uf = cod_uf_resi GROUP BY ALL"""
    )
)
def join_state_left(g):
    counts = g.fact.groupBy("cod_uf_resi", "cod_classificacao").agg(marts.total("n_fichas"))
    joined = marts.state_of(counts, g.uf, "cod_uf_resi", "left")
    return joined.groupBy(F.col("sigla").alias("uf"), "cod_classificacao").agg(*marts.sums("n_fichas"))


@query(
    with_fact(
        """SELECT u.sigla AS uf, u.regiao, cod_classificacao, count(*) AS n_fichas
        FROM fato JOIN dim_uf u ON u.cod_uf = cod_uf_resi GROUP BY ALL"""
    )
)
def join_state_inner(g):
    counts = g.fact.groupBy("cod_uf_resi", "cod_classificacao").agg(marts.total("n_fichas"))
    joined = marts.state_of(counts, g.uf, "cod_uf_resi", "inner")
    return joined.select(F.col("sigla").alias("uf"), "regiao", "cod_classificacao", "n_fichas")


@query(
    with_fact(
        """SELECT m.cod_municipio, m.nome AS municipio, u.sigla AS uf, count(*) AS n_fichas
        FROM fato JOIN dim_municipio m ON m.cod_municipio = cod_mun_notif JOIN dim_uf u ON u.cod_uf = m.cod_uf GROUP BY ALL"""
    )
)
def join_municipality_state(g):
    counts = g.fact.groupBy("cod_mun_notif").agg(marts.total("n_fichas"))
    return marts.municipality_of(counts, g.municipio, g.uf, "cod_mun_notif").select(
        "cod_municipio", "municipio", "uf", "n_fichas"
    )


@query(
    with_fact(
        """SELECT s.descricao AS sexo, r.descricao AS raca_cor, e.descricao AS escolaridade, p.descricao AS gestante, count(*) AS n_fichas
        FROM fato LEFT JOIN dim_sexo s ON s.cod = cod_sexo LEFT JOIN dim_raca r ON r.cod = cod_raca
        LEFT JOIN dim_escolaridade e ON e.cod = cod_escolaridade LEFT JOIN dim_gestante p ON p.cod = cod_gestante GROUP BY ALL"""
    )
)
def join_categories_left(g):
    labels = {"sexo": "sexo", "raca": "raca_cor", "escolaridade": "escolaridade", "gestante": "gestante"}
    rows = g.fact.groupBy(*[f"cod_{name}" for name in labels]).agg(marts.total("n_fichas"))
    for name, label in labels.items():
        rows = marts.label_of(rows, g.list(name), f"cod_{name}", label)
    return rows.groupBy(*labels.values()).agg(*marts.sums("n_fichas"))


@query(
    with_fact(
        f"""SELECT uf, ano, semana_epi, casos_total FROM ({SQL_WEEKLY_STATE}) WHERE uf IN (
        SELECT sigla FROM fato JOIN dim_uf ON cod_uf = cod_uf_resi WHERE {IN_WEEK}
        GROUP BY sigla ORDER BY count(*) DESC, sigla LIMIT 10)"""
    )
)
def top_members_semi(g):
    """Weekly rows of the ten states with most cases, as a semi-join with the leaders."""
    weekly = weekly_state(g)
    leaders = reports.top_members(weekly, "uf", "casos_total", 10).select("uf")
    return weekly.join(leaders, "uf", "left_semi").select("uf", "ano", "semana_epi", "casos_total")


# Marts.

@query(
    with_fact(
        f"""SELECT nu_ano AS ano, sem_sintomas AS semana_epi, min({MONDAY}) AS inicio_sem, count(*) AS casos_total,
        {CONF} AS casos_confirmados, count(CASE WHEN cod_classificacao = 0 THEN 1 END) AS casos_descartados,
        count(CASE WHEN cod_classificacao = 2 THEN 1 END) AS casos_em_invest, {DEATHS} AS obitos
        FROM fato WHERE {IN_WEEK} GROUP BY ALL"""
    )
)
def weekly_series(g):
    return marts.weekly_series(g.fact)


@query(with_fact(SQL_WEEKLY_STATE))
def weekly_series_state(g):
    return weekly_state(g)


@query(with_fact(SQL_STATE_YEAR))
def state_year_cases(g):
    return state_year(g)


@query(with_fact(SQL_PYRAMID))
def age_pyramid(g):
    return pyramid(g)


@query(with_fact(SQL_PREGNANCY))
def pregnancy_watch(g):
    return pregnancies(g)


@query(
    with_fact(
        f"""SELECT m.cod_municipio, m.nome AS municipio, u.sigla AS uf, nu_ano AS ano, {CONF} AS casos_confirmados,
        count(*) AS casos_total, {DEATHS} AS obitos, count(CASE WHEN cod_gestante IN (1, 2, 3, 4) THEN 1 END) AS gestantes
        FROM fato JOIN dim_municipio m ON m.cod_municipio = cod_mun_resi JOIN dim_uf u ON u.cod_uf = m.cod_uf GROUP BY ALL"""
    )
)
def municipality_ranking(g):
    return marts.municipality_ranking(g.fact, g.municipio, g.uf)


@query(with_fact(SQL_PROFILE))
def demographic_profile(g):
    return profile(g)


SQL_KPIS = f"""SELECT count(*) AS total_notificacoes, {CONF} AS total_confirmados,
        count(CASE WHEN cod_classificacao = 0 THEN 1 END) AS total_descartados, {DEATHS} AS total_obitos,
        count(CASE WHEN cod_gestante IN (1, 2, 3, 4) AND cod_classificacao = 1 THEN 1 END) AS gestantes_confirmadas,
        count(DISTINCT cod_mun_resi) AS municipios_afetados, count(DISTINCT cod_uf_resi) AS ufs_afetadas,
        {sql_pct(CONF, 'count(*)')} AS taxa_confirmacao_pct, {sql_pct(DEATHS, CONF)} AS letalidade_pct,
        min(dt_sintomas) AS dt_inicio, max(dt_sintomas) AS dt_fim FROM fato"""


@query(with_fact(SQL_KPIS))
def kpis(g):
    return marts.kpis(g.fact)


@query(with_fact(f"SELECT * REPLACE (true AS municipios_afetados) FROM ({SQL_KPIS})"))
def kpis_of_sketches(g):
    """Headline figures from stored sketches; whether the estimated municipalities lie within 5 % of their number."""
    sketches = written(marts.kpi_sketches(g.fact), "sketches")
    exact = g.fact.agg(F.count_distinct("cod_mun_resi")).scalar()
    near = F.abs(F.col("municipios_afetados") / exact - 1) <= 0.05
    return marts.kpis_of_sketches(sketches).withColumn("municipios_afetados", near)


@query(with_fact(SQL_LATENCY))
def notification_latency(g):
    return latency(g)


@query(with_fact(SQL_COMPLETENESS))
def completeness(g):
    return marts.completeness(g.fact)


def sql_summary(where: str = "") -> str:
    return f"""SELECT u.sigla AS uf_sigla, nu_ano AS ano, count(*) AS total_notificacoes, {CONF} AS total_confirmados,
        {sql_pct(CONF, 'count(*)')} AS taxa_confirmacao_pct, {DEATHS} AS total_obitos, {sql_pct(DEATHS, CONF)} AS letalidade_pct,
        count(CASE WHEN cod_classificacao = 1 AND cod_gestante IN (1, 2, 3) THEN 1 END) AS gestantes_confirmadas,
        CAST(floor(quantile_cont(CAST(idade_anos * 100 AS DOUBLE), 0.5) + 0.5) / 100 AS DECIMAL(18,2)) AS idade_mediana_anos
        FROM fato LEFT JOIN dim_uf u ON u.cod_uf = cod_uf_resi {where} GROUP BY u.sigla, nu_ano"""


@query(with_fact(sql_summary()))
def epi_summary(g):
    return marts.epi_summary(g.fact, g.uf)


@query(with_fact(sql_summary("WHERE u.sigla = 'NATION_7' AND nu_ano = 1998")))
def epi_summary_one_state(g):
    return marts.epi_summary(g.fact, g.uf, uf="NATION_7", year=1998)


def sql_curve(where: str) -> str:
    return f"""SELECT nu_ano AS ano, sem_sintomas AS semana_epi, {MONDAY} AS inicio_sem, count(*) AS casos_total,
        {CONF} AS casos_confirmado FROM fato LEFT JOIN dim_uf u ON u.cod_uf = cod_uf_resi
        WHERE sem_sintomas IS NOT NULL AND {where} GROUP BY ALL"""


@query(with_fact(sql_curve(f"nu_ano BETWEEN {FIRST_YEAR} AND {LAST_YEAR}")))
def weekly_curve(g):
    return marts.weekly_curve(g.fact, g.uf, first_year=FIRST_YEAR, last_year=LAST_YEAR)


@query(with_fact(sql_curve("nu_ano BETWEEN 1997 AND 1998 AND u.sigla = 'NATION_7'")))
def weekly_curve_one_state(g):
    return marts.weekly_curve(g.fact, g.uf, "NATION_7", 1997, 1998)


@query(with_fact(SQL_FEATURES))
def municipality_features(g):
    return marts.municipality_features(g.fact, g.municipio, g.uf)


@query(
    with_fact(
        f"""SELECT faixa_etaria, sexo, CAST(sum(casos_confirmados) AS BIGINT) AS n FROM ({SQL_PYRAMID})
        WHERE faixa_etaria <> 'Ignorada' GROUP BY ALL"""
    )
)
def pyramid_totals(g):
    return marts.pyramid_totals(pyramid(g))


@query(
    with_fact(
        f"""SELECT count(*) AS total_notificacoes, count(DISTINCT cod_mun_notif) AS municipios_notificacao,
        count(DISTINCT cod_mun_resi) AS municipios_residencia, min(dt_sintomas) AS primeira_data, max(dt_sintomas) AS ultima_data,
        count(*) - count(cod_mun_resi) AS sem_municipio_resi, {CONF} AS confirmados, {DEATHS} AS obitos FROM fato"""
    )
)
def load_summary(g):
    return marts.load_summary(g.fact)


# Reports.

@query(
    with_fact(
        f"""SELECT CAST(row_number() OVER (ORDER BY casos DESC, uf) AS INT) AS posicao, uf, uf_nome, regiao, casos, obitos, taxa_confirmacao_pct
        FROM (SELECT uf, uf_nome, regiao, CAST(sum(casos_total) AS BIGINT) AS casos, CAST(sum(obitos) AS BIGINT) AS obitos,
          {sql_pct('sum(casos_confirmados)', 'sum(casos_total)')} AS taxa_confirmacao_pct
          FROM ({SQL_STATE_YEAR}) GROUP BY uf, uf_nome, regiao)"""
    )
)
def state_rank(g):
    return reports.state_rank(state_year(g))


@query(
    with_fact(
        f"""SELECT inicio_sem, CAST(sum(casos_total) AS BIGINT) AS casos FROM ({SQL_WEEKLY_STATE})
        GROUP BY inicio_sem ORDER BY inicio_sem DESC LIMIT 52"""
    )
)
def last_n_rows(g):
    return reports.last_n_rows(reports.national_curve(weekly_state(g)), "inicio_sem", 52)


@query(
    with_fact(f"SELECT inicio_sem, CAST(sum(casos_total) AS BIGINT) AS casos FROM ({SQL_WEEKLY_STATE}) GROUP BY inicio_sem")
)
def national_curve(g):
    return reports.national_curve(weekly_state(g))


@query(
    with_fact(
        f"""SELECT * FROM ({SQL_WEEKLY_STATE}) WHERE uf IN (SELECT uf FROM ({SQL_WEEKLY_STATE})
        GROUP BY uf ORDER BY sum(casos_confirmados) DESC, uf LIMIT 10)"""
    )
)
def top_state_curves(g):
    measure = reports.choose_measure(only_confirmed=True)
    return reports.top_state_curves(weekly_state(g), measure).select(
        "uf", "regiao", "ano", "semana_epi", "inicio_sem", "casos_total", "casos_confirmados"
    )


@query(
    with_fact(
        f"SELECT ano, semana_epi, CAST(sum(casos_total) AS BIGINT) AS casos_total FROM ({SQL_WEEKLY_STATE}) GROUP BY ALL"
    )
)
def seasonal_profile(g):
    return reports.seasonal_profile(weekly_state(g))


@query(
    with_fact(
        f"""SELECT cod_uf, uf, uf_nome, regiao, CAST(sum(casos_total) AS BIGINT) AS casos, CAST(sum(obitos) AS BIGINT) AS obitos,
        {sql_pct('sum(casos_confirmados)', 'sum(casos_total)')} AS taxa_confirmacao_pct,
        CAST(sum(taxa_confirmacao_pct) AS DECIMAL(18,2)) AS taxa_somada FROM ({SQL_STATE_YEAR}) GROUP BY cod_uf, uf, uf_nome, regiao"""
    )
)
def state_totals(g):
    return reports.state_totals(state_year(g))


@query(
    with_fact(
        "SELECT uf, "
        + ", ".join(f'CAST(sum(CASE WHEN ano = {y} THEN casos_total ELSE 0 END) AS BIGINT) AS "{y}"' for y in YEARS)
        + f" FROM ({SQL_STATE_YEAR}) GROUP BY uf"
    )
)
def state_year_matrix(g):
    return reports.state_year_matrix(state_year(g), YEARS)


@query(
    with_fact(
        f"""SELECT uf, CAST(sum(casos_total) AS BIGINT) AS casos FROM ({SQL_STATE_YEAR}) GROUP BY uf
        ORDER BY casos DESC, uf LIMIT 8"""
    )
)
def top_states(g):
    return reports.top_states(state_year(g))


@query(
    with_fact(
        f"""SELECT o.ordem, p.faixa_etaria, p.sexo, CAST(CASE p.sexo WHEN 'Masculino' THEN -sum(casos_total) ELSE sum(casos_total) END AS BIGINT) AS casos
        FROM ({SQL_PYRAMID}) p LEFT JOIN (VALUES ('<1 ano', 1), ('1-4', 2), ('5-9', 3), ('10-14', 4), ('15-19', 5), ('20-29', 6),
          ('30-39', 7), ('40-49', 8), ('50-59', 9), ('60-69', 10), ('70-79', 11), ('80+', 12)) o(faixa, ordem) ON o.faixa = p.faixa_etaria
        GROUP BY o.ordem, p.faixa_etaria, p.sexo"""
    )
)
def pyramid_mirrored(g):
    return reports.pyramid_mirrored(pyramid(g))


@query(
    with_fact(
        f"""SELECT faixa_etaria, CAST(coalesce(sum(CASE WHEN sexo = 'Masculino' THEN casos_confirmados END), 0) AS BIGINT) AS "Masculino",
        CAST(coalesce(sum(CASE WHEN sexo = 'Feminino' THEN casos_confirmados END), 0) AS BIGINT) AS "Feminino"
        FROM ({SQL_PYRAMID}) WHERE faixa_etaria <> 'Ignorada' GROUP BY faixa_etaria"""
    )
)
def pyramid_pivot(g):
    return reports.pyramid_pivot(marts.pyramid_totals(pyramid(g)))


@query(
    with_fact(
        f"""SELECT raca_cor, CAST(sum(notificados) AS BIGINT) AS notificados FROM ({SQL_PROFILE})
        WHERE raca_cor IS NOT NULL GROUP BY raca_cor"""
    )
)
def by_race(g):
    return reports.by_race(profile(g))


@query(
    with_fact(
        f"""SELECT escolaridade, CAST(sum(confirmados) AS BIGINT) AS confirmados FROM ({SQL_PROFILE})
        WHERE escolaridade IS NOT NULL GROUP BY escolaridade"""
    )
)
def by_schooling(g):
    return reports.by_schooling(profile(g), reports.choose_measure(True, "confirmados", "notificados"))


@query(
    with_fact(
        f"""SELECT CAST(sum(gestantes_notificadas) AS BIGINT) AS gestantes_notificadas,
        CAST(sum(gestantes_confirmadas) AS BIGINT) AS gestantes_confirmadas, CAST(sum(obitos) AS BIGINT) AS obitos,
        {sql_pct('sum(gestantes_confirmadas)', 'greatest(sum(gestantes_notificadas), 1)', 1)} AS taxa_pct FROM ({SQL_PREGNANCY})"""
    )
)
def pregnancy_totals(g):
    return reports.pregnancy_totals(pregnancies(g))


@query(
    with_fact(
        f"""SELECT ano, trimestre, CAST(sum(gestantes_confirmadas) AS BIGINT) AS gestantes_confirmadas
        FROM ({SQL_PREGNANCY}) GROUP BY ALL"""
    )
)
def pregnancy_by_trimester(g):
    return reports.pregnancy_by_trimester(pregnancies(g))


@query(
    with_fact(
        f"""SELECT uf, CAST(sum(gestantes_confirmadas) AS BIGINT) AS gestantes_confirmadas FROM ({SQL_PREGNANCY})
        WHERE uf IS NOT NULL GROUP BY uf ORDER BY gestantes_confirmadas DESC, uf LIMIT 15"""
    )
)
def pregnancy_top_states(g):
    return reports.pregnancy_top_states(pregnancies(g))


@query(with_fact(SQL_PREGNANCY))
def pregnancy_table(g):
    return reports.pregnancy_table(pregnancies(g))


@query(
    with_fact(
        " UNION ALL ".join(
            f"SELECT ano, '{name}' AS campo, {name} AS completude, {name} >= 80 AS atinge_meta FROM ({SQL_COMPLETENESS})"
            for name in marts.WATCHED_COLUMNS
        )
    )
)
def completeness_long(g):
    return reports.completeness_long(marts.completeness(g.fact))


@query(
    with_fact(
        "SELECT ano, "
        + ", ".join(
            f"CAST(round(quantile_cont(CAST(latencia_media_dias AS DOUBLE), {q}), 4) AS DECIMAL(9,4)) AS {name}"
            for q, name in [(0, "minimo"), (0.25, "q1"), (0.5, "mediana"), (0.75, "q3"), (1, "maximo")]
        )
        + f" FROM ({SQL_LATENCY}) GROUP BY ano"
    )
)
def latency_box(g):
    boxes = reports.latency_box(latency(g))
    return boxes.select("ano", *[F.round(c, 4).cast("decimal(9,4)").alias(c) for c in boxes.columns[1:]])


@query(with_fact("SELECT sigla, nome FROM dim_uf"))
def state_list(g):
    return reports.state_list(g.uf)


# The same marts through SQL names.


def sql_session(g):
    lists = {name: g.list(name) for name in CODE_LISTS}
    return sqlnames.register_sql(g.fact, sqlnames.Dimensions(g.uf, g.municipio, lists))


@query(with_fact(sql_summary("WHERE u.sigla = 'NATION_7'")))
def sql_epi_summary(g):
    return sql_session(g).sql("SELECT * FROM fn_resumo_epidemiologico('NATION_7')")


@query(with_fact(sql_curve("nu_ano BETWEEN 1997 AND 1998")))
def sql_weekly_curve(g):
    return sql_session(g).sql("SELECT * FROM fn_curva_semanal(p_ano_inicio => 1997, p_ano_fim => 1998)")


@query(
    with_fact(
        f"SELECT uf, sum(casos_confirmados)::BIGINT AS casos FROM ({SQL_WEEKLY_STATE}) WHERE ano BETWEEN 1996 AND 1999 GROUP BY uf"
    )
)
def sql_weekly_series_state(g):
    return sql_session(g).sql(
        "SELECT uf, SUM(casos_confirmados) AS casos FROM vw_serie_semanal_uf WHERE ano BETWEEN 1996 AND 1999 GROUP BY uf"
    )


@query(with_fact("SELECT id_notif, idade_decodificada, faixa_etaria FROM fato"))
def sql_age_functions(g):
    return sql_session(g).sql(
        """SELECT id_notif, fn_decodifica_idade(nu_idade_codificada) AS idade_decodificada,
        fn_faixa_etaria(fn_decodifica_idade(nu_idade_codificada)) AS faixa_etaria FROM fato_notificacao"""
    )
