from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from sentinela.plans import marts, reports
from sentinela.operators.filters import optional_filter
from sentinela.schemas import code_list, states

D = dt.date


def test_mart_keeps_the_earliest_monday_and_the_curve_keeps_both(spark, fact):
    rows = fact(
        {"dt_sintomas": D(2024, 1, 3), "sem_sintomas": 1, "nu_ano": 2024},
        {"dt_sintomas": D(2025, 1, 1), "sem_sintomas": 1, "nu_ano": 2024},
    )
    assert [r["inicio_sem"] for r in marts.weekly_series(rows).collect()] == [D(2024, 1, 1)]
    assert marts.weekly_curve(rows, states(spark)).count() == 2


def test_week_limits_apply_to_marts_but_not_to_the_curve(spark, fact):
    rows = fact(*[{"dt_sintomas": D(2024, 1, 3), "sem_sintomas": w, "nu_ano": 2024} for w in (0, 53, 54, None)])
    assert {r["semana_epi"] for r in marts.weekly_series(rows).collect()} == {53}
    assert {r["semana_epi"] for r in marts.weekly_curve(rows, states(spark)).collect()} == {0, 53, 54}


def test_lethality_counts_all_deaths_and_may_exceed_100(spark, fact):
    rows = fact(
        {"nu_ano": 2024, "cod_uf_resi": 26, "cod_classificacao": 1, "cod_evolucao": 2, "idade_anos": Decimal("1.50")},
        {"nu_ano": 2024, "cod_uf_resi": 26, "cod_classificacao": 0, "cod_evolucao": 2, "idade_anos": Decimal("2.25")},
        {"nu_ano": 2024, "cod_uf_resi": 26, "cod_classificacao": 0, "cod_evolucao": 2},
    )
    row = marts.epi_summary(rows, states(spark), uf="PE", year=2024).first()
    assert row["letalidade_pct"] == Decimal("300.00") and row["taxa_confirmacao_pct"] == Decimal("33.33")
    assert row["idade_mediana_anos"] == Decimal("1.88")


def test_unknown_and_missing_states_share_the_null_group(spark, fact):
    rows = fact({"nu_ano": 2024, "cod_uf_resi": 99}, {"nu_ano": 2024}, {"nu_ano": 2024, "cod_uf_resi": 26})
    got = {r["uf_sigla"]: r["total_notificacoes"] for r in marts.epi_summary(rows, states(spark)).collect()}
    assert got == {None: 2, "PE": 1}
    assert {r["uf"] for r in marts.state_year_cases(rows, states(spark)).collect()} == {"PE"}
    only = optional_filter(marts.epi_summary(rows, states(spark)), uf_sigla="PE", ano=None)
    assert only.count() == 1


def test_pregnancy_code_four_counts_in_marts_but_not_in_the_summary(spark, fact):
    rows = fact({"nu_ano": 2024, "cod_uf_resi": 26, "cod_gestante": 4, "cod_classificacao": 1, "idade_anos": Decimal("20.25")})
    assert marts.epi_summary(rows, states(spark)).first()["gestantes_confirmadas"] == 0
    watch = marts.pregnancy_watch(rows, states(spark), code_list(spark, "gestante")).first()
    assert watch["gestantes_confirmadas"] == 1 and watch["idade_media"] == Decimal("20.3")
    assert marts.kpis(rows).first()["gestantes_confirmadas"] == 1


def test_one_row_marts_of_an_empty_fact(fact):
    row = marts.kpis(fact({}).limit(0)).first()
    assert row["total_notificacoes"] == 0 and row["taxa_confirmacao_pct"] is None and row["dt_inicio"] is None
    assert marts.load_summary(fact({}).limit(0)).first()["total_notificacoes"] == 0


def test_latency_keeps_0_to_365_days(spark, fact):
    day = D(2024, 1, 1)
    rows = fact(*[{"nu_ano": 2024, "dt_sintomas": day, "dt_notificacao": day + dt.timedelta(days=n)} for n in (-1, 0, 1, 365, 366)])
    row = marts.notification_latency(rows, states(spark)).first()
    assert (row["n"], row["latencia_media_dias"], row["latencia_mediana"]) == (3, Decimal("122.0"), 1.0)


def test_null_categories_are_in_the_profile_but_not_in_the_report(spark, fact):
    rows = fact({"nu_ano": 2024, "cod_raca": 1}, {"nu_ano": 2024}, {"nu_ano": 2024, "cod_raca": 99})
    profile = marts.demographic_profile(rows, *[code_list(spark, n) for n in ("sexo", "raca", "escolaridade")])
    assert {r["raca_cor"]: r["notificados"] for r in profile.collect()} == {"Branca": 1, None: 2}
    assert [tuple(r) for r in reports.by_race(profile).collect()] == [("Branca", 1)]


def test_finer_marts_add_up_to_coarser_ones(spark):
    from catalog.given import Given

    g = Given(spark, "/root/testdata/sf0.001")
    national = marts.weekly_series(g.fact.where("cod_uf_resi is not null")).agg(F.sum("casos_total")).first()[0]
    by_state = marts.weekly_series_state(g.fact, g.uf).agg(F.sum("casos_total")).first()[0]
    assert national == by_state
    places = marts.municipality_ranking(g.fact, g.municipio, g.uf).agg(F.sum("casos_total")).first()[0]
    assert places == g.fact.where("cod_mun_resi is not null").count()


def state_year(spark, *rows):
    return spark.createDataFrame(
        [(i, uf, uf, "Sul", ano, n, n // 2, 1, Decimal("50.00")) for i, (uf, ano, n) in enumerate(rows)],
        "cod_uf int, uf string, uf_nome string, regiao string, ano int, casos_total bigint, casos_confirmados bigint, obitos bigint, taxa_confirmacao_pct decimal(18,2)",
    )


def test_ties_break_by_state(spark):
    cases = state_year(spark, ("SC", 2024, 4), ("PR", 2024, 4), ("RS", 2024, 6))
    assert [(r["posicao"], r["uf"]) for r in reports.state_rank(cases).orderBy("posicao").collect()] == [(1, "RS"), (2, "PR"), (3, "SC")]
    assert [r["uf"] for r in reports.top_states(cases, n=2).collect()] == ["RS", "PR"]


def test_rates_come_from_summed_counts(spark):
    cases = spark.createDataFrame(
        [(1, "PE", "PE", "NE", 2023, 10, 1, 0, Decimal("10.00")), (1, "PE", "PE", "NE", 2024, 90, 81, 0, Decimal("90.00"))],
        "cod_uf int, uf string, uf_nome string, regiao string, ano int, casos_total bigint, casos_confirmados bigint, obitos bigint, taxa_confirmacao_pct decimal(18,2)",
    )
    row = reports.state_totals(cases).first()
    assert (row["taxa_confirmacao_pct"], row["taxa_somada"]) == (Decimal("82.00"), Decimal("100.00"))


def test_matrix_fills_gaps_with_zero(spark):
    rows = [tuple(r) for r in reports.state_year_matrix(state_year(spark, ("PR", 2023, 1), ("SC", 2024, 2)), [2023, 2024]).collect()]
    assert rows == [("PR", 1, 0), ("SC", 0, 2)]


def test_pyramid_in_age_order_with_men_negative(spark):
    pyramid = spark.createDataFrame(
        [("80+", "Masculino", 2024, 1, 2), ("1-4", "Feminino", 2024, 1, 3), ("Ignorada", "Masculino", 2024, 5, 5)],
        "faixa_etaria string, sexo string, ano int, casos_confirmados bigint, casos_total bigint",
    )
    assert [(r["faixa_etaria"], r["casos"]) for r in reports.pyramid_mirrored(pyramid).collect()] == [("1-4", 3), ("80+", -2), ("Ignorada", -5)]
    wide = [tuple(r) for r in reports.pyramid_pivot(marts.pyramid_totals(pyramid)).collect()]
    assert wide == [("1-4", 0, 1), ("80+", 1, 0)]


def test_pregnancy_rate_without_rows_is_zero(spark):
    empty = spark.createDataFrame([], "ano int, uf string, trimestre string, gestantes_confirmadas bigint, gestantes_notificadas bigint, obitos bigint")
    assert tuple(reports.pregnancy_totals(empty).first()) == (0, 0, 0, Decimal("0.0"))
    rows = spark.createDataFrame([(2024, None, "t", 5, 9, 0), (2024, "PE", "t", 2, 3, 0)], empty.schema)
    assert [tuple(r) for r in reports.pregnancy_top_states(rows).collect()] == [("PE", 2)]


def test_last_rows_per_key(spark):
    rows = spark.createDataFrame([(k, i) for k in "ab" for i in range(5)], "k string, i int")
    assert {tuple(r) for r in reports.last_n_rows(rows, "i", 2, ("k",)).collect()} == {("a", 3), ("a", 4), ("b", 3), ("b", 4)}
    assert [r["i"] for r in reports.last_n_rows(rows.where("k = 'a'"), "i", 2).collect()] == [3, 4]
