from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from sentinela.operators import duplicates
from sentinela.plans import sqlnames

DAY = dt.date(2024, 6, 10)


@pytest.fixture
def session(spark, fact):
    case = {"dt_sintomas": DAY, "nu_ano": 2024, "sem_sintomas": 24, "cod_mun_resi": 261160, "cod_sexo": "F", "cod_classificacao": 1, "idade_anos": Decimal("25.00"), "faixa_etaria": "20-29"}
    rows = fact({**case, "cod_uf_resi": 26}, {**case, "cod_uf_resi": 26}, {**case, "cod_uf_resi": 99, "nu_ano": 2017})
    towns = spark.createDataFrame([(261160, "MUN-261160", 26)], "cod_municipio int, nome string, cod_uf int")
    return sqlnames.register_sql(rows, sqlnames.fixed_dimensions(spark, towns))


def rows(session, text):
    return [tuple(r) for r in session.sql(text).collect()]


def test_scalar_functions(session):
    got = rows(session, "SELECT fn_decodifica_idade(4025), fn_decodifica_idade(3006), fn_decodifica_idade(2015), fn_decodifica_idade(1010), fn_decodifica_idade(NULL), fn_decodifica_idade(0), fn_decodifica_idade(5001)")
    assert got == [(Decimal("25.000"), Decimal("0.500"), Decimal("0.041"), Decimal("0.001"), None, None, None)]
    got = rows(session, "SELECT fn_faixa_etaria(0.3), fn_faixa_etaria(3), fn_faixa_etaria(25), fn_faixa_etaria(82), fn_faixa_etaria(NULL)")
    assert got == [("<1 ano", "1-4", "20-29", "80+", "Ignorada")]


def test_summary_function(session):
    assert rows(session, "SELECT uf_sigla, ano, total_notificacoes FROM fn_resumo_epidemiologico('PE', 2024)") == [("PE", 2024, 2)]
    every = rows(session, "SELECT uf_sigla, ano, total_notificacoes FROM fn_resumo_epidemiologico() ORDER BY ano")
    assert every == [(None, 2017, 1), ("PE", 2024, 2)]


def test_curve_function(session):
    assert sorted(rows(session, "SELECT * FROM fn_curva_semanal()")) == [(2017, 24, DAY, 1, 1), (2024, 24, DAY, 2, 2)]
    assert rows(session, "SELECT * FROM fn_curva_semanal(NULL, 2018)") == [(2024, 24, DAY, 2, 2)]
    assert rows(session, "SELECT ano FROM fn_curva_semanal(NULL, 2017, 2017)") == [(2017,)]
    assert rows(session, "SELECT * FROM fn_curva_semanal('SP')") == []


def test_duplicates_function(session):
    assert rows(session, "SELECT n_ocorrencias, dt_sintomas_min FROM fn_detectar_duplicatas() LIMIT 20") == [(3, DAY)]
    wide = rows(session, "SELECT * FROM fn_detectar_duplicatas(7)")
    assert [row[1:4] for row in wide] == [(3, 261160, "F")]
    assert wide[0][0] == duplicates.detect_duplicates(session.table("fato_notificacao"), 7).first()["grupo_hash"]


@pytest.mark.parametrize("view, wanted", [
    ("vw_serie_semanal", 2), ("vw_serie_semanal_uf", 1), ("vw_casos_uf_ano", 1), ("vw_piramide_etaria", 2), ("vw_gestantes", 0),
    ("vw_municipios_top", 2), ("vw_perfil_demografico", 2), ("vw_kpis", 1), ("vw_latencia_notificacao", 0), ("vw_completude", 2),
    ("dim_uf", 27), ("dim_sexo", 3), ("fato_notificacao", 3),
])
def test_views(session, view, wanted):
    assert len(rows(session, f"SELECT * FROM {view}")) == wanted


def test_state_and_years_reach_the_files(spark, fact, tmp_path):
    rows = fact(*[{"dt_sintomas": DAY, "nu_ano": 2020 + i % 4, "sem_sintomas": 24, "cod_uf_resi": 26 + i % 3, "cod_classificacao": 1} for i in range(24)])
    rows.write.partitionBy("nu_ano").parquet(str(tmp_path / "fato"))
    towns = spark.createDataFrame([], "cod_municipio int, nome string, cod_uf int")
    session = sqlnames.register_sql(spark.read.parquet(str(tmp_path / "fato")), sqlnames.fixed_dimensions(spark, towns))
    for call in ("fn_resumo_epidemiologico('PE', 2021)", "fn_curva_semanal('PE', 2021, 2021)"):
        found = session.sql(f"SELECT * FROM {call}")
        assert found.count() == 1
        scans = [line for line in found._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")).splitlines() if "Filters:" in line]
        assert any("PushedFilters" in line and "EqualTo(cod_uf_resi,26)" in line for line in scans)
        assert any("PartitionFilters" in line and "2021" in line for line in scans)
    assert session.sql("SELECT * FROM fn_resumo_epidemiologico('??')").count() == 0
    assert session.sql("SELECT * FROM fn_resumo_epidemiologico()").count() == 12
