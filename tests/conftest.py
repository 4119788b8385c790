from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from sentinela.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("scratch")
    session = local_session("4", 4, **{"spark.checkpoint.dir": str(folder)})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def fact(spark):
    """Build fact rows from dictionaries; columns not named are NULL."""
    schema = (
        "id_notif bigint, dt_sintomas date, dt_notificacao date, dt_encerramento date, dt_obito date, nu_ano int, "
        "sem_sintomas int, cod_uf_resi int, cod_mun_resi int, cod_mun_notif int, nu_idade_codificada int, "
        "idade_anos decimal(5,2), faixa_etaria string, cod_sexo string, cod_gestante int, cod_raca int, "
        "cod_escolaridade int, cod_classificacao int, cod_evolucao int, ano_nascimento int"
    )
    names = [part.split()[0] for part in schema.replace("decimal(5,2)", "decimal").split(", ")]

    def build(*rows: dict):
        return spark.createDataFrame(
            [tuple(row.get(name, i + 1 if name == "id_notif" else None) for name in names) for i, row in enumerate(rows)],
            schema,
        )

    return build


@pytest.fixture
def staging(spark):
    """Build staging rows from dictionaries over one well-formed form."""
    from sentinela.schemas import STAGING_COLUMNS

    form = {
        "arquivo_origem": "A.dbc",
        "ano_arquivo": "2024",
        "id_agravo": "A92",
        "dt_sin_pri": "2024-06-10",
        "nu_ano": "2024",
    }

    def build(*rows: dict):
        schema = "linha_id bigint, " + ", ".join(f"{name} string" for name in STAGING_COLUMNS)
        filled = [{**form, **row} for row in rows]
        return spark.createDataFrame(
            [(i + 1, *[row.get(name) for name in STAGING_COLUMNS]) for i, row in enumerate(filled)], schema
        )

    return build
