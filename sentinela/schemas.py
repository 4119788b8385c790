"""Table layouts and code lists of the notification warehouse."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The raw file's header, in file order. Staging uses the same names in lower case.
RAW_HEADER = [
    "arquivo_origem", "ano_arquivo", "TP_NOT", "ID_AGRAVO", "CS_SUSPEIT",
    "DT_NOTIFIC", "SEM_NOT", "NU_ANO", "SG_UF_NOT", "ID_MUNICIP", "ID_REGIONA",
    "DT_SIN_PRI", "SEM_PRI", "NU_IDADE_N", "CS_SEXO", "CS_GESTANT", "CS_RACA",
    "CS_ESCOL_N", "SG_UF", "ID_MN_RESI", "ID_RG_RESI", "ID_PAIS", "NDUPLIC_N",
    "IN_VINCULA", "DT_INVEST", "ID_OCUPA_N", "CLASSI_FIN", "CRITERIO",
    "TPAUTOCTO", "COUFINF", "COPAISINF", "COMUNINF", "DOENCA_TRA", "EVOLUCAO",
    "DT_OBITO", "DT_ENCERRA", "CS_FLXRET", "FLXRECEBI", "TP_SISTEMA",
    "TPUNINOT", "ID_UNIDADE", "ANO_NASC", "DT_DIGITA",
]
STAGING_COLUMNS = [name.lower() for name in RAW_HEADER]

RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_HEADER])


@dataclass(frozen=True)
class FactColumn:
    """How one fact column is made from one staging column.

    ``kind`` names the cleaning rule, ``limit`` the longest text or largest number the fact
    accepts, and ``required`` marks columns a fact row cannot do without.
    """

    name: str
    source: str
    kind: str
    limit: int | None = None
    required: bool = False


SMALLINT_MAX = 32767

# Fact columns with their source column and type.
FACT_COLUMNS = [
    FactColumn("arquivo_origem", "arquivo_origem", "text", 40, True),
    FactColumn("ano_arquivo", "ano_arquivo", "file_year", None, True),
    FactColumn("tp_not", "tp_not", "int", SMALLINT_MAX),
    FactColumn("id_agravo", "id_agravo", "text", 10, True),
    FactColumn("cs_suspeito", "cs_suspeit", "text", 20),
    FactColumn("dt_notificacao", "dt_notific", "date"),
    FactColumn("sem_notificacao", "sem_not", "int"),
    FactColumn("nu_ano", "nu_ano", "int"),
    FactColumn("cod_uf_notif", "sg_uf_not", "int", SMALLINT_MAX),
    FactColumn("cod_mun_notif", "id_municip", "municipality"),
    FactColumn("id_regional_notif", "id_regiona", "int"),
    FactColumn("dt_sintomas", "dt_sin_pri", "date", None, True),
    FactColumn("sem_sintomas", "sem_pri", "int"),
    FactColumn("nu_idade_codificada", "nu_idade_n", "int"),
    FactColumn("cod_sexo", "cs_sexo", "sex"),
    FactColumn("cod_gestante", "cs_gestant", "int", SMALLINT_MAX),
    FactColumn("cod_raca", "cs_raca", "int", SMALLINT_MAX),
    FactColumn("cod_escolaridade", "cs_escol_n", "int", SMALLINT_MAX),
    FactColumn("cod_uf_resi", "sg_uf", "int", SMALLINT_MAX),
    FactColumn("cod_mun_resi", "id_mn_resi", "municipality"),
    FactColumn("id_regional_resi", "id_rg_resi", "int"),
    FactColumn("id_pais_resi", "id_pais", "int"),
    FactColumn("nduplic_n", "nduplic_n", "int", SMALLINT_MAX),
    FactColumn("in_vincula", "in_vincula", "int", SMALLINT_MAX),
    FactColumn("dt_investigacao", "dt_invest", "date"),
    FactColumn("cod_ocupacao", "id_ocupa_n", "digits_text", 10),
    FactColumn("cod_classificacao", "classi_fin", "int", SMALLINT_MAX),
    FactColumn("cod_criterio", "criterio", "int", SMALLINT_MAX),
    FactColumn("cod_autoctonia", "tpautocto", "int", SMALLINT_MAX),
    FactColumn("cod_uf_infec", "coufinf", "int", SMALLINT_MAX),
    FactColumn("cod_pais_infec", "copaisinf", "int"),
    FactColumn("cod_mun_infec", "comuninf", "municipality"),
    FactColumn("doenca_trabalho", "doenca_tra", "int", SMALLINT_MAX),
    FactColumn("cod_evolucao", "evolucao", "int", SMALLINT_MAX),
    FactColumn("dt_obito", "dt_obito", "date"),
    FactColumn("dt_encerramento", "dt_encerra", "date"),
    FactColumn("cs_flxret", "cs_flxret", "int", SMALLINT_MAX),
    FactColumn("flxrecebi", "flxrecebi", "int", SMALLINT_MAX),
    FactColumn("tp_sistema", "tp_sistema", "int", SMALLINT_MAX),
    FactColumn("tp_unidade_notif", "tpuninot", "int", SMALLINT_MAX),
    FactColumn("cod_cnes_unidade", "id_unidade", "long"),
    FactColumn("ano_nascimento", "ano_nasc", "birth_year"),
    FactColumn("dt_digitacao", "dt_digita", "date"),
]

# Federation units (code, abbreviation, name, region).
STATES = [
    (11, "RO", "Rondônia", "Norte"),
    (12, "AC", "Acre", "Norte"),
    (13, "AM", "Amazonas", "Norte"),
    (14, "RR", "Roraima", "Norte"),
    (15, "PA", "Pará", "Norte"),
    (16, "AP", "Amapá", "Norte"),
    (17, "TO", "Tocantins", "Norte"),
    (21, "MA", "Maranhão", "Nordeste"),
    (22, "PI", "Piauí", "Nordeste"),
    (23, "CE", "Ceará", "Nordeste"),
    (24, "RN", "Rio Grande do Norte", "Nordeste"),
    (25, "PB", "Paraíba", "Nordeste"),
    (26, "PE", "Pernambuco", "Nordeste"),
    (27, "AL", "Alagoas", "Nordeste"),
    (28, "SE", "Sergipe", "Nordeste"),
    (29, "BA", "Bahia", "Nordeste"),
    (31, "MG", "Minas Gerais", "Sudeste"),
    (32, "ES", "Espírito Santo", "Sudeste"),
    (33, "RJ", "Rio de Janeiro", "Sudeste"),
    (35, "SP", "São Paulo", "Sudeste"),
    (41, "PR", "Paraná", "Sul"),
    (42, "SC", "Santa Catarina", "Sul"),
    (43, "RS", "Rio Grande do Sul", "Sul"),
    (50, "MS", "Mato Grosso do Sul", "Centro-Oeste"),
    (51, "MT", "Mato Grosso", "Centro-Oeste"),
    (52, "GO", "Goiás", "Centro-Oeste"),
    (53, "DF", "Distrito Federal", "Centro-Oeste"),
]

# Categorical code lists (code, description).
CODE_LISTS = {
    "sexo": [("M", "Masculino"), ("F", "Feminino"), ("I", "Ignorado")],
    "raca": [
        (1, "Branca"), (2, "Preta"), (3, "Amarela"), (4, "Parda"), (5, "Indígena"), (9, "Ignorado"),
    ],
    "escolaridade": [
        (0, "Analfabeto"),
        (1, "1ª a 4ª série incompleta do EF"),
        (2, "4ª série completa do EF"),
        (3, "5ª a 8ª série incompleta do EF"),
        (4, "Ensino Fundamental completo"),
        (5, "Ensino Médio incompleto"),
        (6, "Ensino Médio completo"),
        (7, "Educação superior incompleta"),
        (8, "Educação superior completa"),
        (9, "Ignorado"),
        (10, "Não se aplica"),
    ],
    "gestante": [
        (1, "1º trimestre"),
        (2, "2º trimestre"),
        (3, "3º trimestre"),
        (4, "Idade gestacional ignorada"),
        (5, "Não"),
        (6, "Não se aplica"),
        (9, "Ignorado"),
    ],
    "classificacao": [
        (0, "Descartado"), (1, "Confirmado"), (2, "Em investigação"), (8, "Inconclusivo"),
    ],
    "criterio": [(0, "Em investigação"), (1, "Laboratorial"), (2, "Clínico-epidemiológico")],
    "evolucao": [
        (0, "Em investigação"),
        (1, "Cura"),
        (2, "Óbito pelo agravo"),
        (3, "Óbito por outra causa"),
        (9, "Ignorado"),
    ],
    "autoctonia": [(1, "Sim (autóctone)"), (2, "Não (importado)"), (3, "Indeterminado")],
}

# Fixed values: (upper bound in years, label); an age belongs to the first bound above it.
AGE_BANDS = [
    (1, "<1 ano"), (5, "1-4"), (10, "5-9"), (15, "10-14"), (20, "15-19"), (30, "20-29"),
    (40, "30-39"), (50, "40-49"), (60, "50-59"), (70, "60-69"), (80, "70-79"),
]
OLDEST_BAND = "80+"
UNKNOWN_BAND = "Ignorada"
BAND_ORDER = [label for _, label in AGE_BANDS] + [OLDEST_BAND]

CONFIRMED, DISCARDED, INVESTIGATING = 1, 0, 2
CURED, DIED = 1, 2
PREGNANT = (1, 2, 3, 4)
PREGNANT_KNOWN_TRIMESTER = (1, 2, 3)

# Fixed values: (fact column, dimension, dimension key).
FOREIGN_KEYS = [
    ("cod_uf_notif", "uf", "cod_uf"),
    ("cod_mun_notif", "municipio", "cod_municipio"),
    ("cod_uf_resi", "uf", "cod_uf"),
    ("cod_mun_resi", "municipio", "cod_municipio"),
    ("cod_autoctonia", "autoctonia", "cod"),
    ("cod_uf_infec", "uf", "cod_uf"),
    ("cod_mun_infec", "municipio", "cod_municipio"),
    ("cod_sexo", "sexo", "cod"),
    ("cod_gestante", "gestante", "cod"),
    ("cod_raca", "raca", "cod"),
    ("cod_escolaridade", "escolaridade", "cod"),
    ("cod_classificacao", "classificacao", "cod"),
    ("cod_criterio", "criterio", "cod"),
    ("cod_evolucao", "evolucao", "cod"),
    ("cod_cnes_unidade", "unidade_saude", "cod_cnes"),
]

FORECAST_SCHEMA = T.StructType([
    T.StructField("ds", T.DateType()),
    T.StructField("yhat", T.DoubleType()),
    T.StructField("yhat_lower", T.DoubleType()),
    T.StructField("yhat_upper", T.DoubleType()),
])


def values_text(rows: list[tuple]) -> str:
    """Rows as the inside of a VALUES clause."""

    def literal(value):
        if isinstance(value, str):
            return "'" + value.replace("'", "''") + "'"
        return str(value)

    return ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in rows)


def code_list(spark: SparkSession, name: str) -> DataFrame:
    """One fixed categorical dimension as ``(cod, descricao)``.

    Inline VALUES keep exact size statistics, so Spark itself decides to broadcast them.
    """
    return spark.sql(f"SELECT * FROM VALUES {values_text(CODE_LISTS[name])} AS t(cod, descricao)")


def states(spark: SparkSession) -> DataFrame:
    """The fixed federation-unit dimension ``(cod_uf, sigla, nome, regiao)``."""
    return spark.sql(f"SELECT * FROM VALUES {values_text(STATES)} AS t(cod_uf, sigla, nome, regiao)")
