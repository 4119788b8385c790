"""Notification-shaped tables derived from the given tables by SQL that both engines run.

Table names stand in braces; Spark puts DataFrames there and the checking engine its views.

Orders play the notification forms, customers the patients, nations the states. The SQL plants
the faults and gaps that the operators have to deal with.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from sentinela.operators.staging import with_age
from sentinela.schemas import CODE_LISTS, STAGING_COLUMNS, STATES, code_list, states, values_text

FORMS = "FROM {orders} o JOIN {customer} c ON c.c_custkey = o.o_custkey"

FACT_SQL = f"""
SELECT o.o_orderkey AS id_notif,
  CAST(o.o_orderdate AS DATE) AS dt_sintomas,
  CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 400 - 10 AS INT) AS dt_notificacao,
  CASE WHEN o.o_orderkey % 9 <> 0 THEN CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 400 + o.o_orderkey % 90 - 13 AS INT) END AS dt_encerramento,
  CASE WHEN (o.o_orderpriority = '1-URGENT' AND o.o_orderkey % 3 <> 0) OR (o.o_orderpriority = '2-HIGH' AND o.o_orderkey % 71 = 0)
       THEN CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 61 - 5 AS INT) END AS dt_obito,
  CAST(CASE WHEN o.o_orderkey % 97 <> 0 THEN year(o.o_orderdate) END AS INT) AS nu_ano,
  CAST(CASE WHEN o.o_orderkey % 89 = 0 THEN 0 WHEN o.o_orderkey % 83 <> 0 THEN weekofyear(CAST(o.o_orderdate AS DATE)) END AS INT) AS sem_sintomas,
  CAST(CASE WHEN o.o_orderkey % 50 <> 0 THEN c.c_nationkey END AS INT) AS cod_uf_resi,
  CAST(CASE WHEN o.o_orderkey % 47 <> 0 THEN 100000 + c.c_nationkey * 10 + c.c_custkey % 10 END AS INT) AS cod_mun_resi,
  CAST(CASE WHEN o.o_orderkey % 53 <> 0 THEN 100000 + c.c_nationkey * 10 + o.o_orderkey % 10 END AS INT) AS cod_mun_notif,
  CAST(CASE WHEN o.o_orderkey % 41 = 0 THEN NULL WHEN o.o_orderkey % 13 = 0 THEN 3000 + o.o_orderkey % 12
            WHEN o.o_orderkey % 29 = 0 THEN 2000 + o.o_orderkey % 366 WHEN o.o_orderkey % 31 = 0 THEN 1000 + o.o_orderkey % 24
            WHEN o.o_orderkey % 53 = 0 THEN 5000 + o.o_orderkey % 100 ELSE 4000 + o.o_orderkey % 131 END AS INT) AS nu_idade_codificada,
  CASE WHEN o.o_custkey % 11 = 0 THEN NULL WHEN o.o_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS cod_sexo,
  CAST(CASE WHEN o.o_orderkey % 37 = 0 THEN NULL WHEN o.o_custkey % 2 = 0 THEN 1 + o.o_orderkey % 6
            WHEN o.o_orderkey % 43 = 0 THEN 1 ELSE 6 END AS INT) AS cod_gestante,
  CAST(CASE c.c_mktsegment WHEN 'MACHINERY' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'AUTOMOBILE' THEN 4 WHEN 'FURNITURE' THEN 9 END AS INT) AS cod_raca,
  CAST(CASE WHEN o.o_orderkey % 12 < 11 THEN o.o_orderkey % 12 END AS INT) AS cod_escolaridade,
  CAST(CASE WHEN o.o_orderkey % 19 = 0 THEN 8 WHEN o.o_orderstatus = 'F' THEN 1 WHEN o.o_orderstatus = 'O' THEN 0 ELSE 2 END AS INT) AS cod_classificacao,
  CAST(CASE o.o_orderpriority WHEN '1-URGENT' THEN 2 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 9 WHEN '4-NOT SPECIFIED' THEN 0 END AS INT) AS cod_evolucao,
  CAST(CASE WHEN o.o_orderkey % 101 = 0 THEN 2010 WHEN o.o_orderkey % 7 <> 0 THEN year(o.o_orderdate) - o.o_orderkey % 131 END AS INT) AS ano_nascimento
{FORMS}
"""

DAY_TEXT = "substring(CAST(CAST(o.o_orderdate AS DATE) + CAST({} AS INT) AS VARCHAR(10)), 1, 10)"

# Raw text of each staging column; NULL where a form leaves the field out.
STAGING_SQL_COLUMNS = {
    "arquivo_origem": "CASE WHEN o.o_orderkey % 2 = 0 THEN 'A.dbc' ELSE 'B.dbc' END",
    "ano_arquivo": "CASE WHEN o.o_orderkey % 59 = 0 THEN '99' WHEN o.o_orderkey % 17 = 0 THEN concat(CAST(year(o.o_orderdate) AS VARCHAR(4)), '.0') ELSE CAST(year(o.o_orderdate) AS VARCHAR(4)) END",
    "tp_not": "CASE WHEN o.o_orderkey % 211 = 0 THEN '99999' ELSE '2' END",
    "id_agravo": "'A928'",
    "cs_suspeit": "o.o_orderstatus",
    "dt_notific": f"CASE WHEN o.o_orderkey % 29 = 0 THEN 'x' ELSE {DAY_TEXT.format('o.o_orderkey % 400 - 10')} END",
    "sem_not": "CAST(weekofyear(CAST(o.o_orderdate AS DATE)) AS VARCHAR(4))",
    "nu_ano": "CASE WHEN o.o_orderkey % 97 <> 0 THEN CAST(year(o.o_orderdate) AS VARCHAR(4)) END",
    "sg_uf_not": "CAST(11 + c.c_nationkey AS VARCHAR(4))",
    "id_municip": "CAST((11 + c.c_nationkey) * 100000 + (o.o_orderkey % 10) * 10 + c.c_custkey % 7 AS VARCHAR(8))",
    "id_regiona": "CAST(c.c_custkey % 300 AS VARCHAR(4))",
    "dt_sin_pri": f"CASE o.o_orderkey % 23 WHEN 0 THEN NULL WHEN 1 THEN '1999/01/05' WHEN 2 THEN '1999-1-5' WHEN 3 THEN '1999-02-30' ELSE {DAY_TEXT.format('0')} END",
    "sem_pri": "CASE WHEN o.o_orderkey % 31 = 0 THEN '' WHEN o.o_orderkey % 37 = 0 THEN ' 7 ' WHEN o.o_orderkey % 41 = 0 THEN '-3' ELSE CAST(weekofyear(CAST(o.o_orderdate AS DATE)) AS VARCHAR(4)) END",
    "nu_idade_n": "CASE WHEN o.o_orderkey % 43 = 0 THEN 'abc' WHEN o.o_orderkey % 13 = 0 THEN CAST(3000 + o.o_orderkey % 12 AS VARCHAR(8)) ELSE CAST(4000 + o.o_orderkey % 131 AS VARCHAR(8)) END",
    "cs_sexo": "CASE o.o_orderkey % 5 WHEN 0 THEN 'I' WHEN 1 THEN 'f' WHEN 2 THEN 'F' WHEN 3 THEN 'M' END",
    "cs_gestant": "CASE WHEN o.o_orderkey % 37 = 0 THEN 'x' ELSE CAST(1 + o.o_orderkey % 6 AS VARCHAR(4)) END",
    "cs_raca": "CASE c.c_mktsegment WHEN 'MACHINERY' THEN '1' WHEN 'BUILDING' THEN '2' WHEN 'AUTOMOBILE' THEN '4' WHEN 'FURNITURE' THEN '7' END",
    "cs_escol_n": "CASE WHEN o.o_orderkey % 12 < 11 THEN CAST(o.o_orderkey % 12 AS VARCHAR(4)) ELSE '12' END",
    "sg_uf": "CASE WHEN o.o_orderkey % 61 = 0 THEN 'BA' ELSE CAST(11 + c.c_nationkey AS VARCHAR(4)) END",
    "id_mn_resi": "CASE WHEN o.o_orderkey % 61 = 0 THEN 'BA' WHEN o.o_orderkey % 47 = 0 THEN '12345' WHEN o.o_orderkey % 3 = 0 THEN CAST((11 + c.c_nationkey) * 100000 + (c.c_custkey % 10) * 10 + c.c_custkey % 7 AS VARCHAR(8)) ELSE CAST((11 + c.c_nationkey) * 10000 + c.c_custkey % 10 AS VARCHAR(8)) END",
    "id_rg_resi": "CAST(c.c_custkey % 300 AS VARCHAR(4))",
    "id_pais": "'1'",
    "nduplic_n": "CASE WHEN o.o_orderkey % 10 = 0 THEN '1' ELSE '' END",
    "in_vincula": "CAST(NULL AS VARCHAR(1))",
    "dt_invest": f"CASE WHEN o.o_orderkey % 4 <> 0 THEN {DAY_TEXT.format('o.o_orderkey % 400 - 8')} END",
    "id_ocupa_n": "CASE WHEN o.o_orderkey % 8 = 0 THEN 'XXX' ELSE concat('0', CAST(o.o_custkey % 9000 AS VARCHAR(8))) END",
    "classi_fin": "CASE WHEN o.o_orderkey % 19 = 0 THEN '8' WHEN o.o_orderstatus = 'F' THEN '1' WHEN o.o_orderstatus = 'O' THEN '0' ELSE '2' END",
    "criterio": "CAST(o.o_orderkey % 4 AS VARCHAR(1))",
    "tpautocto": "CAST(1 + o.o_orderkey % 3 AS VARCHAR(1))",
    "coufinf": "CASE WHEN o.o_orderkey % 5 = 0 THEN CAST(11 + c.c_nationkey AS VARCHAR(4)) END",
    "copaisinf": "CASE WHEN o.o_orderkey % 5 = 0 THEN '1' END",
    "comuninf": "CASE WHEN o.o_orderkey % 5 = 0 THEN CAST((11 + c.c_nationkey) * 10000 + o.o_orderkey % 12 AS VARCHAR(8)) END",
    "doenca_tra": "CASE WHEN o.o_orderkey % 6 = 0 THEN '2' END",
    "evolucao": "CASE o.o_orderpriority WHEN '1-URGENT' THEN '2' WHEN '2-HIGH' THEN '1' WHEN '3-MEDIUM' THEN '9' WHEN '4-NOT SPECIFIED' THEN '0' END",
    "dt_obito": f"CASE WHEN o.o_orderpriority = '1-URGENT' AND o.o_orderkey % 3 <> 0 THEN {DAY_TEXT.format('o.o_orderkey % 61 - 5')} END",
    "dt_encerra": f"CASE WHEN o.o_orderkey % 9 <> 0 THEN {DAY_TEXT.format('o.o_orderkey % 400 + o.o_orderkey % 90 - 13')} END",
    "cs_flxret": "'0'",
    "flxrecebi": "CASE WHEN o.o_orderkey % 2 = 0 THEN '1' END",
    "tp_sistema": "'1'",
    "tpuninot": "CAST(NULL AS VARCHAR(1))",
    "id_unidade": "CASE WHEN o.o_orderkey % 53 = 0 THEN '' ELSE CAST(o.o_custkey % 97 AS VARCHAR(8)) END",
    "ano_nasc": "CASE WHEN o.o_orderkey % 67 = 0 THEN '85' ELSE CAST(year(o.o_orderdate) - o.o_orderkey % 131 AS VARCHAR(8)) END",
    "dt_digita": DAY_TEXT.format("o.o_orderkey % 400"),
}

STAGING_SQL = (
    "SELECT o.o_orderkey AS linha_id,\n  "
    + ",\n  ".join(f"{STAGING_SQL_COLUMNS[name]} AS {name}" for name in STAGING_COLUMNS)
    + f"\n{FORMS}"
)

DIM_UF_SQL = """
SELECT n.n_nationkey AS cod_uf, n.n_name AS sigla, n.n_name AS nome, r.r_name AS regiao
FROM {nation} n JOIN {region} r ON r.r_regionkey = n.n_regionkey
"""

DIM_MUNICIPIO_SQL = """
SELECT DISTINCT CAST(100000 + c_nationkey * 10 + c_custkey % 10 AS INT) AS cod_municipio,
  concat('MUN-', CAST(100000 + c_nationkey * 10 + c_custkey % 10 AS VARCHAR(8))) AS nome,
  c_nationkey AS cod_uf
FROM {customer}
"""

# Two states of the fact: as known while the year 2000 was running, without later forms and with
# later closings still open; and as known afterwards, without the forms that never got an outcome.
BEFORE_SQL = """
SELECT id_notif, dt_sintomas, cod_uf_resi, cod_sexo, cod_evolucao,
  CASE WHEN dt_encerramento >= DATE '2000-06-01' THEN 2 ELSE cod_classificacao END AS cod_classificacao
FROM {fato} WHERE dt_notificacao < DATE '2000-06-01'
"""
AFTER_SQL = """
SELECT id_notif, dt_sintomas, cod_uf_resi, cod_sexo, cod_evolucao, cod_classificacao
FROM {fato} WHERE cod_evolucao IS NOT NULL
"""

FIRST_YEAR, LAST_YEAR = 1995, 2001

# The derived columns of the fact, for the checking engine.
SQL_AGE = """CAST(CASE WHEN nu_idade_codificada > 0 THEN
    CASE nu_idade_codificada // 1000
      WHEN 4 THEN (nu_idade_codificada % 1000) * 1.0 WHEN 3 THEN (nu_idade_codificada % 1000) / 12.0
      WHEN 2 THEN (nu_idade_codificada % 1000) / 365.25 WHEN 1 THEN (nu_idade_codificada % 1000) / 8766.0
    END END AS DECIMAL(6,3))"""


def sql_band(age: str) -> str:
    return f"""CASE WHEN {age} IS NULL THEN 'Ignorada' WHEN {age} < 1 THEN '<1 ano' WHEN {age} < 5 THEN '1-4'
      WHEN {age} < 20 THEN CASE WHEN {age} < 10 THEN '5-9' WHEN {age} < 15 THEN '10-14' ELSE '15-19' END
      WHEN {age} >= 80 THEN '80+'
      ELSE concat(CAST(CAST(floor({age} / 10) AS INT) * 10 AS VARCHAR), '-', CAST(CAST(floor({age} / 10) AS INT) * 10 + 9 AS VARCHAR)) END"""


def plain(text: str) -> str:
    """The text for the checking engine, where the tables go by their own names."""
    names = ("orders", "customer", "nation", "region", "fato")
    return text.format(**{name: name for name in names})


def with_fact(body: str) -> str:
    """The body with ``fato``, ``dim_uf``, ``dim_municipio`` and the code lists in scope."""
    lists = ",\n".join(
        f"dim_{name}(cod, descricao) AS (VALUES {values_text(rows)})" for name, rows in CODE_LISTS.items()
    )
    return f"""WITH fichas AS ({plain(FACT_SQL)}),
decodificadas AS (SELECT *, {SQL_AGE} AS idade_decodificada FROM fichas),
fato AS (SELECT *, CAST(idade_decodificada AS DECIMAL(5,2)) AS idade_anos,
  {sql_band("idade_decodificada")} AS faixa_etaria FROM decodificadas),
dim_uf AS ({plain(DIM_UF_SQL)}),
dim_municipio AS ({plain(DIM_MUNICIPIO_SQL)}),
{lists}
{body}"""


def with_staging(body: str) -> str:
    """The body with ``stg`` and the fixed states ``ufs`` in scope."""
    return f"""WITH stg AS ({plain(STAGING_SQL)}),
ufs(cod_uf, sigla, nome, regiao) AS (VALUES {values_text(STATES)})
{body}"""


def sql_pct(part: str, whole: str, digits: int = 2, factor: int = 100) -> str:
    """Exact half-up ``factor * part / whole`` for the checking engine."""
    scale = 10**digits
    return (
        f"CAST(CAST((CAST({2 * factor * scale} AS BIGINT) * CAST({part} AS BIGINT) + CAST({whole} AS BIGINT)) "
        f"// NULLIF(2 * CAST({whole} AS BIGINT), 0) AS DECIMAL(18,0)) / {scale} AS DECIMAL(18,{digits}))"
    )


class Given:
    """The derived tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def derive_fact(self, orders: DataFrame) -> DataFrame:
        forms = self.spark.sql(FACT_SQL, orders=orders, customer=self.table("customer"))
        return with_age(forms)

    @cached_property
    def fact(self) -> DataFrame:
        return self.derive_fact(self.table("orders"))

    @cached_property
    def staging(self) -> DataFrame:
        # The given tables are single row groups, which one task reads; the forms are as spread as a folder of raw files.
        orders = self.table("orders").repartition(self.spark.sparkContext.defaultParallelism)
        return self.spark.sql(STAGING_SQL, orders=orders, customer=self.table("customer"))

    @cached_property
    def uf(self) -> DataFrame:
        return self.spark.sql(DIM_UF_SQL, nation=self.table("nation"), region=self.table("region"))

    @cached_property
    def municipio(self) -> DataFrame:
        return self.spark.sql(DIM_MUNICIPIO_SQL, customer=self.table("customer"))

    @cached_property
    def states(self) -> DataFrame:
        return states(self.spark)

    def list(self, name: str) -> DataFrame:
        return code_list(self.spark, name)

    def before(self) -> DataFrame:
        return self.spark.sql(BEFORE_SQL, fato=self.fact)

    def after(self) -> DataFrame:
        return self.spark.sql(AFTER_SQL, fato=self.fact)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(check: str | None = None):
    """Register a function of ``Given`` under its name, with its checking SQL if there is one."""

    def register(make: Callable[[Given], DataFrame]):
        name = make.__name__
        QUERIES[name] = lambda spark, folder: make(Given(spark, folder))
        if check is not None:
            CHECKS[name] = check
        return make

    return register
