"""Sources, sinks, staging to fact, derived dimensions, key reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.given import AFTER_SQL, BEFORE_SQL, plain, query, with_fact, with_staging
from catalog.mart_queries import SQL_WEEKLY_STATE, weekly_state
from catalog.scalars import SQL_FILE_YEAR, sql_date, sql_int, sql_municipality
from sentinela.functions.cleaning import label_code
from sentinela.operators import audit, dimensions, integrity, staging
from sentinela.plans import incremental
from sentinela.plans.load import run_load
from sentinela.schemas import (
    CODE_LISTS,
    FACT_COLUMNS,
    FOREIGN_KEYS,
    RAW_HEADER,
    SMALLINT_MAX,
    STAGING_COLUMNS,
    STATES,
    values_text,
)
from sentinela.session import scratch_dir
from sentinela.sources import csvfiles, warehouse

SQL_CLEANERS = {
    "text": lambda c: c,
    "int": sql_int,
    "long": lambda c: sql_int(c, "BIGINT"),
    "date": sql_date,
    "file_year": lambda c: SQL_FILE_YEAR,
    "municipality": sql_municipality,
    "sex": lambda c: f"CASE WHEN {c} IN ('M', 'F') THEN {c} END",
    "birth_year": lambda c: f"CASE WHEN regexp_full_match({c}, '[0-9]{{4}}') THEN CAST({c} AS BIGINT) END",
    "digits_text": lambda c: f"CASE WHEN regexp_full_match({c}, '[0-9]+') THEN {c} END",
}
SQL_TYPED = ", ".join(f"{SQL_CLEANERS[c.kind](c.source)} AS {c.name}" for c in FACT_COLUMNS)
# The planted faults that keep a row out: its symptom date, its file year, its form type.
SQL_ACCEPTED = f"dt_sintomas IS NOT NULL AND ano_arquivo IS NOT NULL AND tp_not <= {SMALLINT_MAX}"


def with_clean(body: str) -> str:
    return with_staging(f", limpas AS (SELECT linha_id, {SQL_TYPED} FROM stg),\naceitas AS (SELECT * FROM limpas WHERE {SQL_ACCEPTED})\n{body}")


def accepted(g):
    return staging.split_staging(g.staging).accepted


def raw_file(g) -> str:
    """The staging rows as a raw file with the expected header."""
    path = scratch_dir(g.spark, "raw")
    named = [F.col(name.lower()).alias(name) for name in RAW_HEADER]
    csvfiles.export_csv(g.staging.select(*named), path)
    return path


SQL_RAW = "SELECT " + ", ".join(f"nullif({c}, '') AS {c}" for c in STAGING_COLUMNS) + " FROM stg"


@query(with_staging(SQL_RAW))
def read_raw_csv(g):
    return csvfiles.read_raw(g.spark, raw_file(g)).select(*STAGING_COLUMNS)


@query(with_staging(SQL_RAW))
def read_raw_mixed(g):
    """The staging rows from a folder whose files differ in the order of their columns."""
    folder = scratch_dir(g.spark, "mixed")
    names = list(RAW_HEADER)
    for part, order in enumerate((names, names[::-1], names[20:] + names[:20])):
        rows = g.staging.where(F.col("linha_id") % 3 == part)
        csvfiles.export_csv(rows.select(*[F.col(name.lower()).alias(name) for name in order]), f"{folder}/{part}")
    return csvfiles.read_raw(g.spark, f"{folder}/*", mixed_headers=True).select(*STAGING_COLUMNS)


@query(with_staging(SQL_RAW))
def load_staging(g):
    """The stored staging table without its line ids, which are the load's own."""
    return warehouse.load_staging(g.spark, raw_file(g), scratch_dir(g.spark, "staging")).select(*STAGING_COLUMNS)


FACT_NAMES = [c.name for c in FACT_COLUMNS]


def sql_hash_part(column) -> str:
    if column.kind in ("text", "digits_text", "sex"):
        return f"coalesce(length({column.name}) || ':' || {column.name}, '-')"
    return f"coalesce(CAST({column.name} AS VARCHAR), '-')"


SQL_HASHED = f"""SELECT *, sha256(concat_ws('|', {', '.join(sql_hash_part(c) for c in FACT_COLUMNS)})) AS hash_linha FROM aceitas"""
SQL_IDS = f"""SELECT *, CAST('0x' || left(md5(hash_linha || '|' || row_number() OVER (PARTITION BY hash_linha ORDER BY linha_id)), 15) AS BIGINT) AS id_notif
  FROM ({SQL_HASHED})"""


@query(with_clean(f"SELECT id_notif, linha_id, {', '.join(FACT_NAMES)} FROM ({SQL_IDS})"))
def load_fact(g):
    fact = warehouse.load_fact(accepted(g), scratch_dir(g.spark, "fato"))
    return fact.select("id_notif", "linha_id", *FACT_NAMES)


@query(
    with_clean(
        f"""SELECT linha_id, sha256(concat_ws('|', {', '.join(sql_hash_part(c) for c in FACT_COLUMNS)})) AS hash_linha,
        true AS tem_momento, true AS tem_usuario FROM aceitas"""
    )
)
def row_defaults(g):
    return staging.row_defaults(accepted(g)).select(
        "linha_id",
        "hash_linha",
        F.col("carregado_em").isNotNull().alias("tem_momento"),
        F.col("usuario_db").isNotNull().alias("tem_usuario"),
    )


@query(with_clean("SELECT linha_id, " + ", ".join(c.name for c in FACT_COLUMNS) + " FROM aceitas"))
def clean_staging(g):
    return accepted(g).select("linha_id", *[c.name for c in FACT_COLUMNS])


SQL_REJECTED = f"""SELECT linha_id, concat_ws(',',
  CASE WHEN ano_arquivo IS NULL THEN 'ano_arquivo:missing' END,
  CASE WHEN tp_not > {SMALLINT_MAX} THEN 'tp_not:limit' END,
  CASE WHEN dt_sintomas IS NULL THEN CASE WHEN impossivel THEN 'dt_sin_pri:value' ELSE 'dt_sin_pri:missing' END END) AS motivos
  FROM (SELECT l.*, coalesce(regexp_full_match(dt_sin_pri, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}'), false) AS impossivel
        FROM limpas l JOIN (SELECT linha_id, dt_sin_pri FROM stg) USING (linha_id))
  WHERE NOT coalesce({SQL_ACCEPTED}, false)"""


@query(with_clean(SQL_REJECTED))
def rejected_rows(g):
    rejected = staging.split_staging(g.staging).rejected
    return rejected.select("linha_id", F.concat_ws(",", "motivos").alias("motivos"))


# Every fixed list with the fact column that counts it; the derived forms lack two of the columns.
LIST_COLUMNS = {name: f"cod_{name}" for name in CODE_LISTS if name not in ("criterio", "autoctonia")}


def sql_seeds() -> str:
    counted = [
        f"""SELECT '{name}' AS dimensao, CAST(d.cod AS VARCHAR) AS cod, d.descricao, count(f.id_notif) AS n_fichas
        FROM dim_{name} d LEFT JOIN fato f ON f.{column} = d.cod GROUP BY ALL"""
        for name, column in LIST_COLUMNS.items()
    ]
    bare = [f"SELECT '{name}', CAST(cod AS VARCHAR), descricao, 0 FROM dim_{name}" for name in CODE_LISTS if name not in LIST_COLUMNS]
    states_seen = f"""SELECT 'uf', CAST(u.cod_uf AS VARCHAR), u.nome, count(f.id_notif)
        FROM (VALUES {values_text(STATES)}) u(cod_uf, sigla, nome, regiao) LEFT JOIN fato f ON f.cod_uf_resi = u.cod_uf GROUP BY ALL"""
    return " UNION ALL ".join([*counted, *bare, states_seen])


@query(with_fact(sql_seeds()))
def seed_dimensions(g):
    """Forms per code of every fixed list, codes without forms included."""
    columns = {**LIST_COLUMNS, "uf": "cod_uf_resi"}
    pairs = F.array(
        *[F.struct(F.lit(n).alias("dimensao"), F.col(c).cast("string").alias("cod")) for n, c in columns.items()]
    )
    used = g.fact.select(F.inline(pairs)).groupBy("dimensao", "cod").agg(F.count(F.lit(1)).alias("n"))
    seeds = g.states.select(F.lit("uf").alias("dimensao"), F.col("cod_uf").cast("string").alias("cod"), F.col("nome").alias("descricao"))
    for name in CODE_LISTS:
        codes = g.list(name).select(F.lit(name).alias("dimensao"), F.col("cod").cast("string").alias("cod"), "descricao")
        seeds = seeds.unionByName(codes)
    return seeds.join(used, ["dimensao", "cod"], "left").select(
        "dimensao", "cod", "descricao", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_fichas")
    )


@query(
    with_fact(
        """SELECT cod_municipio, nome, cod_uf FROM dim_municipio
        UNION ALL SELECT cod, concat('MUN-', cod), CAST((cod - 100000) // 10 AS INT) FROM (
          SELECT DISTINCT cod_mun_notif + 1 AS cod FROM fato
          WHERE cod_mun_notif IS NOT NULL AND cod_mun_notif + 1 NOT IN (SELECT cod_municipio FROM dim_municipio))"""
    )
)
def insert_if_absent(g):
    """The municipality dimension plus the neighbours of the notifying ones."""
    code = (F.col("cod_mun_notif") + 1).cast("int")
    new = g.fact.where(F.col("cod_mun_notif").isNotNull()).select(
        code.alias("cod_municipio"),
        label_code("MUN", code).alias("nome"),
        F.floor((code - 100000) / 10).cast("int").alias("cod_uf"),
    )
    return dimensions.insert_if_absent(g.municipio, new, ["cod_municipio"])


@query(with_fact(SQL_WEEKLY_STATE))
def materialize_mart(g):
    mart = warehouse.materialize_mart(weekly_state(g), scratch_dir(g.spark, "mart"), ["uf", "ano", "semana_epi"])
    return mart.select("uf", "regiao", "ano", "semana_epi", "inicio_sem", "casos_total", "casos_confirmados")


@query(with_fact(SQL_WEEKLY_STATE))
def refresh_mart(g):
    """The weekly mart of an older state of the fact, brought up to date by what has changed since.

    In the older state no form after 1995 is closed, every seventh is missing, and some stand in another week.
    """
    moving = F.year("dt_sintomas") > 1995
    older = g.fact.where(~moving | (F.col("id_notif") % 7 != 0))
    older = older.withColumns(
        {
            "cod_classificacao": F.when(moving & F.col("dt_encerramento").isNotNull(), 2).otherwise(F.col("cod_classificacao")),
            "sem_sintomas": F.when(moving & (F.col("id_notif") % 11 == 0), 1).otherwise(F.col("sem_sintomas")),
        }
    )
    root = scratch_dir(g.spark, "weekly-mart")
    incremental.build_weekly(older, root, g.uf)
    mart = incremental.refresh_weekly(g.spark, root, older, g.fact, g.uf)
    return mart.select("uf", "regiao", "ano", "semana_epi", "inicio_sem", "casos_total", "casos_confirmados")


@query(with_clean("SELECT s.linha_id, a.linha_id AS id_notif_gerado FROM stg s LEFT JOIN aceitas a USING (linha_id)"))
def lineage_staging_to_fact(g):
    return staging.lineage_staging_to_fact(g.staging, warehouse.fact_rows(accepted(g)))


SQL_LOG = """SELECT 'fato_notificacao' AS tabela, CAST(coalesce(a.id_notif, b.id_notif) AS VARCHAR) AS pk_alvo,
  CASE WHEN b.id_notif IS NULL THEN 'I' WHEN a.id_notif IS NULL THEN 'D' ELSE 'U' END AS operacao
  FROM antes b FULL JOIN depois a ON a.id_notif = b.id_notif
  WHERE b.id_notif IS NULL OR a.id_notif IS NULL OR a.cod_classificacao IS DISTINCT FROM b.cod_classificacao"""


def with_snapshots(body: str) -> str:
    return with_fact(f", antes AS ({plain(BEFORE_SQL)}), depois AS ({plain(AFTER_SQL)}) {body}")


@query(
    with_snapshots(
        f"""SELECT l.tabela, l.pk_alvo, l.operacao, d.id_notif AS id_notif_ref FROM (
          {SQL_LOG} UNION ALL SELECT 'dim_uf', CAST(cod_uf AS VARCHAR), 'I' FROM dim_uf) l
        LEFT JOIN depois d ON l.tabela = 'fato_notificacao' AND CAST(l.pk_alvo AS BIGINT) = d.id_notif"""
    )
)
def audit_ref_backfill(g):
    log = audit.audit_diff(g.before(), g.after(), ["id_notif"], "fato_notificacao")
    of_dims = audit.audit_diff(g.uf.where(F.lit(False)), g.uf, ["cod_uf"], "dim_uf")
    entries = log.unionByName(of_dims).select("tabela", "pk_alvo", "operacao")
    return audit.audit_ref_backfill(entries, g.after())


@query(
    with_clean(
        """SELECT count(*) AS total_notificacoes, count(DISTINCT cod_mun_notif) AS municipios_notificacao,
        count(DISTINCT cod_mun_resi) AS municipios_residencia, min(dt_sintomas) AS primeira_data, max(dt_sintomas) AS ultima_data,
        count(*) - count(cod_mun_resi) AS sem_municipio_resi, count(CASE WHEN cod_classificacao = 1 THEN 1 END) AS confirmados,
        count(CASE WHEN cod_evolucao = 2 THEN 1 END) AS obitos FROM aceitas"""
    )
)
def batch_load(g):
    """The whole load from a raw file: staging, dimensions, fact, weekly mart, diagnostics."""
    return run_load(g.spark, raw_file(g), scratch_dir(g.spark, "load")).summary


# Derived dimensions and key reports.

SQL_MUNICIPALITIES = " UNION ".join(
    f"SELECT CAST(left({c}, 6) AS INTEGER) AS cod_municipio FROM stg WHERE regexp_full_match({c}, '[0-9]{{6,7}}')"
    for c in ("id_municip", "id_mn_resi", "comuninf")
)


@query(
    with_staging(
        f"""SELECT cod_municipio, concat('MUN-', cod_municipio) AS nome, CAST(cod_municipio // 10000 AS INT) AS cod_uf
        FROM ({SQL_MUNICIPALITIES}) WHERE cod_municipio // 10000 IN (SELECT cod_uf FROM ufs)"""
    )
)
def distinct_municipalities(g):
    return dimensions.distinct_municipalities(g.staging, g.states)


@query(
    with_staging(
        f"SELECT cod_municipio FROM ({SQL_MUNICIPALITIES}) WHERE cod_municipio // 10000 IN (SELECT cod_uf FROM ufs)"
    )
)
def semi_known_state(g):
    return dimensions.semi_known_state(dimensions.municipality_codes(g.staging), g.states).select("cod_municipio")


@query(
    with_staging(
        """SELECT CAST(id_unidade AS BIGINT) AS cod_cnes, concat('CNES-', min(id_unidade)) AS nome FROM stg
        WHERE regexp_full_match(id_unidade, '[0-9]+') GROUP BY 1"""
    )
)
def distinct_health_units(g):
    return dimensions.distinct_health_units(g.staging)


@query(
    with_clean(
        f"""SELECT linha_id, cod_raca FROM aceitas WHERE cod_raca IS NOT NULL
        AND cod_raca NOT IN (SELECT cod FROM (VALUES {values_text(CODE_LISTS['raca'])}) t(cod, descricao))"""
    )
)
def anti_unknown_code(g):
    return integrity.anti_unknown_code(accepted(g), "cod_raca", g.list("raca"), "cod").select("linha_id", "cod_raca")


def sql_violations() -> str:
    known = {"uf": "SELECT cod_uf FROM ufs", "municipio": f"SELECT cod_municipio FROM ({SQL_MUNICIPALITIES}) WHERE cod_municipio // 10000 IN (SELECT cod_uf FROM ufs)",
             "unidade_saude": "SELECT CAST(id_unidade AS BIGINT) FROM stg WHERE regexp_full_match(id_unidade, '[0-9]+')"}
    for name, rows in CODE_LISTS.items():
        known[name] = f"SELECT cod FROM (VALUES {values_text(rows)}) t(cod, descricao)"
    return " UNION ALL ".join(
        f"""SELECT '{column}' AS coluna, '{dim}' AS dimensao, CAST({column} AS VARCHAR) AS codigo, count(*) AS n_linhas
        FROM aceitas WHERE {column} IS NOT NULL AND {column} NOT IN ({known[dim]}) GROUP BY {column}"""
        for column, dim, _ in FOREIGN_KEYS
    )


@query(with_clean(sql_violations()))
def fk_violations(g):
    dims = {name: g.list(name) for name in CODE_LISTS}
    dims["uf"] = g.states
    dims["municipio"] = dimensions.distinct_municipalities(g.staging, g.states)
    dims["unidade_saude"] = dimensions.distinct_health_units(g.staging)
    return integrity.fk_violations(accepted(g), dims, known=integrity.fixed_codes())


@query(
    with_fact(
        """SELECT id_notif, row_number() OVER (PARTITION BY cod_uf_resi, cod_sexo, cod_raca, cod_evolucao ORDER BY id_notif) AS ocorrencia FROM fato"""
    )
)
def content_occurrence(g):
    """Occurrence of each form among the forms of equal state, sex, race and outcome."""
    same = ["cod_uf_resi", "cod_sexo", "cod_raca", "cod_evolucao"]
    return staging.content_occurrence(g.fact, same, "id_notif").select(
        "id_notif", F.col("ocorrencia").cast("bigint").alias("ocorrencia")
    )
