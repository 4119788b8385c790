"""Validation, audit and duplicates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog.given import query, sql_band, with_fact
from catalog.load_queries import with_snapshots
from catalog.mart_queries import sql_session
from sentinela.operators import audit, duplicates, rules
from sentinela.plans import reports
from sentinela.session import scratch_dir, written
from sentinela.sources import warehouse

TODAY, EARLIEST = dt.date(2001, 1, 1), dt.date(1996, 1, 1)

# Clinical rules for the checking engine, in order; they see the age as stored.
SQL_RULES = {
    "A1": "dt_notificacao < dt_sintomas",
    "A2": "dt_obito < dt_sintomas",
    "A3": "dt_encerramento < dt_notificacao",
    "B2": "dt_obito IS NOT NULL AND cod_evolucao = 1",
    "C": "cod_gestante IN (1, 2, 3, 4) AND cod_sexo <> 'F'",
    "D": "idade_anos < 0 OR idade_anos > 120",
    "E": "sem_sintomas < 1 OR sem_sintomas > 53",
    "F": "year(dt_sintomas) - ano_nascimento < 0",
}
SQL_WARNING = "cod_evolucao = 2 AND dt_obito IS NULL"
SQL_ERRORS = "concat_ws(',', " + ", ".join(f"CASE WHEN {test} THEN '{code}' END" for code, test in SQL_RULES.items()) + ")"
SQL_CHECKED = f"SELECT *, {SQL_ERRORS} AS erros, CASE WHEN {SQL_WARNING} THEN 'B1' ELSE '' END AS avisos FROM fato"


def text(column: str):
    return F.concat_ws(",", column)


def checked(g):
    return rules.validate_clinical(g.fact)


SQL_INSERT = {
    "I1": "dt_sintomas IS NULL",
    "I2": f"dt_sintomas > DATE '{TODAY}'",
    "I3": f"dt_sintomas < DATE '{EARLIEST}'",
    "I4": "dt_notificacao < dt_sintomas",
    "I5": "dt_obito < dt_sintomas",
    "I6": "cod_sexo IS NULL OR cod_sexo NOT IN ('M', 'F', 'I')",
    "I7": "cod_classificacao IS NULL OR cod_classificacao NOT IN (0, 1, 2, 8)",
    "I8": "cod_uf_resi IS NOT NULL AND cod_uf_resi NOT IN (SELECT cod_uf FROM dim_uf WHERE regiao <> 'EUROPE')",
}


@query(
    with_fact(
        "SELECT id_notif, concat_ws(',', "
        + ", ".join(f"CASE WHEN {test} THEN '{code}' END" for code, test in SQL_INSERT.items())
        + """) AS erros, idade_anos, faixa_etaria, CAST(isoyear(dt_sintomas) AS INT) AS nu_ano,
        CAST(week(dt_sintomas) AS INT) AS sem_sintomas FROM fato"""
    )
)
def validate_insert(g):
    served = g.uf.where("regiao <> 'EUROPE'")
    rows = rules.validate_insert(g.fact, served, today=TODAY, earliest=EARLIEST)
    return rows.select("id_notif", text("errors").alias("erros"), "idade_anos", "faixa_etaria", "nu_ano", "sem_sintomas")


@query(
    with_fact(
        f"SELECT id_notif, erros, avisos, nullif(split_part(erros, ',', 1), '') AS primeiro_erro FROM ({SQL_CHECKED})"
    )
)
def validate_clinical(g):
    return checked(g).select(
        "id_notif", text("errors").alias("erros"), text("warnings").alias("avisos"), F.col("first_error").alias("primeiro_erro")
    )


@query(
    with_fact(
        f"""SELECT id_notif, idade_anos, CASE WHEN idade_anos IS NOT NULL THEN {sql_band('idade_anos')} END AS faixa_etaria,
        CAST(coalesce(nu_ano, isoyear(dt_sintomas)) AS INT) AS nu_ano,
        CAST(coalesce(sem_sintomas, week(dt_sintomas)) AS INT) AS sem_sintomas FROM fato"""
    )
)
def fill_derived(g):
    bare = g.fact.withColumns(
        {"idade_anos": F.lit(None).cast("decimal(5,2)"), "faixa_etaria": F.lit(None).cast("string")}
    )
    return rules.fill_derived(bare).select("id_notif", "idade_anos", "faixa_etaria", "nu_ano", "sem_sintomas")


@query(with_fact(f"SELECT id_notif, CASE WHEN erros = '' THEN 'fato' ELSE 'quarentena' END AS destino FROM ({SQL_CHECKED})"))
def split_quarantine(g):
    passed, blocked = rules.split_quarantine(checked(g))
    return passed.select("id_notif", F.lit("fato").alias("destino")).unionByName(
        blocked.select("id_notif", F.lit("quarentena").alias("destino"))
    )


@query(
    with_fact(
        " UNION ALL ".join(
            f"SELECT '{code}' AS regra, 'erro' AS gravidade, count(*) AS n_linhas FROM fato WHERE {test} HAVING count(*) > 0"
            for code, test in SQL_RULES.items()
        )
        + f" UNION ALL SELECT 'B1', 'aviso', count(*) FROM fato WHERE {SQL_WARNING} HAVING count(*) > 0"
    )
)
def rule_report(g):
    return rules.rule_report(checked(g))


SQL_PAIRED = """SELECT coalesce(a.id_notif, b.id_notif) AS id_notif, b.id_notif IS NOT NULL AS existia, a.id_notif IS NOT NULL AS existe,
        b.cod_classificacao AS classificacao_antes, a.cod_classificacao AS classificacao_depois
        FROM antes b FULL JOIN depois a ON a.id_notif = b.id_notif"""


def pairs_shown(paired):
    return paired.select(
        "id_notif",
        F.col("antes").isNotNull().alias("existia"),
        F.col("depois").isNotNull().alias("existe"),
        F.col("antes.cod_classificacao").alias("classificacao_antes"),
        F.col("depois.cod_classificacao").alias("classificacao_depois"),
    )


@query(with_snapshots(SQL_PAIRED))
def snapshot_join(g):
    return pairs_shown(audit.snapshot_join(g.before(), g.after(), ["id_notif"]))


@query(with_snapshots(SQL_PAIRED))
def snapshot_join_bucketed(g):
    """Both snapshots saved in buckets of the key first, so that the join itself moves no row."""
    sides = []
    for rows in (g.before(), g.after()):
        path = scratch_dir(g.spark, "bucketed")
        sides.append(warehouse.save_bucketed(rows, f"ficha_{path[-32:]}", ["id_notif"], 8, path))
    return pairs_shown(audit.snapshot_join(*sides, ["id_notif"]))


def sql_snapshot(row: str) -> str:
    def number(c: str) -> str:
        return f"coalesce(CAST({row}.{c} AS VARCHAR), 'null')"

    return (
        f"""CASE WHEN {row}.id_notif IS NOT NULL THEN concat('{{"id_notif":', {row}.id_notif, ',"dt_sintomas":"', """
        f"""strftime({row}.dt_sintomas, '%Y-%m-%d'), '","cod_uf_resi":', {number('cod_uf_resi')}, ',"cod_sexo":', """
        f"""coalesce('"' || {row}.cod_sexo || '"', 'null'), ',"cod_evolucao":', {number('cod_evolucao')}, """
        f"""',"cod_classificacao":', {number('cod_classificacao')}, '}}') END"""
    )


SQL_AUDIT = (
    f"""SELECT 'fato_notificacao' AS tabela, CASE WHEN b.id_notif IS NULL THEN 'I' WHEN a.id_notif IS NULL THEN 'D' ELSE 'U' END AS operacao,
        CAST(coalesce(a.id_notif, b.id_notif) AS VARCHAR) AS pk_alvo, {sql_snapshot('b')} AS dados_antes, {sql_snapshot('a')} AS dados_depois,
        CASE WHEN a.id_notif IS NOT NULL AND b.id_notif IS NOT NULL THEN concat('{{"cod_classificacao":{{"de":"', b.cod_classificacao,
          '","para":"', a.cod_classificacao, '"}}}}') END AS diff
        FROM antes b FULL JOIN depois a ON a.id_notif = b.id_notif
        WHERE b.id_notif IS NULL OR a.id_notif IS NULL OR a.cod_classificacao IS DISTINCT FROM b.cod_classificacao"""
)


@query(with_snapshots(SQL_AUDIT))
def audit_diff(g):
    log = audit.audit_diff(g.before(), g.after(), ["id_notif"], "fato_notificacao")
    return log.withColumn("diff", F.to_json("diff"))


@query(with_snapshots(SQL_AUDIT))
def audit_diff_wide(g):
    """The same log from stored snapshots with row hashes, where only changed rows are fetched whole."""
    before, after = (written(audit.with_row_hash(rows), "snapshot") for rows in (g.before(), g.after()))
    log = audit.audit_diff_wide(before, after, ["id_notif"], "fato_notificacao")
    return log.withColumn("diff", F.to_json("diff"))


# A third of all forms stand in one place, of one sex and without an age: one group over all dates.
SQL_CROWDED = """SELECT id_notif, dt_sintomas, CAST(CASE WHEN id_notif % 3 = 0 THEN 100000 ELSE cod_mun_resi END AS INT) AS cod_mun_resi,
  CASE WHEN id_notif % 3 = 0 THEN 'F' ELSE cod_sexo END AS cod_sexo, CASE WHEN id_notif % 3 <> 0 THEN idade_anos END AS idade_anos FROM fato"""


SQL_FORMS = "SELECT id_notif, dt_sintomas, cod_mun_resi, cod_sexo, idade_anos FROM fato"


def crowded(g):
    third = F.col("id_notif") % 3 == 0
    return g.fact.withColumns(
        {
            "cod_mun_resi": F.when(third, 100000).otherwise(F.col("cod_mun_resi")),
            "cod_sexo": F.when(third, "F").otherwise(F.col("cod_sexo")),
            "idade_anos": F.when(~third, F.col("idade_anos")),
        }
    )


def sql_similar(days: int = 3, rows: str = SQL_CROWDED) -> str:
    return f"""SELECT *, CAST(round(idade_anos, 0) AS INT) AS idade,
      CASE WHEN idade_anos IS NOT NULL THEN CAST(dt_sintomas - CAST(dayofyear(dt_sintomas) % {days} AS INT) AS DATE) END AS balde
    FROM ({rows}) WHERE cod_mun_resi IS NOT NULL AND cod_sexo IS NOT NULL AND dt_sintomas IS NOT NULL"""


SQL_HASH = "md5(CAST(cod_mun_resi AS VARCHAR) || cod_sexo || CAST(idade AS VARCHAR) || strftime(balde, '%Y-%m-%d')) AS grupo_hash"


def sql_groups(days: int = 3, rows: str = SQL_CROWDED) -> str:
    return f"""SELECT {SQL_HASH}, count(*) AS n_ocorrencias, cod_mun_resi, cod_sexo, CAST(idade AS DECIMAL(6,2)) AS idade_anos,
      min(dt_sintomas) AS dt_sintomas_min, max(dt_sintomas) AS dt_sintomas_max
    FROM ({sql_similar(days, rows)}) GROUP BY cod_mun_resi, cod_sexo, idade, balde HAVING count(*) > 1"""


@query(with_fact(sql_groups(rows=SQL_FORMS)))
def detect_duplicates(g):
    return duplicates.detect_duplicates(g.fact)


@query(with_fact(sql_groups()))
def detect_duplicates_crowded(g):
    """The same where one group holds a third of all forms."""
    return duplicates.detect_duplicates(crowded(g))


@query(
    with_fact(
        f"""SELECT id_notif, {SQL_HASH}, n_ocorrencias, cod_mun_resi, cod_sexo, CAST(idade AS DECIMAL(6,2)) AS idade_anos,
          dt_sintomas_min, dt_sintomas_max
        FROM (SELECT *, count(*) OVER w AS n_ocorrencias, min(dt_sintomas) OVER w AS dt_sintomas_min, max(dt_sintomas) OVER w AS dt_sintomas_max
          FROM ({sql_similar()}) WINDOW w AS (PARTITION BY cod_mun_resi, cod_sexo, idade, balde))
        WHERE n_ocorrencias > 1"""
    )
)
def duplicate_members(g):
    return duplicates.duplicate_members(crowded(g))


@query(
    with_fact(
        f"""SELECT * FROM ({sql_groups()}) ORDER BY n_ocorrencias DESC, dt_sintomas_min, cod_mun_resi, cod_sexo,
        idade_anos NULLS LAST, dt_sintomas_max, grupo_hash NULLS LAST LIMIT 20"""
    )
)
def duplicate_top(g):
    return reports.duplicate_top(duplicates.detect_duplicates(crowded(g)))


@query(
    with_fact(
        """SELECT cod_mun_resi, cod_sexo, idade_anos, count(*) AS n_ocorrencias, string_agg(CAST(id_notif AS VARCHAR), ',' ORDER BY id_notif) AS ids_duplicados,
          min(dt_sintomas) AS dt_sintomas_min, max(dt_sintomas) AS dt_sintomas_max
        FROM (SELECT *, sum(novo) OVER (PARTITION BY cod_mun_resi, cod_sexo, idade_anos ORDER BY dt_sintomas, id_notif) AS grupo
          FROM (SELECT *, CASE WHEN date_diff('day', lag(dt_sintomas) OVER (PARTITION BY cod_mun_resi, cod_sexo, idade_anos ORDER BY dt_sintomas, id_notif), dt_sintomas) <= 3
                THEN 0 ELSE 1 END AS novo
            FROM (SELECT id_notif, cod_mun_resi, cod_sexo, CAST(round(idade_anos, 0) AS DECIMAL(6,2)) AS idade_anos, dt_sintomas
                  FROM fato WHERE cod_mun_resi IS NOT NULL AND cod_sexo IS NOT NULL AND dt_sintomas IS NOT NULL)))
        GROUP BY cod_mun_resi, cod_sexo, idade_anos, grupo HAVING count(*) > 1"""
    )
)
def duplicate_window(g):
    """Members of the chained groups, put together again for the comparison."""
    group = ["n_ocorrencias", "cod_mun_resi", "cod_sexo", "idade_anos", "dt_sintomas_min", "dt_sintomas_max"]
    members = duplicates.duplicate_members(g.fact, mode="window").groupBy(*group)
    ids = F.sort_array(F.collect_list("id_notif")).cast("array<string>")
    return members.agg(F.array_join(ids, ",").alias("ids_duplicados"))


@query(
    with_fact(
        " UNION ALL ".join(
            f"SELECT {days} AS janela, * FROM ({sql_groups(days, SQL_FORMS)})"
            for days in (3, 7)
        )
    )
)
def sql_duplicates(g):
    """The SQL function with its own width and with another."""
    session = sql_session(g)
    three = session.sql("SELECT 3 AS janela, * FROM fn_detectar_duplicatas()")
    return three.unionByName(session.sql("SELECT 7 AS janela, * FROM fn_detectar_duplicatas(7)"))
