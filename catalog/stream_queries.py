"""Streams over the given tables, run to their end."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.given import SQL_AGE, query, with_fact
from catalog.load_queries import SQL_REJECTED, raw_file, with_clean
from catalog.mart_queries import CONF, MONDAY
from catalog.quality_queries import EARLIEST, SQL_INSERT, SQL_RULES, TODAY
from sentinela.functions.dates import week_start
from sentinela.plans.marts import confirmed, count_of, total
from sentinela.session import scratch_dir, written
from sentinela.streaming import ingest


def finish(stream) -> None:
    stream.awaitTermination()


# Both rule sets over the accepted lines, those of the insert first.
SQL_STREAM_RULES = {
    **SQL_INSERT,
    "I8": "cod_uf_resi IS NOT NULL AND cod_uf_resi NOT IN (SELECT cod_uf FROM ufs)",
    **SQL_RULES,
}
SQL_STREAM = f"""SELECT CASE WHEN motivos = '' THEN 'fato' ELSE 'quarentena' END AS destino, motivos,
    coalesce(nu_ano, CAST(isoyear(dt_sintomas) AS INT)) AS nu_ano, cod_classificacao,
    count(*) AS n_fichas, min(dt_sintomas) AS primeira, max(dt_sintomas) AS ultima
  FROM (SELECT *, concat_ws(',', {", ".join(f"CASE WHEN {test} THEN '{code}' END" for code, test in SQL_STREAM_RULES.items())}) AS motivos
    FROM (SELECT *, CAST({SQL_AGE} AS DECIMAL(5,2)) AS idade_anos FROM aceitas))
  GROUP BY ALL
  UNION ALL SELECT 'recusadas', motivos, CAST(NULL AS INT), CAST(NULL AS INT), count(*), CAST(NULL AS DATE), CAST(NULL AS DATE)
  FROM ({SQL_REJECTED}) GROUP BY motivos"""


@query(with_clean(SQL_STREAM))
def stream_ingest(g):
    """Every line under the rules of the insert and the clinical ones: stored, held back or refused."""
    out = scratch_dir(g.spark, "ingest")
    raw = ingest.read_raw_stream(g.spark, raw_file(g))
    checkpoint = scratch_dir(g.spark, "ingest-checkpoint")
    finish(ingest.stream_ingest(raw, out, checkpoint, dim_uf=g.states, today=TODAY, earliest=EARLIEST))

    def counted(name: str, reasons: str, *keys):
        rows = g.spark.read.parquet(f"{out}/{name}")
        rows = rows.select(F.lit(name).alias("destino"), F.concat_ws(",", reasons).alias("motivos"), *keys)
        return rows.groupBy("destino", "motivos", "nu_ano", "cod_classificacao").agg(
            F.count(F.lit(1)).alias("n_fichas"),
            F.min("dt_sintomas").alias("primeira"),
            F.max("dt_sintomas").alias("ultima"),
        )

    columns = ["nu_ano", "cod_classificacao", "dt_sintomas"]
    none = [F.lit(None).cast(kind).alias(name) for name, kind in zip(columns, ("int", "int", "date"))]
    passed = counted("fato", F.array().cast("array<string>"), *columns)
    return passed.unionByName(counted("quarentena", "errors", *columns)).unionByName(counted("recusadas", "motivos", *none))


def order_stream(g):
    schema = g.table("orders").schema
    return g.spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet").parquet(g.folder)


@query(
    with_fact(
        f"SELECT {MONDAY} AS inicio_sem, cod_uf_resi, count(*) AS casos_total, {CONF} AS casos_confirmados FROM fato GROUP BY ALL"
    )
)
def stream_weekly_counts(g):
    out = scratch_dir(g.spark, "weekly")
    forms = g.derive_fact(order_stream(g))
    finish(ingest.stream_weekly_counts(forms, out, scratch_dir(g.spark, "weekly-checkpoint")))
    return ingest.latest_counts(g.spark, out)


# Forms arrive in three batches: the early years, the late years, and every fiftieth form after all.
LATENESS = 180
SQL_ARRIVAL = "CASE WHEN id_notif % 50 = 0 THEN 2 WHEN dt_sintomas < DATE '1996-01-01' THEN 0 ELSE 1 END"
SQL_WEEK_COUNTS = f"inicio_sem, cod_uf_resi, count(*) AS casos_total, {CONF} AS casos_confirmados"


@query(
    with_fact(
        f""", chegadas AS (SELECT *, {SQL_ARRIVAL} AS lote, {MONDAY} AS inicio_sem FROM fato),
        limites AS (SELECT n AS lote, (SELECT max(dt_sintomas) FROM chegadas WHERE lote < n) - {LATENESS} AS limite FROM range(0, 4) t(n)),
        julgadas AS (SELECT c.*, coalesce(c.inicio_sem + 7 <= l.limite, false) AS atrasada FROM chegadas c JOIN limites l USING (lote))
        SELECT CASE WHEN inicio_sem + 7 <= (SELECT limite FROM limites WHERE lote = 3) THEN 'fechada' ELSE 'aberta' END AS destino,
          {SQL_WEEK_COUNTS} FROM julgadas WHERE NOT atrasada GROUP BY inicio_sem, cod_uf_resi
        UNION ALL SELECT 'atrasada', {SQL_WEEK_COUNTS} FROM julgadas WHERE atrasada GROUP BY inicio_sem, cod_uf_resi"""
    )
)
def stream_late_weeks(g):
    """Closed weeks, open weeks, and the forms that came for a closed week, by week and state."""
    arrival = F.when(F.col("id_notif") % 50 == 0, 2).when(F.col("dt_sintomas") < "1996-01-01", 0).otherwise(1)
    forms = written(g.fact.select("id_notif", "dt_sintomas", "cod_uf_resi", "cod_classificacao", arrival.alias("chegada")), "forms")
    folder, out, checkpoint = (scratch_dir(g.spark, name) for name in ("arriving", "weeks", "weeks-checkpoint"))
    schema = forms.drop("chegada").schema
    for number in range(3):
        forms.where(F.col("chegada") == number).drop("chegada").write.parquet(f"{folder}/{number}")
        arriving = g.spark.readStream.schema(schema).parquet(f"{folder}/*")
        finish(ingest.stream_weekly_counts(arriving, out, checkpoint, f"{LATENESS} days"))
    closed = ingest.closed_weeks(g.spark, out).withColumn("destino", F.lit("fechada"))
    open_weeks = ingest.latest_counts(g.spark, out).join(closed, ["inicio_sem"], "left_anti").withColumn("destino", F.lit("aberta"))
    late = ingest.late_forms(g.spark, out).groupBy(week_start(F.col("dt_sintomas")).alias("inicio_sem"), "cod_uf_resi")
    late = late.agg(total(), count_of(confirmed(), "casos_confirmados")).withColumn("destino", F.lit("atrasada"))
    return closed.unionByName(open_weeks).unionByName(late)


# The second version of a form whose number leaves 1 when divided by 3 comes before its first one.
EARLY = "id_notif % 3 = 1"


def sql_version(classification: str) -> str:
    return (
        """concat('{"id_notif":', id_notif, ',"dt_sintomas":"', strftime(dt_sintomas, '%Y-%m-%d'), """
        f"""'","cod_classificacao":', {classification}, '}}')"""
    )


@query(
    with_fact(
        f"""SELECT 'I' AS operacao, CAST(id_notif AS VARCHAR) AS pk_alvo, CAST(NULL AS VARCHAR) AS dados_antes,
          {sql_version('2')} AS dados_depois, CAST(NULL AS VARCHAR) AS diff FROM fato
        UNION ALL SELECT CASE WHEN {EARLY} THEN 'I' ELSE 'U' END, CAST(id_notif AS VARCHAR),
          CASE WHEN NOT {EARLY} THEN {sql_version('2')} END, {sql_version('cod_classificacao')},
          CASE WHEN NOT {EARLY} THEN concat('{{"cod_classificacao":{{"de":"2","para":"', cod_classificacao, '"}}}}') END
        FROM fato WHERE dt_encerramento IS NOT NULL AND ({EARLY} OR cod_classificacao <> 2)"""
    )
)
def stream_audit(g):
    """Every form is under investigation until a closing brings its final classification.

    The versions arrive in three batches, those of a third of the forms in the wrong order.
    """
    versions = g.fact.select(
        "id_notif",
        "dt_sintomas",
        F.explode(
            F.array_compact(
                F.array(
                    F.struct(F.lit(1).alias("versao"), F.lit(2).alias("cod_classificacao")),
                    F.when(
                        F.col("dt_encerramento").isNotNull(),
                        F.struct(F.lit(2).alias("versao"), F.col("cod_classificacao")),
                    ),
                )
            )
        ).alias("v"),
    ).select("id_notif", "dt_sintomas", "v.versao", "v.cod_classificacao")
    arrival = F.pmod(F.col("id_notif") + F.col("versao"), F.lit(3))
    versions = written(versions.withColumn("chegada", arrival), "versions")
    folder, out, checkpoint = (scratch_dir(g.spark, name) for name in ("arriving", "audit", "audit-checkpoint"))
    schema = versions.drop("chegada").schema
    for number in range(3):
        versions.where(F.col("chegada") == number).drop("chegada").write.parquet(f"{folder}/{number}")
        arriving = g.spark.readStream.schema(schema).parquet(f"{folder}/*")
        finish(ingest.stream_audit(arriving, out, checkpoint, "id_notif", "versao", "fato_notificacao", groups=4096))
    log = g.spark.read.parquet(f"{out}/auditoria")
    return log.select("operacao", "pk_alvo", "dados_antes", "dados_depois", F.to_json("diff").alias("diff"))
