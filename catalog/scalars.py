"""Cleaning guards, scalar functions and filters, row by row over the whole derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.given import query, sql_pct, with_fact, with_staging
from sentinela.functions import ages, cleaning, dates, numbers, text
from sentinela.operators import dimensions, filters
from sentinela.plans import marts, reports
from sentinela.schemas import FACT_COLUMNS

INT_COLUMNS = [column.source for column in FACT_COLUMNS if column.kind == "int"]
DATE_COLUMNS = ["dt_sin_pri", "dt_notific", "dt_invest", "dt_obito", "dt_encerra", "dt_digita"]


def sql_int(column: str, kind: str = "INTEGER") -> str:
    return f"CASE WHEN regexp_full_match({column}, '[0-9]+') THEN TRY_CAST({column} AS {kind}) END"


def sql_date(column: str) -> str:
    return f"CASE WHEN regexp_full_match({column}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN TRY_CAST({column} AS DATE) END"


@query(
    with_staging(
        "SELECT linha_id, "
        + ", ".join(f"{sql_int(c)} AS {c}" for c in INT_COLUMNS)
        + f", {sql_int('id_unidade', 'BIGINT')} AS id_unidade FROM stg"
    )
)
def guard_int(g):
    return g.staging.select(
        "linha_id",
        *[cleaning.guard_int(F.col(c)).alias(c) for c in INT_COLUMNS],
        cleaning.guard_int(F.col("id_unidade"), "bigint").alias("id_unidade"),
    )


@query(with_staging("SELECT linha_id, " + ", ".join(f"{sql_date(c)} AS {c}" for c in DATE_COLUMNS) + " FROM stg"))
def guard_date(g):
    return g.staging.select("linha_id", *[cleaning.guard_date(F.col(c)).alias(c) for c in DATE_COLUMNS])


SQL_FILE_YEAR = """CASE WHEN regexp_full_match(ano_arquivo, '[0-9]{4}') THEN CAST(ano_arquivo AS BIGINT)
  WHEN length(ano_arquivo) > 4 THEN TRY_CAST(left(ano_arquivo, 4) AS BIGINT) END"""


@query(with_staging(f"SELECT linha_id, {SQL_FILE_YEAR} AS ano_arquivo FROM stg"))
def file_year(g):
    return g.staging.select("linha_id", cleaning.file_year(F.col("ano_arquivo")).alias("ano_arquivo"))


def sql_municipality(column: str) -> str:
    return f"CASE WHEN regexp_full_match({column}, '[0-9]+') THEN CAST(left({column}, 6) AS INTEGER) END"


@query(
    with_staging(
        "SELECT linha_id, "
        + ", ".join(f"{sql_municipality(c)} AS {c}" for c in ("id_municip", "id_mn_resi", "comuninf"))
        + " FROM stg"
    )
)
def canon_municipality(g):
    return g.staging.select(
        "linha_id",
        *[cleaning.canon_municipality(F.col(c)).alias(c) for c in ("id_municip", "id_mn_resi", "comuninf")],
    )


@query(with_staging("SELECT linha_id, CASE WHEN cs_sexo IN ('M', 'F') THEN cs_sexo END AS cod_sexo FROM stg"))
def clean_sex(g):
    return g.staging.select("linha_id", cleaning.clean_sex(F.col("cs_sexo")).alias("cod_sexo"))


@query(
    with_staging(
        "SELECT linha_id, CASE WHEN regexp_full_match(ano_nasc, '[0-9]{4}') THEN CAST(ano_nasc AS BIGINT) END AS ano_nascimento FROM stg"
    )
)
def clean_birth_year(g):
    return g.staging.select("linha_id", cleaning.clean_birth_year(F.col("ano_nasc")).alias("ano_nascimento"))


@query(
    with_staging(
        "SELECT linha_id, CASE WHEN regexp_full_match(id_ocupa_n, '[0-9]+') THEN id_ocupa_n END AS cod_ocupacao FROM stg"
    )
)
def clean_occupation(g):
    return g.staging.select("linha_id", cleaning.clean_occupation(F.col("id_ocupa_n")).alias("cod_ocupacao"))


@query(
    with_fact(
        "SELECT id_notif, idade_decodificada, CAST(idade_decodificada AS DECIMAL(5,2)) AS idade_anos FROM decodificadas"
    )
)
def decode_age(g):
    code = F.col("nu_idade_codificada")
    return g.fact.select(
        "id_notif", ages.decode_age(code).alias("idade_decodificada"), ages.stored_age(code).alias("idade_anos")
    )


@query(with_fact("SELECT id_notif, faixa_etaria FROM fato"))
def age_band(g):
    return g.fact.select("id_notif", ages.age_band(F.col("idade_decodificada")).alias("faixa_etaria"))


@query(
    with_fact(
        "SELECT id_notif, CAST(isoyear(dt_sintomas) AS INT) AS ano_iso, CAST(week(dt_sintomas) AS INT) AS semana_iso FROM fato"
    )
)
def iso_year_week(g):
    day = F.col("dt_sintomas")
    return g.fact.select("id_notif", dates.iso_year(day).alias("ano_iso"), dates.iso_week(day).alias("semana_iso"))


@query(with_fact("SELECT id_notif, CAST(date_trunc('week', dt_sintomas) AS DATE) AS inicio_sem FROM fato"))
def week_start(g):
    return g.fact.select("id_notif", dates.week_start(F.col("dt_sintomas")).alias("inicio_sem"))


@query(
    with_fact(
        """SELECT id_notif, CAST(date_diff('day', dt_sintomas, dt_notificacao) AS INT) AS dias_notificacao,
        CAST(date_diff('day', dt_sintomas, dt_obito) AS INT) AS dias_obito FROM fato"""
    )
)
def days_between(g):
    day = F.col("dt_sintomas")
    return g.fact.select(
        "id_notif",
        dates.days_between(F.col("dt_notificacao"), day).alias("dias_notificacao"),
        dates.days_between(F.col("dt_obito"), day).alias("dias_obito"),
    )


@query(
    with_fact(
        "SELECT id_notif, CAST(dt_sintomas - CAST(dayofyear(dt_sintomas) % 3 AS INT) AS DATE) AS balde FROM fato"
    )
)
def date_bucket(g):
    return g.fact.select("id_notif", dates.date_bucket(F.col("dt_sintomas"), 3).alias("balde"))


@query(
    with_fact(
        """SELECT id_notif, md5(CAST(cod_mun_resi AS VARCHAR) || cod_sexo || CAST(nu_idade_codificada AS VARCHAR)
        || strftime(dt_sintomas, '%Y-%m-%d')) AS grupo_hash FROM fato"""
    )
)
def group_hash(g):
    parts = [F.col(c) for c in ("cod_mun_resi", "cod_sexo", "nu_idade_codificada", "dt_sintomas")]
    return g.fact.select("id_notif", text.group_hash(*parts).alias("grupo_hash"))


@query(
    with_fact(
        f"""SELECT cod_mun_resi, obitos, confirmados, {sql_pct('obitos', 'confirmados')} AS letalidade_pct FROM (
        SELECT cod_mun_resi, count(CASE WHEN cod_evolucao = 2 THEN 1 END) AS obitos,
          count(CASE WHEN cod_classificacao = 1 THEN 1 END) AS confirmados FROM fato GROUP BY cod_mun_resi)"""
    )
)
def safe_pct(g):
    counts = g.fact.groupBy("cod_mun_resi").agg(
        marts.count_of(marts.died(), "obitos"), marts.count_of(marts.confirmed(), "confirmados")
    )
    return counts.withColumn("letalidade_pct", numbers.safe_pct(F.col("obitos"), F.col("confirmados")))


@query(
    with_fact(
        f"""SELECT a.id_notif,
        concat('{{"id_notif":', a.id_notif, ',"dt_sintomas":"', strftime(a.dt_sintomas, '%Y-%m-%d'), '","cod_uf_resi":',
          coalesce(CAST(a.cod_uf_resi AS VARCHAR), 'null'), ',"cod_classificacao":', a.cod_classificacao, '}}') AS linha_json,
        CASE WHEN a.cod_classificacao IS DISTINCT FROM b.cod_classificacao THEN concat('{{"cod_classificacao":{{"de":"',
          b.cod_classificacao, '","para":"', a.cod_classificacao, '"}}}}') END AS diff_json,
        a.cod_classificacao IS DISTINCT FROM b.cod_classificacao AS mudou_classificacao
        FROM (SELECT id_notif, dt_sintomas, cod_uf_resi, cod_classificacao FROM fato) a
        JOIN (SELECT id_notif, CASE WHEN dt_encerramento >= DATE '2000-06-01' THEN 2 ELSE cod_classificacao END AS cod_classificacao
              FROM fato) b USING (id_notif)"""
    )
)
def json_diff(g):
    after = ["id_notif", "dt_sintomas", "cod_uf_resi", "cod_classificacao"]
    open_then = F.when(F.col("dt_encerramento") >= "2000-06-01", 2).otherwise(F.col("cod_classificacao"))
    pairs = g.fact.select(
        "id_notif",
        F.struct(*after).alias("depois"),
        F.struct(*after[:3], open_then.alias("cod_classificacao")).alias("antes"),
    )
    diff = text.field_diff("antes", "depois", after)
    return pairs.select(
        "id_notif",
        text.row_json(*[F.col(f"depois.{c}").alias(c) for c in after]).alias("linha_json"),
        F.to_json(diff).alias("diff_json"),
        F.coalesce(F.map_contains_key(diff, "cod_classificacao"), F.lit(False)).alias("mudou_classificacao"),
    )


@query(
    with_fact(
        "SELECT DISTINCT cod_mun_notif, concat('MUN-', cod_mun_notif) AS nome FROM fato WHERE cod_mun_notif IS NOT NULL"
    )
)
def label_code(g):
    codes = g.fact.select("cod_mun_notif").where(F.col("cod_mun_notif").isNotNull()).distinct()
    return codes.withColumn("nome", cleaning.label_code("MUN", F.col("cod_mun_notif")))


@query(
    with_fact(
        """SELECT faixa_etaria, CAST(CASE WHEN min(idade_decodificada) IS NOT NULL THEN
          row_number() OVER (ORDER BY min(idade_decodificada) NULLS LAST) END AS INT) AS ordem, count(*) AS n
        FROM fato GROUP BY faixa_etaria"""
    )
)
def category_order(g):
    counts = g.fact.groupBy("faixa_etaria").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("ordem", ages.category_order(F.col("faixa_etaria")))


@query(
    with_fact(
        """SELECT nu_ano AS ano, count(*) AS casos_total, count(CASE WHEN cod_classificacao = 1 THEN 1 END) AS casos_confirmados
        FROM fato JOIN dim_uf ON cod_uf = cod_uf_resi GROUP BY nu_ano"""
    )
)
def choose_measure(g):
    cases = marts.state_year_cases(g.fact, g.uf)
    measures = [reports.choose_measure(only) for only in (False, True)]
    return cases.groupBy("ano").agg(*[F.sum(m).alias(m) for m in measures])


@query(
    with_fact(
        """SELECT descricao AS sexo, nu_ano AS ano, CAST(CASE WHEN cod = 'M' THEN -1 ELSE 1 END * count(*) AS BIGINT) AS casos
        FROM fato JOIN dim_sexo ON cod = cod_sexo GROUP BY descricao, cod, nu_ano"""
    )
)
def mirror_male(g):
    counts = marts.age_pyramid(g.fact, g.list("sexo")).groupBy("sexo", "ano").agg(F.sum("casos_total").alias("n"))
    return counts.select("sexo", "ano", numbers.mirror_male(F.col("sexo"), F.col("n")).alias("casos"))


SQL_TRIGRAMS = """list_distinct(flatten(list_transform(
  list_filter(regexp_split_to_array(strip_accents(lower({})), '[^a-z0-9]+'), lambda w: length(w) > 0),
  lambda w: list_transform(range(1, CAST(length(w) + 2 AS BIGINT)), lambda i: substring('  ' || w || ' ', i, 3)))))"""


@query(
    f"""WITH nomes AS (SELECT p_partkey, p_name, {SQL_TRIGRAMS.format('p_name')} AS a,
        {SQL_TRIGRAMS.format("'" + 'small rings' + "'")} AS b FROM part)
    SELECT p_partkey, p_name, CAST(round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 6) AS DECIMAL(9,6)) AS semelhanca
    FROM nomes WHERE len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) >= 0.3"""
)
def fuzzy_name_lookup(g):
    found = dimensions.name_lookup(g.table("part").select("p_partkey", "p_name"), "p_name", "Smáll, RINGS", 0.3)
    return found.withColumn("semelhanca", F.round("semelhanca", 6).cast("decimal(9,6)"))


# Every hundredth part's name with its first word in capitals and the last left out, against all names.
SQL_WANTED = "SELECT DISTINCT upper(p_name[1:3]) || p_name[4:-3] AS procurado FROM part WHERE p_partkey % 100 = 0"


@query(
    f"""WITH pedidos AS (SELECT procurado, {SQL_TRIGRAMS.format('procurado')} AS a FROM ({SQL_WANTED})),
    nomes AS (SELECT p_partkey, p_name, {SQL_TRIGRAMS.format('p_name')} AS b FROM part)
    SELECT procurado, p_partkey, p_name,
      CAST(round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 6) AS DECIMAL(9,6)) AS semelhanca
    FROM pedidos, nomes WHERE len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) >= 0.5"""
)
def name_matches(g):
    parts = g.table("part").select("p_partkey", "p_name")
    start, rest = F.substring("p_name", 1, 3), F.expr("substring(p_name, 4, length(p_name) - 5)")
    wanted = parts.where(F.col("p_partkey") % 100 == 0).select(F.concat(F.upper(start), rest).alias("procurado"))
    found = dimensions.name_matches(wanted, parts, "p_name", 0.5)
    return found.withColumn("semelhanca", F.round("semelhanca", 6).cast("decimal(9,6)"))


# Filters.

@query(
    with_staging(
        "SELECT linha_id, dt_sin_pri FROM stg WHERE regexp_full_match(dt_sin_pri, '[0-9]{4}-[0-9]{2}-[0-9]{2}')"
    )
)
def admit_rows(g):
    return filters.admit_rows(g.staging).select("linha_id", "dt_sin_pri")


@query(with_fact("SELECT id_notif, sem_sintomas FROM fato WHERE dt_sintomas IS NOT NULL AND sem_sintomas BETWEEN 1 AND 53"))
def valid_week(g):
    return g.fact.where(filters.valid_week()).select("id_notif", "sem_sintomas")


@query(
    with_fact(
        """SELECT nu_ano, n.sigla, count(*) AS n_fichas FROM fato LEFT JOIN dim_uf n ON n.cod_uf = cod_uf_resi
        WHERE n.sigla = 'NATION_7' AND nu_ano = 1998 GROUP BY ALL"""
    )
)
def optional_filter(g):
    counts = g.fact.groupBy("nu_ano", "cod_uf_resi").agg(marts.total("n_fichas"))
    named = marts.state_of(counts, g.uf, "cod_uf_resi", "left")
    return filters.optional_filter(named, sigla="NATION_7", nu_ano=1998, regiao=None).select("nu_ano", "sigla", "n_fichas")


@query(
    with_fact(
        """SELECT sigla AS uf, nu_ano AS ano, count(*) AS casos_total FROM fato JOIN dim_uf ON cod_uf = cod_uf_resi
        WHERE sigla IN ('NATION_1', 'NATION_3', 'NATION_7') AND nu_ano BETWEEN 1996 AND 1999 GROUP BY ALL"""
    )
)
def report_filter(g):
    mart = marts.state_year_cases(g.fact, g.uf)
    chosen = filters.report_filter(mart, ["NATION_1", "NATION_3", "NATION_7"], (1996, 1999))
    return chosen.select("uf", "ano", "casos_total")


@query(with_fact("SELECT id_notif, cod_sexo FROM fato WHERE cod_sexo IN ('M', 'F')"))
def sex_known(g):
    return g.fact.where(filters.sex_known()).select("id_notif", "cod_sexo")


@query(with_fact("SELECT id_notif, cod_gestante FROM fato WHERE cod_gestante BETWEEN 1 AND 4"))
def pregnant_only(g):
    return g.fact.where(filters.pregnant()).select("id_notif", "cod_gestante")


@query(
    with_fact(
        "SELECT id_notif, dt_notificacao FROM fato WHERE date_diff('day', dt_sintomas, dt_notificacao) BETWEEN 0 AND 365"
    )
)
def latency_window(g):
    return g.fact.where(filters.latency_window()).select("id_notif", "dt_notificacao")


@query(with_fact("SELECT id_notif, faixa_etaria FROM fato WHERE faixa_etaria <> 'Ignorada'"))
def band_known(g):
    return g.fact.where(filters.band_known()).select("id_notif", "faixa_etaria")


@query(
    with_fact("SELECT cod_mun_resi, count(*) AS notificacoes FROM fato GROUP BY cod_mun_resi HAVING count(*) >= 30")
)
def having_min_rows(g):
    counts = g.fact.groupBy("cod_mun_resi").agg(F.count(F.lit(1)).alias("notificacoes"))
    return filters.having_min_rows(counts, "notificacoes", 30)
