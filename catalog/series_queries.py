"""Weekly series, trends, forecasts and clusters."""

from __future__ import annotations

import datetime as dt

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.given import FIRST_YEAR, LAST_YEAR, query, with_fact
from catalog.mart_queries import SQL_FEATURES, SQL_STATE_YEAR, SQL_WEEKLY_STATE, state_year, weekly_state
from sentinela.operators import clustering, timeseries
from sentinela.plans import marts, reports
from sentinela.session import scratch_dir, written
from sentinela.sources import csvfiles

KEYS = ["uf"]
FEATURES = clustering.FEATURES


def rounded(rows: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return rows.withColumns({c: F.round(c, digits).cast(f"decimal(18,{digits})") for c in columns})


def sql_rounded(value: str, digits: int = 6) -> str:
    return f"CAST(round({value}, {digits}) AS DECIMAL(18,{digits}))"


SQL_FILLED = f"""SELECT g.uf, g.inicio_sem, CAST(coalesce(s.n, 0) AS BIGINT) AS casos_confirmados FROM (
    SELECT uf, CAST(unnest(generate_series(min(inicio_sem), max(inicio_sem), INTERVAL 7 DAY)) AS DATE) AS inicio_sem
    FROM ({SQL_WEEKLY_STATE}) GROUP BY uf) g
  LEFT JOIN (SELECT uf, inicio_sem, sum(casos_confirmados) AS n FROM ({SQL_WEEKLY_STATE}) GROUP BY uf, inicio_sem) s
  USING (uf, inicio_sem)"""


@query(with_fact(SQL_FILLED))
def gap_fill_weekly(g):
    return timeseries.gap_fill_weekly(weekly_state(g), KEYS)


def decomposed(g):
    return timeseries.seasonal_decompose(weekly_state(g), KEYS)


@query()
def seasonal_decompose(g):
    return decomposed(g)


@query()
def seasonal_decompose_national(g):
    return timeseries.seasonal_decompose(marts.weekly_series(g.fact))


@query(
    with_fact(
        f"""SELECT uf, CAST(week(inicio_sem) AS INT) AS semana, {sql_rounded('avg(casos_confirmados - media)')} AS sazonal
        FROM (SELECT *, avg(casos_confirmados) OVER (PARTITION BY uf) AS media FROM ({SQL_FILLED})) GROUP BY ALL"""
    )
)
def seasonal_by_week(g):
    """Mean by ISO week of the deviation from each state's mean."""
    filled = timeseries.gap_fill_weekly(weekly_state(g), KEYS)
    means = filled.groupBy("uf").agg(F.avg("casos_confirmados").alias("media"))
    deviation = filled.join(means, "uf").withColumn("sazonal", F.col("casos_confirmados") - F.col("media"))
    return rounded(timeseries.seasonal_by_week(deviation, KEYS), "sazonal")


@query()
def seasonal_profile_stl(g):
    return timeseries.seasonal_by_week(decomposed(g), KEYS)


def trend(g):
    return timeseries.linear_trend(state_year(g), FIRST_YEAR, LAST_YEAR)


SQL_TREND = f"""SELECT uf, {sql_rounded('regr_slope(casos_confirmados, ano)')} AS slope_anual,
  {sql_rounded('regr_intercept(casos_confirmados, ano)', 4)} AS intercept,
  CAST(coalesce(sum(CASE WHEN ano = {FIRST_YEAR} THEN casos_confirmados END), 0) AS BIGINT) AS casos_{FIRST_YEAR},
  CAST(coalesce(sum(CASE WHEN ano = {LAST_YEAR} THEN casos_confirmados END), 0) AS BIGINT) AS casos_{LAST_YEAR}
  FROM ({SQL_STATE_YEAR}) WHERE ano BETWEEN {FIRST_YEAR} AND {LAST_YEAR} GROUP BY uf HAVING count(*) >= 3"""


def rounded_trend(rows: DataFrame) -> DataFrame:
    return rounded(rounded(rows, "slope_anual"), "intercept", digits=4)


@query(with_fact(SQL_TREND))
def linear_trend(g):
    return rounded_trend(trend(g))


@query(with_fact(SQL_TREND))
def export_csv(g):
    path = scratch_dir(g.spark, "export")
    csvfiles.export_csv(trend(g), path, single_file=True)
    return rounded_trend(csvfiles.read_result_csv(g.spark, path, trend(g).schema))


SQL_NOTED = f"""SELECT *, CASE WHEN semana_epi % 3 = 0 THEN NULL WHEN semana_epi % 3 = 1 THEN concat(' "', uf, '", a ')
  ELSE concat('  ', regiao) END AS nota FROM ({SQL_WEEKLY_STATE})"""


@query(with_fact(SQL_NOTED))
def read_result_csv(g):
    """The weekly mart with missing, quoted and blank-edged notes, written and read back."""
    third = F.col("semana_epi") % 3
    quoted = F.concat(F.lit(' "'), F.col("uf"), F.lit('", a '))
    note = F.when(third == 1, quoted).when(third == 2, F.concat(F.lit("  "), F.col("regiao")))
    noted = weekly_state(g).withColumn("nota", note)
    path = scratch_dir(g.spark, "noted")
    csvfiles.export_csv(noted, path)
    return csvfiles.read_result_csv(g.spark, path, noted.schema)


def forecast(g):
    return timeseries.forecast_weekly(weekly_state(g), KEYS)


@query()
def forecast_weekly(g):
    return forecast(g)


SQL_AHEAD = f"""SELECT uf, ds, true AS dentro FROM (
    SELECT uf, CAST(unnest(generate_series(min(inicio_sem), max(inicio_sem) + INTERVAL 364 DAY, INTERVAL 7 DAY)) AS DATE) AS ds
    FROM ({SQL_WEEKLY_STATE}) GROUP BY uf)"""


@query(with_fact(SQL_AHEAD))
def forecast_grid(g):
    """The weeks of the forecast, and that the estimate lies within its limits."""
    inside = F.col("yhat").between(F.col("yhat_lower"), F.col("yhat_upper"))
    return forecast(g).select("uf", "ds", inside.alias("dentro"))


@query(with_fact(f"SELECT DISTINCT uf, true AS dentro, true AS na_segunda FROM ({SQL_WEEKLY_STATE})"))
def trend_changes(g):
    """Whether the trend's bends of each state lie in the part of its series where it may bend, on Mondays."""
    filled = timeseries.gap_fill_weekly(weekly_state(g), KEYS)
    spans = filled.groupBy("uf").agg(F.min("inicio_sem").alias("primeira"), F.max("inicio_sem").alias("ultima"))
    bends = spans.join(timeseries.trend_changes(weekly_state(g), KEYS), "uf", "left")
    share = F.datediff("ds", "primeira") / F.datediff("ultima", "primeira")
    inside = F.coalesce((share > 0) & (share <= timeseries.REACH), F.lit(True))
    monday = F.coalesce(F.weekday("ds") == 0, F.lit(True))
    return bends.groupBy("uf").agg(F.bool_and(inside).alias("dentro"), F.bool_and(monday).alias("na_segunda"))


SINCE, UNTIL = dt.date(1993, 1, 1), dt.date(1997, 12, 31)


@query(
    with_fact(
        f"""SELECT uf, inicio_sem, CAST(sum(casos_confirmados) AS BIGINT) AS casos_confirmados,
          CASE WHEN inicio_sem < DATE '{SINCE}' THEN 'inicio_sem:early' ELSE 'inicio_sem:late' END AS motivo
        FROM ({SQL_WEEKLY_STATE}) WHERE inicio_sem < DATE '{SINCE}' OR inicio_sem > DATE '{UNTIL}' GROUP BY uf, inicio_sem"""
    )
)
def refused_weeks(g):
    return timeseries.refused_weeks(weekly_state(g), KEYS, since=SINCE, until=UNTIL)


@query(
    with_fact(
        f"""SELECT uf, inicio_sem, CAST(casos_confirmados AS DOUBLE) AS observado, {sql_rounded('casos_confirmados')} AS soma,
          count(*) OVER (PARTITION BY uf) < 104 AS serie_curta FROM ({SQL_FILLED})"""
    )
)
def decomposition_grid(g):
    """The weeks of the decomposition, what was observed, and the sum of the parts."""
    parts = F.col("tendencia") + F.col("sazonal") + F.col("residuo")
    rows = decomposed(g).withColumn("soma", F.coalesce(parts, F.col("observado")))
    return rounded(rows, "soma").select("uf", "inicio_sem", "observado", "soma", "serie_curta")


# A forecast frame made from the weekly mart, for the reports over forecasts.
SQL_FRAME = f"""SELECT uf, inicio_sem AS ds, CAST(sum(casos_total) AS DOUBLE) AS yhat, CAST(sum(casos_total) - 1 AS DOUBLE) AS yhat_lower,
  CAST(sum(casos_total) + sum(casos_confirmados) AS DOUBLE) AS yhat_upper FROM ({SQL_WEEKLY_STATE}) GROUP BY uf, inicio_sem"""


def given_forecast(g):
    weeks = weekly_state(g).groupBy("uf", F.col("inicio_sem").alias("ds"))
    total, confirmed = F.sum("casos_total"), F.sum("casos_confirmados")
    return weeks.agg(
        total.cast("double").alias("yhat"),
        (total - 1).cast("double").alias("yhat_lower"),
        (total + confirmed).cast("double").alias("yhat_upper"),
    )


@query(
    with_fact(
        " UNION ALL ".join(f"SELECT uf, ds, '{name}' AS serie, {name} AS casos FROM ({SQL_FRAME})" for name in ("yhat", "yhat_lower", "yhat_upper"))
    )
)
def forecast_bands(g):
    return reports.forecast_bands(given_forecast(g), tuple(KEYS))


@query(
    with_fact(
        f"""SELECT uf, ds, yhat, yhat_lower, yhat_upper
        FROM (SELECT *, row_number() OVER (PARTITION BY uf ORDER BY ds DESC) AS lugar FROM ({SQL_FRAME})) WHERE lugar <= 52"""
    )
)
def forecast_tail(g):
    return reports.last_n_rows(given_forecast(g), "ds", 52, tuple(KEYS))


def features(g):
    return marts.municipality_features(g.fact, g.municipio, g.uf)


SQL_SCALED = (
    "SELECT cod_municipio, "
    + ", ".join(
        f"""(coalesce(CAST({c} AS DOUBLE), 0) - avg(coalesce(CAST({c} AS DOUBLE), 0)) OVER ())
        / coalesce(nullif(stddev_pop(coalesce(CAST({c} AS DOUBLE), 0)) OVER (), 0), 1) AS {c}_z"""
        for c in FEATURES
    )
    + f" FROM ({SQL_FEATURES})"
)


@query(
    with_fact(
        "SELECT cod_municipio, " + ", ".join(f"{sql_rounded(f'{c}_z')} AS {c}_z" for c in FEATURES) + f" FROM ({SQL_SCALED})"
    )
)
def standardize(g):
    scaled = [f"{c}_z" for c in FEATURES]
    return rounded(clustering.standardize(features(g)), *scaled).select("cod_municipio", *scaled)


# Labels given by the municipality code, so that both engines score the same clusters.
GIVEN_K = range(2, 9)


def given_scores(g):
    scaled = clustering.standardize(features(g))
    labelled = scaled.withColumns({f"grupo_{k}": F.col("cod_municipio") % k for k in GIVEN_K})
    return clustering.silhouette_scores(labelled, [f"{c}_z" for c in FEATURES], {k: f"grupo_{k}" for k in GIVEN_K})


SQL_GAP = " + ".join(f"power(p.{c}_z - q.{c}_z, 2)" for c in FEATURES)
SQL_SCORES = f"""SELECT k, avg(CASE WHEN n_proprio <= 1 THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END) AS silhouette
  FROM (SELECT k, ponto, max(CASE WHEN g = meu THEN n END) AS n_proprio,
      max(CASE WHEN g = meu THEN total / nullif(n - 1, 0) END) AS a, min(CASE WHEN g <> meu THEN total / n END) AS b
    FROM (SELECT k, p.cod_municipio AS ponto, p.cod_municipio % k AS meu, q.cod_municipio % k AS g, sum(p.gap) AS total, count(*) AS n
      FROM (SELECT p.cod_municipio, q.cod_municipio AS outro, {SQL_GAP} AS gap FROM escala p, escala q) p
      JOIN escala q ON q.cod_municipio = p.outro, range({min(GIVEN_K)}, {max(GIVEN_K) + 1}) ks(k)
      GROUP BY k, p.cod_municipio, q.cod_municipio % k)
    GROUP BY k, ponto) GROUP BY k"""


@query(
    with_fact(
        f", escala AS ({SQL_SCALED}) SELECT CAST(k AS INT) AS k, {sql_rounded('silhouette')} AS silhouette FROM ({SQL_SCORES})"
    )
)
def silhouette_scores(g):
    return rounded(given_scores(g), "silhouette")


@query(
    with_fact(
        f""", escala AS ({SQL_SCALED}) SELECT CAST(k AS INT) AS k, {sql_rounded('silhouette')} AS silhouette
        FROM ({SQL_SCORES}) ORDER BY silhouette DESC, k LIMIT 1"""
    )
)
def best_k(g):
    return clustering.best_k(rounded(given_scores(g), "silhouette")).select("k", "silhouette")


# Several k-means models started at given municipalities, whose steps the checking engine repeats.
STARTS = {(k, first): [first + 17 * j for j in range(k)] for k in (2, 3, 5) for first in (1, 6)}
STEPS = 4


def sql_steps() -> str:
    """Centres and nearest centres of every model, round by round; the labels at the end are ``passos``."""
    width = range(len(FEATURES))
    names = [f"x{i}" for i in width]
    starts = ", ".join(f"({k}, {first}, {j}, {place})" for (k, first), places in STARTS.items() for j, place in enumerate(places))
    gap = " + ".join(f"power(p.{x} - c.{x}, 2)" for x in names)
    parts = [
        f"escala AS ({SQL_SCALED})",
        "pontos AS (SELECT cod_municipio, row_number() OVER (ORDER BY cod_municipio) AS lugar, "
        + ", ".join(f"{c}_z AS {x}" for c, x in zip(FEATURES, names)) + " FROM escala)",
        f"partidas(k, inicio, centro, lugar) AS (VALUES {starts})",
        f"c0 AS (SELECT k, inicio, centro, {', '.join(names)} FROM partidas JOIN pontos USING (lugar))",
    ]
    for step in range(STEPS + 1):
        parts.append(
            f"""p{step} AS (SELECT cod_municipio, k, inicio, centro, gap, {", ".join(names)} FROM (
            SELECT p.*, c.k, c.inicio, c.centro, {gap} AS gap,
              row_number() OVER (PARTITION BY cod_municipio, k, inicio ORDER BY {gap}, c.centro) AS ordem
            FROM pontos p, c{step} c) WHERE ordem = 1)"""
        )
        means = ", ".join(f"coalesce(m.{x}, c.{x}) AS {x}" for x in names)
        parts.append(
            f"""c{step + 1} AS (SELECT c.k, c.inicio, c.centro, {means} FROM c{step} c LEFT JOIN (
            SELECT k, inicio, centro, {", ".join(f"avg({x}) AS {x}" for x in names)} FROM p{step} GROUP BY k, inicio, centro) m
            USING (k, inicio, centro))"""
        )
    costs = f"(SELECT k, inicio, {sql_rounded('sum(gap)', 4)} AS custo FROM p{STEPS - 1} GROUP BY k, inicio)"
    parts.append(
        f"""passos AS (SELECT CAST(k AS INT) AS k, CAST(inicio AS INT) AS inicio, cod_municipio, CAST(centro AS INT) AS grupo, custo
        FROM p{STEPS} JOIN {costs} USING (k, inicio))"""
    )
    return ", " + ", ".join(parts)


SQL_STEPS = sql_steps()


def stepped(g):
    """The scaled municipalities after four rounds of all models together, one row per model, and its cost."""
    scaled = written(clustering.standardize(features(g)), "scaled")
    columns = [f"{c}_z" for c in FEATURES]
    ordered = scaled.orderBy("cod_municipio").limit(max(map(max, STARTS.values()))).select(columns).collect()  # the starts
    # A small table may lack some of the starts.
    models = {tried: np.array(ordered, dtype=float)[[p - 1 for p in places if p <= len(ordered)]] for tried, places in STARTS.items() if places[0] <= len(ordered)}
    if not models:
        return scaled.limit(0).selectExpr("*", "0 AS k", "0 AS inicio", "0 AS grupo", "0D AS custo")
    fits = clustering.lloyd(clustering.coordinates(scaled, columns), list(models.values()), STEPS, tol=-1.0)
    labelled = [
        F.struct(
            F.lit(k).alias("k"), F.lit(first).alias("inicio"), clustering.nearest_centre(columns, centres).alias("grupo"),
            F.lit(cost).alias("custo"),
        )
        for (k, first), centres, cost in zip(models, fits.centres, fits.costs)
    ]
    return scaled.select("*", F.explode(F.array(*labelled)).alias("m")).select("*", "m.*").drop("m")


@query(with_fact(f"{SQL_STEPS} SELECT * FROM passos"))
def kmeans_steps(g):
    return rounded(stepped(g).select("k", "inicio", "cod_municipio", "grupo", "custo"), "custo", digits=4)


SQL_STEP_GAPS = f"""SELECT p.k, a.cod_municipio AS ponto, p.grupo AS meu, q.grupo AS g, sum({SQL_GAP.replace("p.", "a.").replace("q.", "b.")}) AS total,
      count(*) AS n
    FROM passos p JOIN passos q ON q.k = p.k AND q.inicio = p.inicio JOIN escala a ON a.cod_municipio = p.cod_municipio
      JOIN escala b ON b.cod_municipio = q.cod_municipio WHERE p.inicio = 1 GROUP BY p.k, a.cod_municipio, p.grupo, q.grupo"""


@query(
    with_fact(
        f"""{SQL_STEPS} SELECT k, {sql_rounded('avg(CASE WHEN n_proprio <= 1 THEN 0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0) END)')} AS silhouette
        FROM (SELECT k, ponto, max(CASE WHEN g = meu THEN n END) AS n_proprio, max(CASE WHEN g = meu THEN total / nullif(n - 1, 0) END) AS a,
          min(CASE WHEN g <> meu THEN total / n END) AS b FROM ({SQL_STEP_GAPS}) GROUP BY k, ponto) GROUP BY k"""
    )
)
def steps_silhouette(g):
    """Silhouettes of the models that start at the first municipality."""
    chosen = stepped(g).where("inicio = 1")
    labels = {k: F.max(F.when(F.col("k") == k, F.col("grupo"))).alias(f"cluster_{k}") for k, first in STARTS if first == 1}
    labelled = chosen.groupBy("cod_municipio", *[f"{c}_z" for c in FEATURES]).agg(*labels.values())
    names = {k: f"cluster_{k}" for k in labels}
    return rounded(clustering.silhouette_scores(labelled, [f"{c}_z" for c in FEATURES], names), "silhouette")


@query(
    with_fact(
        f"""{SQL_STEPS}, perfis AS (
          SELECT grupo AS cluster, {", ".join(f"round(avg(coalesce(CAST({c} AS DOUBLE), 0)), 1) AS {c}" for c in FEATURES)}
          FROM passos JOIN ({SQL_FEATURES}) USING (cod_municipio) WHERE k = 3 AND inicio = 1 GROUP BY grupo)
        SELECT cluster, {", ".join(f"{sql_rounded(c)} AS {c}" for c in FEATURES)},
          {", ".join(sql_rounded(f"({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1)") + f" AS {c}_z" for c in FEATURES)}
        FROM perfis"""
    )
)
def steps_heatmap(g):
    """Mean profiles of three clusters and their z-scores across clusters."""
    members = stepped(g).where("k = 3 AND inicio = 1").withColumn("cluster", F.col("grupo"))
    heat = clustering.centroid_heatmap(clustering.centroids(members))
    return rounded(heat, *FEATURES, *[f"{c}_z" for c in FEATURES])


@query(with_fact(f"SELECT CAST(k AS INT) AS k, true AS fixo, count(*) AS n FROM ({SQL_FEATURES}), range(2, 9) ks(k) GROUP BY k"))
def kmeans_fixpoint(g):
    """For each k, whether every municipality is with the nearest of its labelling's own means."""
    columns = [f"{c}_z" for c in FEATURES]
    labelled = written(clustering.label_by_k(features(g)), "labelled")
    listed = F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"cluster_{k}").alias("grupo")) for k in GIVEN_K])
    rows = labelled.select("cod_municipio", *columns, F.explode(listed).alias("m")).select("*", "m.*").drop("m")
    means = rows.groupBy("k", "grupo").agg(*[F.avg(c).alias(f"m_{c}") for c in columns])
    gap = sum(((F.col(c) - F.col(f"m_{c}")) ** 2 for c in columns), F.lit(0.0))
    gaps = rows.join(means.withColumnRenamed("grupo", "outro"), "k").withColumn("gap", gap)
    nearest = gaps.groupBy("k", "cod_municipio", "grupo").agg(
        F.min("gap").alias("menor"), F.min(F.when(F.col("outro") == F.col("grupo"), F.col("gap"))).alias("propria")
    )
    fixed = F.col("propria") <= F.col("menor") + 1e-6
    return nearest.groupBy("k").agg(F.bool_and(fixed).alias("fixo"), F.count(F.lit(1)).alias("n"))


def clusters_of(g):
    """The clusters of the best k out of 2 to 8, ten restarts each; None for too few municipalities."""
    return clustering.kmeans_municipalities(features(g))


@query()
def kmeans_municipalities(g):
    clusters = clusters_of(g)
    if clusters is None:
        return features(g).withColumn("cluster", F.lit(None).cast("int"))
    return clusters.members


@query()
def silhouette_by_k(g):
    clusters = clusters_of(g)
    if clusters is None:
        return g.spark.createDataFrame([], "k int, silhouette double")
    return clusters.scores


@query()
def centroid_heatmap(g):
    clusters = clusters_of(g)
    if clusters is None:
        return clustering.centroid_heatmap(features(g).limit(0).withColumn("cluster", F.lit(None).cast("int")))
    return clustering.centroid_heatmap(clusters.centroids)
