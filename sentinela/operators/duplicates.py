"""Forms that may describe the same case twice: same place, sex, rounded age and nearby dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentinela.functions.dates import date_bucket
from sentinela.functions.text import group_hash

# Stand-ins for a missing age and date bucket, so that groups can be joined by plain equality.
NO_AGE = -1
NO_BUCKET = "0001-01-01"

GROUP = ["cod_mun_resi", "cod_sexo", "_idade", "_bucket"]


def _candidates(fact: DataFrame, drop_null_age: bool) -> DataFrame:
    rows = fact.where(
        F.col("dt_sintomas").isNotNull() & F.col("cod_mun_resi").isNotNull() & F.col("cod_sexo").isNotNull()
    )
    if drop_null_age:
        rows = rows.where(F.col("idade_anos").isNotNull())
    return rows.select(
        "id_notif",
        "cod_mun_resi",
        "cod_sexo",
        F.coalesce(F.round("idade_anos", 0).cast("int"), F.lit(NO_AGE)).alias("_idade"),
        "dt_sintomas",
    )


def _bucketed(rows: DataFrame, window_days: int) -> DataFrame:
    """Fixed buckets; rows without an age share one bucket over all dates."""
    bucket = F.when(F.col("_idade") != NO_AGE, date_bucket(F.col("dt_sintomas"), window_days))
    return rows.withColumn("_bucket", F.coalesce(bucket, F.lit(NO_BUCKET).cast("date")))


def duplicate_window(rows: DataFrame, keys: list[str], day: str, gap_days: int) -> DataFrame:
    """Runs of dates at most ``gap_days`` apart, per key: ``keys, day, inicio_grupo``.

    Works on distinct dates, so a key's window holds one row per calendar day however many rows
    the key has.
    """
    days = rows.groupBy(*keys, day).agg(F.count(F.lit(1)).alias("n_linhas"))
    ordered = Window.partitionBy(*keys).orderBy(day)
    previous = F.lag(day).over(ordered)
    starts = F.when(previous.isNull() | (F.datediff(day, previous) > gap_days), F.col(day))
    return days.withColumn("inicio_grupo", starts).withColumn(
        "inicio_grupo", F.last("inicio_grupo", ignorenulls=True).over(ordered)
    )


def _windowed(rows: DataFrame, window_days: int) -> DataFrame:
    keys = ["cod_mun_resi", "cod_sexo", "_idade"]
    runs = duplicate_window(rows, keys, "dt_sintomas", window_days).drop("n_linhas")
    return rows.join(runs, [*keys, "dt_sintomas"]).withColumnRenamed("inicio_grupo", "_bucket")


def _in_groups(fact: DataFrame, window_days: int, mode: str, drop_null_age: bool) -> DataFrame:
    if mode not in ("bucket", "window"):
        raise ValueError(f"unknown duplicate mode: {mode}")
    rows = _candidates(fact, drop_null_age)
    return _bucketed(rows, window_days) if mode == "bucket" else _windowed(rows, window_days)


def _groups(rows: DataFrame) -> DataFrame:
    """Groups of two or more, counted with map-side combine."""
    return (
        rows.groupBy(*GROUP)
        .agg(
            F.count(F.lit(1)).alias("n_ocorrencias"),
            F.min("dt_sintomas").alias("dt_sintomas_min"),
            F.max("dt_sintomas").alias("dt_sintomas_max"),
        )
        .where(F.col("n_ocorrencias") > 1)
    )


def _named(groups: DataFrame, *more: str) -> DataFrame:
    """Public columns of a group, and further ones."""
    age = F.nullif(F.col("_idade"), F.lit(NO_AGE))
    bucket = F.nullif(F.col("_bucket"), F.lit(NO_BUCKET).cast("date"))
    return groups.select(
        group_hash(F.col("cod_mun_resi"), F.col("cod_sexo"), age, bucket).alias("grupo_hash"),
        "n_ocorrencias",
        "cod_mun_resi",
        "cod_sexo",
        age.cast("decimal(6,2)").alias("idade_anos"),
        "dt_sintomas_min",
        "dt_sintomas_max",
        *more,
    )


def duplicate_members(
    fact: DataFrame, window_days: int = 3, mode: str = "bucket", drop_null_age: bool = False
) -> DataFrame:
    """Every form of every group of two or more, one row per form, with the columns of its group.

    Group sizes are joined back rather than counted by a window that would bring a whole group into
    one task. The join uses one text key instead of the grouping columns: Spark then shuffles both
    sides for the join, and adaptive execution may split a hot group, which it cannot do next to an
    aggregate that keeps its own partitioning.
    """
    rows = _in_groups(fact, window_days, mode, drop_null_age)
    key = F.concat_ws("|", *GROUP).alias("_grupo")
    sizes = _groups(rows).select(key, "n_ocorrencias", "dt_sintomas_min", "dt_sintomas_max")
    return _named(rows.select("id_notif", *GROUP, key).join(sizes, "_grupo"), "id_notif")


def detect_duplicates(
    fact: DataFrame, window_days: int = 3, mode: str = "bucket", drop_null_age: bool = False
) -> DataFrame:
    """Groups of two or more similar forms, one row each; ``duplicate_members`` names their forms."""
    return _named(_groups(_in_groups(fact, window_days, mode, drop_null_age)))
