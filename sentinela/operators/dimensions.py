"""Dimensions derived from staging codes, and insert-if-absent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentinela.functions.cleaning import canon_municipality, guard_int, label_code, municipality_state
from sentinela.functions.text import similarity, trigrams

MUNICIPALITY_SOURCES = ("id_municip", "id_mn_resi", "comuninf")


def insert_if_absent(table: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``table`` plus the new rows whose keys it lacks, one row per new key.

    Of new rows that disagree in the other columns, the smallest counts, whatever their order.
    """
    others = [name for name in table.columns if name not in keys]
    absent = new.join(table, keys, "left_anti")
    if others:
        absent = absent.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_row")).select(*keys, "_row.*")
    return table.unionByName(absent.select(*table.columns).distinct())


def municipality_codes(staging: DataFrame, sources: tuple[str, ...] = MUNICIPALITY_SOURCES) -> DataFrame:
    """Distinct municipality keys of the six- and seven-digit codes in any source column.

    One pass: the columns of a row become an array, and duplicates go before the shuffle.
    """
    codes = F.array_distinct(
        F.array(*[F.when(F.col(c).rlike(r"^[0-9]{6,7}\z"), canon_municipality(F.col(c))) for c in sources])
    )
    exploded = staging.select(F.explode(codes).alias("cod_municipio"))
    return exploded.where(F.col("cod_municipio").isNotNull()).distinct()


def semi_known_state(codes: DataFrame, dim_uf: DataFrame) -> DataFrame:
    """Codes whose leading digits name a known state."""
    with_state = codes.withColumn("cod_uf", municipality_state(F.col("cod_municipio")))
    return with_state.join(dim_uf, "cod_uf", "left_semi")


def distinct_municipalities(staging: DataFrame, dim_uf: DataFrame) -> DataFrame:
    """Municipality dimension ``(cod_municipio, nome, cod_uf)`` of the codes seen."""
    known = semi_known_state(municipality_codes(staging), dim_uf)
    return known.select("cod_municipio", label_code("MUN", F.col("cod_municipio")).alias("nome"), "cod_uf")


def distinct_health_units(staging: DataFrame) -> DataFrame:
    """Health-unit dimension ``(cod_cnes, nome)`` of the numeric codes seen.

    The name keeps the code as written; of several spellings with leading zeros, the first in
    text order.
    """
    coded = staging.withColumn("cod_cnes", guard_int(F.col("id_unidade"), "bigint"))
    units = coded.where(F.col("cod_cnes").isNotNull()).groupBy("cod_cnes").agg(F.min("id_unidade").alias("_code"))
    return units.select("cod_cnes", label_code("CNES", F.col("_code")).alias("nome"))


def name_lookup(dim: DataFrame, name: str, wanted: str, least: float = 0.3) -> DataFrame:
    """Rows whose name resembles ``wanted``, ignoring case and accents."""
    score = similarity(F.col(name), F.lit(wanted))
    return dim.withColumn("semelhanca", score).where(F.col("semelhanca") >= least)


def trigram_index(names: DataFrame, name: str) -> DataFrame:
    """Distinct values of ``name`` with their sorted trigrams, to be stored beside a dimension."""
    distinct = names.where(F.col(name).isNotNull()).select(F.col(name).alias("nome")).distinct()
    return distinct.select("nome", F.array_sort(trigrams(F.col("nome"))).alias("trigramas")).where(F.size("trigramas") > 0)


def _prefixes(index: DataFrame, ranks: DataFrame, least: float) -> DataFrame:
    """The rarest trigrams of each name, so many that any name as similar as ``least`` shares one of them."""
    size = F.size("trigramas")
    exploded = index.select("nome", size.alias("tamanho"), F.explode("trigramas").alias("trigrama")).join(ranks, "trigrama")
    # One name's trigrams at a time; their number is bounded by its length.
    rarest = Window.partitionBy("nome").orderBy("frequencia", "trigrama")
    placed = exploded.withColumn("lugar", F.row_number().over(rarest))
    # A tiny margin keeps rounding from shortening a prefix.
    return placed.where(F.col("lugar") <= F.col("tamanho") - F.ceil(least * F.col("tamanho") - 1e-9) + 1)


def name_candidates(wanted: DataFrame, index: DataFrame, least: float) -> DataFrame:
    """Pairs of names that pass the prefix, length and position filters: ``procurado``, ``nome``.

    Both sides are trigram indexes. Trigrams are ordered from rare to frequent over both together.
    """
    both = wanted.select(F.explode("trigramas").alias("trigrama")).unionAll(index.select(F.explode("trigramas")))
    ranks = both.groupBy("trigrama").agg(F.count(F.lit(1)).alias("frequencia"))
    left = _prefixes(wanted, ranks, least).select(
        "trigrama", F.col("nome").alias("procurado"), F.col("tamanho").alias("_a"), F.col("lugar").alias("_i")
    )
    right = _prefixes(index, ranks, least).select("trigrama", "nome", F.col("tamanho").alias("_b"), F.col("lugar").alias("_j"))
    alike = F.least("_a", "_b") >= least * F.greatest("_a", "_b") - 1e-9
    # With this trigram in common at places i and j, no more than the rest of the shorter side can follow.
    needed = least / (1 + least) * (F.col("_a") + F.col("_b")) - 1e-9
    possible = F.least("_i", "_j") + F.least(F.col("_a") - F.col("_i"), F.col("_b") - F.col("_j"))
    return left.join(right, "trigrama").where(alike & (possible >= needed)).select("procurado", "nome").distinct()


def name_matches(wanted: DataFrame, dim: DataFrame, name: str, least: float = 0.3, index: DataFrame | None = None) -> DataFrame:
    """Rows of ``dim`` whose name resembles one of the names in ``wanted``, which has the column ``procurado``.

    The same similarity as ``name_lookup``, for many names at once: candidate pairs come from an
    inverted index over the rarest trigrams and only those are compared in full. ``index`` is the
    dimension's stored ``trigram_index``; it is made here if it is not given. Missing names and
    names without letters or digits match nothing; ``least`` is above 0.
    """
    if not 0 < least <= 1:
        raise ValueError("the least similarity lies between 0 and 1")
    asked = trigram_index(wanted, "procurado")
    index = trigram_index(dim, name) if index is None else index
    pairs = name_candidates(asked, index, least)
    sets = pairs.join(asked.select(F.col("nome").alias("procurado"), F.col("trigramas").alias("_a")), "procurado")
    sets = sets.join(index.select("nome", F.col("trigramas").alias("_b")), "nome")
    score: Column = F.size(F.array_intersect("_a", "_b")) / F.size(F.array_union("_a", "_b"))
    found = sets.select("procurado", F.col("nome").alias("_nome"), score.alias("semelhanca")).where(F.col("semelhanca") >= least)
    return found.join(dim, found["_nome"] == dim[name]).drop("_nome")
