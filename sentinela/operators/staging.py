"""Staging text to typed fact rows, with every refused row kept and explained."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentinela.functions import cleaning as clean
from sentinela.functions.ages import age_band, decode_age
from sentinela.functions.text import content_hash
from sentinela.schemas import FACT_COLUMNS, FactColumn
from sentinela.session import written

CLEANERS = {
    "text": lambda text: text,
    "int": clean.guard_int,
    "long": lambda text: clean.guard_int(text, "bigint"),
    "date": clean.guard_date,
    "file_year": clean.file_year,
    "municipality": clean.canon_municipality,
    "sex": clean.clean_sex,
    "birth_year": clean.clean_birth_year,
    "digits_text": clean.clean_occupation,
}

LARGEST = {"int": 2**31 - 1, "long": 2**63 - 1}

# A number that equal fact rows share, stored in place of their long content hash.
ROW_KEY = "chave_linha"


class Split(NamedTuple):
    accepted: DataFrame
    rejected: DataFrame


def typed(column: FactColumn) -> Column:
    return CLEANERS[column.kind](F.col(column.source))


def refusal(column: FactColumn, text: Column, value: Column) -> Column:
    """Reason why this column's ``text``, typed as ``value``, keeps the row out of the fact, or NULL.

    Text that looks right but does not fit is an error, unlike text of another shape, which merely
    becomes NULL. Lengths are compared first: they settle almost every row without a pattern match.
    """
    reason = F.lit(None).cast("string")
    if column.kind in LARGEST:
        largest = column.limit or LARGEST[column.kind]
        # Digits beyond the column's type have no value.
        fits = F.coalesce(value <= largest, F.lit(False))
        over = (F.length(text) >= len(str(largest))) & clean.is_digits(text) & ~fits
        reason = F.when(over, F.lit(f"{column.source}:limit"))
    elif column.kind == "date":
        impossible = value.isNull() & clean.is_iso_date(text)
        reason = F.when(impossible, F.lit(f"{column.source}:value"))
    elif column.limit is not None:
        reason = F.when(F.length(value) > column.limit, F.lit(f"{column.source}:limit"))
    if column.required:
        reason = F.coalesce(reason, F.when(value.isNull(), F.lit(f"{column.source}:missing")))
    return reason


def refusals(staging: DataFrame) -> list[Column]:
    """Reasons of the columns, or the one that a malformed line has."""
    reasons = [refusal(column, F.col(column.source), typed(column)) for column in refusing_columns()]
    if "linha_malformada" not in staging.columns:
        return reasons
    broken = F.col("linha_malformada").isNotNull()
    return [F.when(broken, F.lit("row:malformed")), *[F.when(~broken, reason) for reason in reasons]]


def refusing_columns() -> list[FactColumn]:
    return [column for column in FACT_COLUMNS if column.kind in (*LARGEST, "date") or column.limit or column.required]


def with_age(rows: DataFrame) -> DataFrame:
    """Add the decoded age, the age as stored (rounded again to two decimals) and the age band.

    The band uses the three-decimal age. It refers to the decoded column rather than repeating
    the decoding in each of its branches, which would outgrow one compiled method.
    """
    age = F.col("idade_decodificada")
    decoded = rows.withColumn("idade_decodificada", decode_age(F.col("nu_idade_codificada")))
    return decoded.withColumns({"idade_anos": age.cast("decimal(5,2)"), "faixa_etaria": age_band(age)})


def clean_staging(staging: DataFrame) -> DataFrame:
    """Typed columns and ages of every staging row, whether the fact accepts it or not."""
    typed_columns = [typed(column).alias(column.name) for column in FACT_COLUMNS]
    return with_age(staging.select("linha_id", *typed_columns))


def split_staging(staging: DataFrame) -> Split:
    """Fact rows, and refused staging rows with their reasons."""
    reasons = refusals(staging)
    accepted = clean_staging(staging.where(F.coalesce(*reasons).isNull()))
    rejected = staging.where(F.coalesce(*reasons).isNotNull()).withColumn(
        "motivos", F.filter(F.array(*reasons), lambda reason: reason.isNotNull())
    )
    return Split(accepted, rejected)


def judged_staging(staging: DataFrame, hashed: bool = True) -> DataFrame:
    """Every staging row judged and typed in one pass, to be stored and split by ``split_judged``.

    ``motivos`` holds the reasons of a refused row and ``linha_bruta`` its text fields; both are NULL
    for a row that the fact accepts. The text is one array, since a struct would store as many
    columns again, NULL in nearly every row. ``staging`` has text columns besides its line id.
    Unless ``hashed``, rows have a short ``ROW_KEY`` and get their content hash when they are published.
    """
    texts = [name for name in staging.columns if name != "linha_id"]
    raw = {name: F.col(f"_{name}") for name in texts}
    values = [F.col(column.name) for column in FACT_COLUMNS]
    # Typed once, next to the text; the reasons look at the values instead of parsing again.
    rows = staging.select(
        "linha_id",
        *[F.col(name).alias(f"_{name}") for name in texts],
        *[typed(column).alias(column.name) for column in FACT_COLUMNS],
    )
    # No reason holds a comma. Joined text stays within compiled code, unlike a filter by a lambda.
    found = F.concat_ws(",", *[refusal(column, raw[column.source], F.col(column.name)) for column in refusing_columns()])
    if "linha_malformada" in raw:
        found = F.when(raw["linha_malformada"].isNotNull(), F.lit("row:malformed")).otherwise(found)
    refused = F.col("_motivos") != ""
    judged = rows.withColumn("_motivos", found).select(
        "linha_id",
        F.when(refused, F.split("_motivos", ",")).alias("motivos"),
        F.when(refused, F.array(*raw.values())).alias("linha_bruta"),
        *values,
    )
    judged = row_defaults(with_age(judged))
    return judged if hashed else judged.drop("hash_linha").withColumn(ROW_KEY, F.xxhash64(*values))


def split_judged(judged: DataFrame, columns: list[str]) -> Split:
    """Fact rows with their load defaults, and refused rows with the staging ``columns`` and their reasons."""
    accepted = judged.where("motivos IS NULL").drop("motivos", "linha_bruta")
    texts = [name for name in columns if name != "linha_id"]
    fields = {name: F.get("linha_bruta", F.lit(place)).alias(name) for place, name in enumerate(texts)}
    raw = [fields.get(name, F.col(name)) for name in columns]
    return Split(accepted, judged.where("motivos IS NOT NULL").select(*raw, "motivos"))


def row_defaults(rows: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Load time, loading user and a content hash over the row's fact columns."""
    return rows.withColumns(
        {
            "carregado_em": F.current_timestamp() if loaded_at is None else loaded_at,
            "usuario_db": F.current_user(),
            "hash_linha": row_hash(rows),
        }
    )


def row_hash(rows: DataFrame) -> Column:
    """Content hash over the row's fact columns."""
    return content_hash(rows, [column.name for column in FACT_COLUMNS if column.name in rows.columns])


def content_occurrence(
    rows: DataFrame, columns: list[str], order: str = "linha_id", bucket_rows: int = 1 << 20
) -> DataFrame:
    """Number equal rows 1, 2, … in the order of the unique integer column ``order``.

    Copies of one row may be a third of the table, so they are numbered in buckets of ``order``
    that hold at most ``bucket_rows`` rows each; what earlier buckets of the same content hold is
    counted beforehand and added.
    """
    bucket = F.call_function("div", F.col(order), F.lit(bucket_rows))
    keyed = rows.withColumns({"hash_conteudo": content_hash(rows, columns), "_bucket": bucket})
    earlier = Window.partitionBy("hash_conteudo").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy("hash_conteudo", "_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("hash_conteudo", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    within = F.row_number().over(Window.partitionBy("hash_conteudo", "_bucket").orderBy(order))
    return (
        keyed.withColumn("_within", within)
        .join(offsets, ["hash_conteudo", "_bucket"])
        .withColumn("ocorrencia", F.col("_before") + F.col("_within"))
        .drop("_bucket", "_within", "_before")
    )


def stable_ids(rows: DataFrame, content: str = "hash_linha", order: str = "linha_id") -> DataFrame:
    """Add ``id_notif``, made from a row's content hash and its number among equal rows.

    A reload gives every row the id it had, whatever files come before it; of n equal rows the ids
    of 1 to n are taken. Rows that share a number made from their content, few more than those that
    do repeat, are stored with their hash and numbered by it, in narrow tables: their sizes are known
    when the rows are joined with them, so that Spark need not shuffle the rows for a few copies.
    ``rows`` should be stored as well, since they are read three times. Rows with a ``ROW_KEY``
    instead of the hash get it here.
    """
    def hashed(some: DataFrame) -> DataFrame:
        return some.drop(ROW_KEY).withColumn(content, row_hash(some)) if ROW_KEY in some.columns else some

    key = F.col(ROW_KEY) if ROW_KEY in rows.columns else F.xxhash64(content)
    shared = rows.groupBy(key.alias("_chave")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    shared = written(shared.select("_chave"), "chaves")
    copies = written(hashed(rows.join(shared, key == F.col("_chave"), "left_semi")).select(order, content), "iguais")
    numbered = written(content_occurrence(copies, [content], order).select(order, "ocorrencia"), "copias")
    number = F.coalesce(F.col("ocorrencia"), F.lit(1)).cast("string")
    digest = F.substring(F.md5(F.concat_ws("|", content, number)), 1, 15)
    joined = hashed(rows.join(numbered, order, "left"))
    return joined.withColumn("id_notif", F.conv(digest, 16, 10).cast("bigint")).drop("ocorrencia")


def lineage_staging_to_fact(staging: DataFrame, fact: DataFrame) -> DataFrame:
    """Fact id made from each staging line, NULL for refused lines."""
    made = fact.select("linha_id", F.col("id_notif").alias("id_notif_gerado"))
    return staging.select("linha_id").join(made, "linha_id", "left")
