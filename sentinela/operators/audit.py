"""Change log between two states of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentinela.functions.text import content_hash, field_diff, row_json
from sentinela.session import written

LOG_COLUMNS = ["tabela", "operacao", "pk_alvo", "dados_antes", "dados_depois", "diff"]


def snapshot_join(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Pair the rows of two snapshots: the keys, and each side's whole row as a struct.

    Keys must be unique and not NULL on both sides. Snapshots saved by ``warehouse.save_bucketed``
    with the same keys and buckets join without a shuffle.
    """
    columns = before.columns
    left = before.select(*keys, F.struct(*columns).alias("antes"))
    right = after.select(*keys, F.struct(*columns).alias("depois"))
    return left.join(right, keys, "full_outer")


def log_rows(paired: DataFrame, columns: list[str], keys: list[str], table: str) -> DataFrame:
    """Log entries of paired rows ``antes`` and ``depois``; equal pairs leave no entry."""
    before, after = F.col("antes"), F.col("depois")
    operation = F.when(before.isNull(), "I").when(after.isNull(), "D").otherwise("U")

    def snapshot(side: str) -> Column:
        fields = [F.col(f"{side}.{name}").alias(name) for name in columns]
        return F.when(F.col(side).isNotNull(), row_json(*fields))

    key_text = F.concat_ws("|", *[F.col(key).cast("string") for key in keys])
    changed = paired.where(~before.eqNullSafe(after))
    return changed.select(
        F.lit(table).alias("tabela"),
        operation.alias("operacao"),
        key_text.alias("pk_alvo"),
        snapshot("antes").alias("dados_antes"),
        snapshot("depois").alias("dados_depois"),
        F.when(operation == "U", field_diff("antes", "depois", columns)).alias("diff"),
    )


def audit_diff(before: DataFrame, after: DataFrame, keys: list[str], table: str) -> DataFrame:
    """Inserted (I), deleted (D) and updated (U) rows between two snapshots.

    Updates carry the changed fields as ``name -> (de, para)``; unchanged rows are not logged.
    """
    return log_rows(snapshot_join(before, after, keys), before.columns, keys, table)


ROW_HASH = "hash_auditoria"


def with_row_hash(rows: DataFrame, name: str = ROW_HASH) -> DataFrame:
    """Add the hash of a row's content, to be stored with a snapshot."""
    return rows.withColumn(name, content_hash(rows, rows.columns))


def changed_keys(before: DataFrame, after: DataFrame, keys: list[str], name: str = ROW_HASH) -> DataFrame:
    """Keys whose row was added, removed or has another hash; reads the keys and the hash alone."""
    old = before.select(*keys, F.col(name).alias("_antes"))
    new = after.select(*keys, F.col(name).alias("_depois"))
    return old.join(new, keys, "full_outer").where("NOT (_antes <=> _depois)").select(*keys)


def audit_diff_wide(before: DataFrame, after: DataFrame, keys: list[str], table: str, name: str = ROW_HASH) -> DataFrame:
    """``audit_diff`` of wide snapshots that hold their rows' hashes (``with_row_hash``).

    Keys and hashes meet first; the wide rows of the changed keys alone are fetched and compared.
    Of unchanged rows two columns are read, and nothing but those is shuffled.
    """
    columns = [column for column in before.columns if column != name]
    changed = written(changed_keys(before, after, keys, name), "changed")
    sides = [rows.join(changed, keys, "left_semi").select(*columns) for rows in (before, after)]
    return audit_diff(*sides, keys, table)


def audit_log(entries: DataFrame) -> DataFrame:
    """Log entries with user and time, as they are appended to the log."""
    return entries.withColumns({"usuario_db": F.current_user(), "momento": F.current_timestamp()})


def audit_ref_backfill(log: DataFrame, fact: DataFrame, table: str = "fato_notificacao") -> DataFrame:
    """Add the fact id a log entry refers to, NULL for other tables and for ids no longer there."""
    numeric = (F.col("tabela") == table) & F.col("pk_alvo").rlike(r"^[0-9]+\z")
    wanted = log.withColumn("_ref", F.when(numeric, F.col("pk_alvo").try_cast("bigint")))
    alive = fact.select(F.col("id_notif").alias("id_notif_ref"))
    found = wanted.where(F.col("_ref").isNotNull()).join(alive, F.col("_ref") == F.col("id_notif_ref"), "left")
    # Entries without a reference skip the join, where they would all meet in one partition.
    none = wanted.where(F.col("_ref").isNull()).withColumn("id_notif_ref", F.lit(None).cast("bigint"))
    return found.unionByName(none).drop("_ref")
