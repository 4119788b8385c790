"""Staging, fact and mart tables as Parquet.

A published table is a folder of complete versions and a short list of the ones that went live.
A load writes a new version first and lists it last, so readers see the old table or the new one,
and a load that dies leaves nothing visible.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentinela.operators.integrity import duplicate_keys
from sentinela.operators.staging import row_defaults, stable_ids
from sentinela.session import wide_rows, written
from sentinela.sources.csvfiles import read_raw

LIVE = "publicadas"


def rebalanced(rows: DataFrame, column: str) -> DataFrame:
    """Rows grouped by a partition column before a write.

    Adaptive execution splits a hot value over several files and merges small ones.
    """
    return rows.hint("rebalance", F.col(column))


def publish(rows: DataFrame, root: str, partition_by: str | None = None, unique: list[str] | None = None) -> DataFrame:
    """Write ``rows`` as the next version of the table at ``root`` and return it.

    ``unique`` names key columns that must not repeat; the check reads the written version and
    fails before it goes live.
    """
    spark = rows.sparkSession
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    target = f"{root}/v-{version}"
    # A dictionary of hashes would only be built and thrown away.
    plain = rows.write.option("parquet.enable.dictionary#hash_linha", "false")
    writer = plain.partitionBy(partition_by) if partition_by else plain
    with wide_rows(spark):
        writer.parquet(target)
    schema = rows.schema
    written = spark.read.schema(schema).parquet(target)
    if unique and not duplicate_keys(written, unique).isEmpty():
        raise ValueError(f"keys {unique} repeat in {target}; the table was left as it was")
    entry = spark.range(1).select(F.lit(version).alias("versao"), F.lit(schema.json()).alias("esquema"))
    entry.coalesce(1).write.mode("append").json(f"{root}/{LIVE}")
    return written


def current(spark: SparkSession, root: str) -> DataFrame:
    """The live version of a published table, with the types it was written with."""
    versions = spark.read.schema("versao string, esquema string").json(f"{root}/{LIVE}")
    newest = versions.orderBy(F.desc("versao")).first()
    schema = T.StructType.fromJson(json.loads(newest["esquema"]))
    return spark.read.schema(schema).parquet(f"{root}/v-{newest['versao']}")


def current_or_none(spark: SparkSession, root: str) -> DataFrame | None:
    """The live version, or None if the table was never published."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{LIVE}")
    return current(spark, root) if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path) else None


def remove_old_versions(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the data of all but the ``keep`` newest published versions and return their names.

    A load never does this by itself, since readers may still be on an older version. Folders that
    were never published are left alone.
    """
    if keep < 1:
        raise ValueError("the live version has to stay")
    listed = spark.read.schema("versao string").json(f"{root}/{LIVE}").distinct()
    versions = sorted(row["versao"] for row in listed.collect())
    removed = []
    for version in versions[:-keep]:
        if remove_folder(spark, f"{root}/v-{version}"):
            removed.append(version)
    return removed


def load_staging(
    spark: SparkSession, csv_path: str | list[str], root: str, multi_line: bool = False, mixed_headers: bool = False
) -> DataFrame:
    """Replace staging by the raw files' rows, each with a line id.

    Ids ascend with file position and are unique but not consecutive. They are fixed once the
    version is written, which is why everything downstream starts from the written table.
    """
    raw = read_raw(spark, csv_path, multi_line, mixed_headers)
    return publish(raw.select(F.monotonically_increasing_id().alias("linha_id"), "*"), root)


def fact_rows(accepted: DataFrame) -> DataFrame:
    """Accepted rows of a stream with their load defaults; the line id is the fact id."""
    return row_defaults(accepted.withColumn("id_notif", F.col("linha_id")))


def load_fact(accepted: DataFrame, root: str, stored: bool = False) -> DataFrame:
    """Replace the whole fact, partitioned by notification year and sorted by state within files.

    Ids follow from the rows' content, so a row keeps its id from load to load. The typed rows are
    stored once, without the fact's order, to find those that repeat; equal ids would stop the load.
    Rows that come from a table, load defaults and all, are ``stored`` already; the hash may be
    missing if they have a row key.
    """
    with wide_rows(accepted.sparkSession):
        return publish_fact(accepted if stored else written(row_defaults(accepted), "aceitas"), root)


def publish_fact(stored: DataFrame, root: str) -> DataFrame:
    ordered = rebalanced(stable_ids(stored), "nu_ano").sortWithinPartitions("nu_ano", "cod_uf_resi")
    return publish(ordered, root, partition_by="nu_ano", unique=["id_notif"])


def replace_years(rows: DataFrame, path: str, column: str = "nu_ano") -> None:
    """Replace only the years present in ``rows`` in a plain year-partitioned table."""
    (
        rebalanced(rows, column)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def save_bucketed(rows: DataFrame, table: str, keys: list[str], buckets: int, path: str | None = None) -> DataFrame:
    """Save a snapshot as a catalog table bucketed and sorted on its keys, and return it.

    Snapshots saved with the same keys and number of buckets join on the keys without a shuffle;
    the number should give files of a few hundred megabytes. Without ``path`` the table lies in the
    session's warehouse.
    """
    spread = rows.repartition(buckets, *keys)
    writer = spread.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    if path is not None:
        writer = writer.option("path", path)
    with wide_rows(rows.sparkSession):
        writer.saveAsTable(table)
    return rows.sparkSession.table(table)


def remove_folder(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize_mart(mart: DataFrame, root: str, keys: list[str], partition_by: str = "ano") -> DataFrame:
    """Publish a mart whose key columns must be unique."""
    return publish(rebalanced(mart, partition_by), root, partition_by=partition_by, unique=keys)
