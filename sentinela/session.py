"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# HotSpot does not compile methods above 8000 bytes of bytecode. With this limit Spark generates
# several small methods instead of a large one that would stay interpreted, which nearly doubles
# the speed of projections over the 43 guarded columns.
CODE_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    CODE_LIMIT[0]: CODE_LIMIT[1],
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """A session for tests and benchmarks on one machine, with a scratch folder that goes at exit."""
    extra.setdefault("spark.checkpoint.dir", own_folder())
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sentinela")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def own_folder() -> str:
    """One temporary folder for this process, removed when it ends."""
    folder = tempfile.mkdtemp(prefix="sentinela-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


@contextmanager
def wide_rows(spark: SparkSession) -> Iterator[None]:
    """Write wide tables under ``CODE_LIMIT`` whatever the session's own limit is."""
    key, limit = CODE_LIMIT
    before = spark.conf.get(key)
    spark.conf.set(key, limit)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach, below ``spark.checkpoint.dir``.

    A session whose executors are threads of this process may leave the setting out.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = own_folder()
    return os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")


def written(rows: DataFrame, purpose: str) -> DataFrame:
    """Rows as a table in the scratch folder, for results that are read many times.

    Unlike a cache it survives lost executors without computing its inputs again.
    """
    spark = rows.sparkSession
    path = scratch_dir(spark, purpose)
    rows.write.parquet(path)
    return spark.read.parquet(path)
