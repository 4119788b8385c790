"""Raw notification CSV and result CSV."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentinela.schemas import RAW_HEADER
from sentinela.session import wide_rows

# With columns pruned, lines too short for columns that nobody asked for would not count as malformed.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "nullValue": "",
    "encoding": "UTF-8",
    "enforceSchema": "false",
    "columnPruning": "false",
}

# Spark's writer trims blanks unless told otherwise.
WRITE_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


HEADER_READS = 8

# The text of a line that does not have the header's number of fields.
MALFORMED = "linha_malformada"


def raw_columns(raw: DataFrame) -> DataFrame:
    """Check the header and bring the columns into staging names and order; empty text is NULL.

    A malformed line keeps its text in ``linha_malformada`` and no values.
    """
    missing = [name for name in RAW_HEADER if name not in raw.columns]
    if missing:
        raise ValueError(f"columns missing from the raw file: {missing}")
    broken = F.col(MALFORMED) if MALFORMED in raw.columns else F.lit(None).cast("string")
    fields = [F.when(broken.isNull(), F.nullif(F.col(name), F.lit(""))).alias(name.lower()) for name in RAW_HEADER]
    return raw.select(*fields, broken.alias(MALFORMED))


def headers(spark: SparkSession, files: list[str], multi_line: bool = False) -> dict[tuple[str, ...], list[str]]:
    """Files by their header. Each header is one small read, several at a time."""

    def header(file: str) -> tuple[str, ...]:
        return tuple(spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line).csv(file).columns)

    groups: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(HEADER_READS) as pool:
        for file, found in zip(files, pool.map(header, files)):
            groups.setdefault(found, []).append(file)
    return groups


def read_raw(
    spark: SparkSession, path: str | list[str], multi_line: bool = False, mixed_headers: bool = False
) -> DataFrame:
    """Read raw notification files as 43 text columns and ``linha_malformada``.

    Columns are found by header name, in any order. A folder's files must agree on the order, unless
    ``mixed_headers`` is set: then every file's header is read first, and files of one header are
    read together. A line with more or fewer fields than the header is kept as malformed, and so are
    the parts of a value with line breaks unless ``multi_line`` is set; files stay splittable without it.
    """
    def read(files: str | list[str], header: Sequence[str]) -> DataFrame:
        schema = T.StructType([T.StructField(name, T.StringType()) for name in [*header, MALFORMED]])
        reader = spark.read.schema(schema).options(**CSV_OPTIONS).option("multiLine", multi_line)
        return raw_columns(reader.option("columnNameOfCorruptRecord", MALFORMED).csv(files))

    if not mixed_headers:
        return read(path, spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line).csv(path).columns)
    # The listing's names are escaped; the reader wants them plain.
    files = [unquote(file) for file in spark.read.text(path).inputFiles()]
    groups = headers(spark, files, multi_line)
    if not groups:
        raise ValueError(f"no raw files in {path}")
    return reduce(DataFrame.unionByName, [read(members, header) for header, members in groups.items()])


def export_csv(rows: DataFrame, path: str, single_file: bool = False) -> None:
    """Write rows as CSV with a header, blanks kept; ``single_file`` is for report-sized results."""
    if single_file:
        rows = rows.coalesce(1)
    with wide_rows(rows.sparkSession):
        rows.write.mode("overwrite").options(**WRITE_OPTIONS).csv(path)


def read_result_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read an exported result back with its types."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(path)
    )
