"""Key checks against dimensions, reported instead of enforced."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentinela.schemas import CODE_LISTS, FOREIGN_KEYS, STATES


def anti_unknown_code(rows: DataFrame, column: str, dim: DataFrame, key: str) -> DataFrame:
    """Rows whose non-NULL code the dimension lacks."""
    codes = dim.select(F.col(key).alias("_known"))
    coded = rows.where(F.col(column).isNotNull())
    return coded.join(codes, coded[column] == codes["_known"], "left_anti")


def fixed_codes() -> dict[str, list]:
    """Codes of the dimensions that are fixed lists."""
    return {"uf": [row[0] for row in STATES], **{name: [row[0] for row in rows] for name, rows in CODE_LISTS.items()}}


def fk_violations(
    fact: DataFrame,
    dims: dict[str, DataFrame],
    keys: list[tuple[str, str, str]] = FOREIGN_KEYS,
    known: dict[str, list] | None = None,
) -> DataFrame:
    """Rows per foreign key and code that its dimension lacks; NULL codes pass.

    All keys are counted in one scan. Only the distinct codes meet the dimensions. ``known`` names
    codes that are certainly in a dimension, such as ``fixed_codes``; a row does not report those,
    so a clean row reports little more than its municipalities and its health unit.
    """
    checked = [(column, dim, key) for column, dim, key in keys if column in fact.columns and dim in dims]

    def used_code(column: str, dim: str):
        reported = F.col(column).isNotNull()
        if known and dim in known:
            reported &= ~F.col(column).isin(known[dim])
        return F.when(
            reported,
            F.struct(
                F.lit(column).alias("coluna"),
                F.lit(dim).alias("dimensao"),
                F.col(column).cast("string").alias("codigo"),
            ),
        )

    pairs = F.array_compact(F.array(*[used_code(column, dim) for column, dim, _ in checked]))
    used = (
        fact.select(F.inline(pairs))
        .groupBy("coluna", "dimensao", "codigo")
        .agg(F.count(F.lit(1)).alias("n_linhas"))
    )
    known = reduce(
        DataFrame.unionByName,
        [
            dims[dim].select(F.lit(dim).alias("dimensao"), F.col(key).cast("string").alias("codigo"))
            for dim, key in sorted({(dim, key) for _, dim, key in checked})
        ],
    )
    return used.join(known, ["dimensao", "codigo"], "left_anti").select(
        "coluna", "dimensao", "codigo", "n_linhas"
    )


def duplicate_keys(table: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_linhas")).where(F.col("n_linhas") > 1)
