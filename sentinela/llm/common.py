"""What the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentinela.session import written

# Words are runs of bytes other than space and \t \n \v \f \r; bytes.split() cuts exactly there.
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def lower_words(text: str | None) -> list[bytes]:
    """Words of the text as UTF-8 with A-Z lower-cased and nothing else changed."""
    return (text or "").encode().lower().split()


def fold_of(column: str, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds


def kept(rows: DataFrame, purpose: str) -> DataFrame:
    """Rows as a table below ``spark.checkpoint.dir``: computed once, safe from lost executors."""
    return written(rows, purpose)


def in_groups(
    batches: Iterable[pd.DataFrame], keys: list[str], work: Callable[[tuple, pd.DataFrame], pd.DataFrame | None]
) -> Iterator[pd.DataFrame]:
    """Apply ``work`` to each run of equal keys in a partition sorted by them.

    One group is in memory at a time, so callers bound the size of a group, not of a partition.
    Cheaper than ``applyInPandas`` where most groups have a few rows.
    """
    rest: list[pd.DataFrame] = []

    def closed(parts: list[pd.DataFrame]) -> pd.DataFrame | None:
        group = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        return work(tuple(group[key].iat[0] for key in keys), group)

    for batch in batches:
        if batch.empty:
            continue
        columns = [batch[key].to_numpy() for key in keys]
        changes = np.zeros(len(batch) - 1, dtype=bool)
        for column in columns:
            changes |= column[1:] != column[:-1]
        starts = [0, *(np.flatnonzero(changes) + 1).tolist(), len(batch)]
        results = []
        for start, end in zip(starts, starts[1:]):
            part = batch.iloc[start:end]
            if start == 0 and rest and any(rest[-1][key].iat[-1] != part[key].iat[0] for key in keys):
                results.append(closed(rest))
                rest = []
            if start > 0 and rest:
                results.append(closed(rest))
                rest = []
            rest.append(part)
        results = [result for result in results if result is not None and len(result)]
        if results:
            yield pd.concat(results, ignore_index=True)
    if rest:
        result = closed(rest)
        if result is not None and len(result):
            yield result
