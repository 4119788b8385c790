"""Hashes, row snapshots and accent-tolerant name similarity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Portuguese accented letters and their plain forms.
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçñ"
PLAIN = "aaaaaeeeeiiiiooooouuuucn"


def group_hash(*parts: Column) -> Column:
    """md5 of the joined texts; NULL as soon as one part is NULL."""
    return F.md5(F.concat(*[part.cast("string") for part in parts]))


def content_hash(rows: DataFrame, columns: list[str]) -> Column:
    """Deterministic hash of the named columns' content.

    Text is written with its length, so that NULL, empty text and shifted fields differ; other
    types cannot contain the separator.
    """
    def part(name: str) -> Column:
        value = F.col(name)
        if isinstance(rows.schema[name].dataType, T.StringType):
            value = F.concat_ws(":", F.length(value), value)
            return F.when(F.col(name).isNotNull(), value).otherwise("-")
        return F.coalesce(value.cast("string"), F.lit("-"))

    # Never NULL; saying so spares joins on the hash a check that would compute it again.
    return F.coalesce(F.sha2(F.concat_ws("|", *[part(name) for name in columns]), 256), F.lit(""))


def row_json(*columns: Column | str) -> Column:
    """A row snapshot as JSON that keeps NULL fields."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def field_diff(before: str, after: str, columns: list[str]) -> Column:
    """Changed fields of two row structs as ``name -> (de, para)``; NULL if nothing changed."""
    entries = [
        F.when(
            ~F.col(f"{before}.{name}").eqNullSafe(F.col(f"{after}.{name}")),
            F.struct(
                F.lit(name).alias("key"),
                F.struct(
                    F.col(f"{before}.{name}").cast("string").alias("de"),
                    F.col(f"{after}.{name}").cast("string").alias("para"),
                ).alias("value"),
            ),
        )
        for name in columns
    ]
    changed = F.filter(F.array(*entries), lambda entry: entry.isNotNull())
    return F.when(F.size(changed) > 0, F.map_from_entries(changed))


def same_name(left: Column, right: Column) -> Column:
    """Equality of two names that ignores case and accents of any script."""
    return F.collate(left, "UNICODE_CI_AI") == F.collate(right, "UNICODE_CI_AI")


def plain_text(text: Column) -> Column:
    """Lower case without accents."""
    return F.translate(F.lower(text), ACCENTED, PLAIN)


def trigrams(text: Column) -> Column:
    """Distinct letter triples of each word, padded with two blanks before and one after."""
    words = F.filter(F.split(plain_text(text), "[^a-z0-9]+"), lambda word: F.length(word) > 0)

    def word_trigrams(word: Column) -> Column:
        padded = F.concat(F.lit("  "), word, F.lit(" "))
        return F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda at: F.substring(padded, at, F.lit(3)))

    return F.array_distinct(F.flatten(F.transform(words, word_trigrams)))


def similarity(left: Column, right: Column) -> Column:
    """Jaccard similarity of two texts' trigram sets; 0 when both are empty."""
    a, b = trigrams(left), trigrams(right)
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / F.nullif(union, F.lit(0)))
