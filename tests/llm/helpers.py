"""Documents with the difficulties every operator has to stand."""

from __future__ import annotations

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

LONG = " ".join(f"word{i % 977} and" for i in range(60_000))

HARD = [
    (1, "plain words in a row", "en", "a", 20),
    (1, "plain words in a row", "en", "a", 20),
    (2, None, None, None, None),
    (None, "text without an id", "en", None, 18),
    (None, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, " \t\n\x0b\x0c\r ", "en", "b", 7),
    (5, LONG, "en", "b", len(LONG)),
    (6, "Plain Words in A row", "en", "b", 20),
    (7, "ünï cödé   \x1c 😀 x", "fr", "ß", 18),
]


def documents(spark, rows=HARD, **extra):
    """The rows as documents, with columns whose names operators might use for their own."""
    docs = spark.createDataFrame(list(rows), DOCS)
    clashing = "row score fp size part block rank digest copy doc id words place source_size taken _score held_out n".split()
    for i, name in enumerate(clashing):
        docs = docs.selectExpr("*", f"'{name}-{i}' AS {name}")
    return docs


def collected(rows):
    return [row.asDict() for row in rows.collect()]
