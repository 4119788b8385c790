"""License scans by an exact set-similarity join of text blocks with license templates.

A block is a line. Templates and blocks are sets of words in one global order, rarest first. A block
contains a template if it has at least ``threshold`` of its words. Such a pair shares a word among the
first ones of both (prefix filter), the block is long enough (length filter), and behind the first
shared word enough words remain on both sides (position filter); what passes is counted exactly.

A notice wrapped over lines is found in windows of words, whatever lines they stand on; a window is
as long as its template divided by the threshold. See ``similar_windows``.

Everything here is DataFrame expressions. Words that no template has cannot match, so blocks are cut
down to template words first; the order and the overlaps stay exact.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentinela.llm.common import kept, text_of

# The phrases whose places are counted, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Sentences by which public licenses are recognised, and their labels.
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction',
    ),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    (
        "apache",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License.",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)
THRESHOLD = 0.8
# Words that name a license. A window must hold those of its template.
NAMING = {"mit", "apache", "gnu", "nc", "sharealike", "attribution", "mozilla"}

# Between words stands any character below 128 that is no digit or letter; texts come lower-cased.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """A-Z in lower case and nothing else changed."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """Words of a lower-cased text."""
    return F.filter(F.split(text, GAP), lambda word: word != "")


def template_sets(templates: tuple = TEMPLATES) -> list[tuple[str, list[str]]]:
    """Label and distinct words of each template."""
    return [(label, sorted({word for word in re.split(GAP, text.lower()) if word})) for label, text in templates]


def least_overlap(size: int, threshold: float) -> int:
    return max(1, math.ceil(threshold * size - 1e-9))


def places(words: Column, phrase: str) -> Column:
    """Numbers of the words at which the phrase's words stand one after the other."""
    parts = phrase.split()

    def stands(at: Column) -> Column:
        found = F.lit(True)
        for i, part in enumerate(parts):
            found = found & F.get(words, at + i).eqNullSafe(F.lit(part))
        return found

    hits = F.filter(F.sequence(F.lit(0), F.size(words) - len(parts)), stands)
    possible = F.array_contains(words, parts[-1]) & (F.size(words) >= len(parts))
    return F.when(possible, hits).otherwise(F.array().cast("array<int>"))


def span_of(text: str, threshold: float) -> int:
    """Words in a window for the template: its own, repeated ones too, and as many others as the threshold allows."""
    return math.ceil(len([word for word in re.split(GAP, text.lower()) if word]) / threshold - 1e-9)


def stretches(words: Column, low: Column, templates: tuple, threshold: float) -> Column:
    """Overlapping stretches of a text with line breaks, such that every window lies whole in one.

    Only those that hold enough words of some template.
    """
    sets = template_sets(templates)
    vocabulary = F.array(*[F.lit(word) for word in sorted({word for _, words in sets for word in words})])
    longest = max(span_of(text, threshold) for _, text in templates)
    needs = [(F.array(*[F.lit(word) for word in words]), least_overlap(len(words), threshold)) for _, words in sets]

    def enough(own: Column) -> Column:
        found = F.lit(False)
        for members, need in needs:
            found = found | ((F.size(own) >= need) & (F.size(F.array_intersect(own, members)) >= need))
        return found

    starts = F.sequence(F.lit(1), F.greatest(F.size(words), F.lit(1)), F.lit(longest))
    parts = F.transform(starts, lambda at: F.slice(words, at, 2 * longest))
    cut = F.transform(parts, lambda part: F.struct(part.alias("part"), F.array_intersect(part, vocabulary).alias("own")))
    held = F.transform(F.filter(cut, lambda part: enough(part["own"])), lambda part: part["part"])
    return F.when(F.contains(low, F.lit("\n")), held).otherwise(F.array().cast("array<array<string>>"))


def scanned(docs: DataFrame, sets: list[tuple[str, list[str]]], threshold: float, wrapped: tuple = ()) -> DataFrame:
    """Per document its word count, places of the phrases, and blocks cut down to template words.

    With stretches of text for the templates in ``wrapped``.
    """
    vocabulary = F.array(*[F.lit(word) for word in sorted({word for _, words in sets for word in words})])
    shortest = min(least_overlap(len(words), threshold) for _, words in sets)
    low = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lowered(text_of()).alias("low"))
    split = low.select("doc_id", "low", words_of(F.col("low")).alias("words"), F.split("low", "\n").alias("lines"))
    extra = [stretches(F.col("words"), F.col("low"), wrapped, threshold).alias("stretches")] if wrapped else []
    blocks = F.transform("lines", lambda line: F.array_intersect(words_of(line), vocabulary))
    return split.select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.size("words").cast("long").alias("n_words"),
        *[places(F.col("words"), phrase).alias(label) for phrase, label in PHRASES.items()],
        F.filter(blocks, lambda block: F.size(block) >= shortest).alias("blocks"),
        *extra,
    )


def inline_table(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """A small table of literals."""
    values = [F.struct(*[F.lit(value).alias(name) for name, value in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*values)))


def similar_blocks(blocks: DataFrame, sets: list[tuple[str, list[str]]], threshold: float) -> DataFrame:
    """``row``, ``block``, ``label`` and ``containment`` of every block that contains a template.

    ``blocks`` has row, block and words (distinct, template words only).
    """
    spark = blocks.sparkSession
    # At most one row per template word.
    counts = blocks.select(F.explode("words").alias("word")).groupBy("word").count().collect()
    seen = {row["word"]: row["count"] for row in counts}
    order = sorted({word for _, words in sets for word in words}, key=lambda word: (seen.get(word, 0), word))
    rank = {word: i + 1 for i, word in enumerate(order)}
    index, whole = [], []
    for number, (label, words) in enumerate(sets):
        ranks = sorted(rank[word] for word in words)
        need = least_overlap(len(ranks), threshold)
        whole.append((number, label, ranks, len(ranks), need))
        index += [(number, at, place, len(ranks), need) for place, at in enumerate(ranks[: len(ranks) - need + 1], 1)]
    # The templates' prefixes and sets: their size is that of the template list.
    prefixes = inline_table(spark, index, ["template", "word_rank", "place", "size", "need"])
    members = inline_table(spark, whole, ["template", "label", "ranks", "size", "need"])
    global_order = F.array(*[F.lit(word) for word in order])
    rare = F.array(*[F.lit(order[at - 1]) for at in sorted({row[1] for row in index})])
    ranked = blocks.where(F.arrays_overlap("words", rare)).select(
        "row", "block",
        F.array_sort(F.transform("words", lambda word: F.array_position(global_order, word).cast("int"))).alias("own"),
    )
    probes = ranked.select("row", "block", "own", F.posexplode("own").alias("at", "word_rank"))
    length = F.size("own")
    candidates = (
        probes.join(F.broadcast(prefixes), "word_rank")
        .where(length >= F.col("need"))
        .where(F.col("at") < length - F.col("need") + 1)
        .where(1 + F.least(F.col("size") - F.col("place"), length - F.col("at") - 1) + F.least(F.col("place") - 1, F.col("at")) >= F.col("need"))
        .select("row", "block", "own", "template")
        .distinct()
    )
    overlap = F.size(F.array_intersect("own", "ranks"))
    checked = candidates.join(F.broadcast(members), "template").withColumn("overlap", overlap)
    return checked.where("overlap >= need").select("row", "block", "label", (F.col("overlap") / F.col("size")).alias("containment"))


def similar_windows(parts: DataFrame, templates: tuple, threshold: float) -> DataFrame:
    """``row``, ``label`` and ``containment`` of every template that a window of the stretches contains.

    A window starts at a template word. It matches if it holds enough distinct words of the template,
    as a line does, and all that name the license. ``parts`` has row and words, each in its place.
    """
    rows = []
    for (label, text), (_, words) in zip(templates, template_sets(templates)):
        naming = [word for word in words if word in NAMING]
        rows.append((label, words, naming, len(words), least_overlap(len(words), threshold), span_of(text, threshold)))
    members = inline_table(parts.sparkSession, rows, ["label", "members", "naming", "size", "need", "span"])
    pairs = parts.crossJoin(F.broadcast(members)).where(F.size(F.array_intersect("words", "members")) >= F.col("need"))
    places = F.filter(F.sequence(F.lit(1), F.size("words")), lambda at: F.array_contains(F.col("members"), F.get("words", at - 1)))
    windows = F.transform(places, lambda at: F.slice("words", at, F.col("span")))
    named = F.filter(windows, lambda window: F.size(F.array_intersect(F.col("naming"), window)) == F.size("naming"))
    overlap = F.array_max(F.transform(named, lambda window: F.size(F.array_intersect(window, F.col("members")))))
    return pairs.withColumn("overlap", overlap).where("overlap >= need").select("row", "label", (F.col("overlap") / F.col("size")).alias("containment"))


def licenses(docs: DataFrame, templates: tuple = TEMPLATES, threshold: float = THRESHOLD, wrapped: bool = False) -> DataFrame:
    """Phrase places, labels and score per document.

    ``wrapped`` also finds templates whose words are spread over neighbouring lines; without it a
    block is a single line.

    ``labels`` adds the labels of contained templates to those of the phrases. ``score`` is 1 where
    a phrase stands, else the largest containment of a matched template, else 0. The texts are read
    once; what is joined are the few template words of each line.

    Nulls: a null text is empty and has no words or labels, a null doc_id stays null. Long texts and
    lines are scanned whole. Repeated rows come out each, an empty table gives no rows, other
    columns are not read.
    """
    sets = template_sets(templates)
    rows = kept(scanned(docs, sets, threshold, templates if wrapped else ()), "scanned")
    blocks = rows.where(F.size("blocks") > 0).select("row", F.posexplode("blocks").alias("block", "words"))
    found = similar_blocks(blocks, sets, threshold).drop("block")
    if wrapped:
        parts = rows.where(F.size("stretches") > 0).select("row", F.explode("stretches").alias("words"))
        found = found.unionByName(similar_windows(parts, templates, threshold))
    per_row = found.groupBy("row").agg(F.collect_set("label").alias("found"), F.max("containment").alias("best"))
    all_places = F.array_sort(F.concat(*PHRASES.values()))
    base = F.array_compact(F.array(*[F.when(F.size(label) > 0, F.lit(label)) for label in PHRASES.values()]))
    some = F.size("places") > 0
    joined = rows.withColumn("places", all_places).withColumn("base", base).join(per_row, "row", "left")
    found_labels = F.coalesce("found", F.array().cast("array<string>"))
    return joined.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.when(some, F.get("places", F.lit(0))).cast("long").alias("first_word"),
        F.when(some, F.element_at("places", -1)).cast("long").alias("last_word"),
        F.concat_ws(",", F.array_sort("base")).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.array_union("base", found_labels))).alias("labels"),
        F.when(some, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
