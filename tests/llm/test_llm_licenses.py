from __future__ import annotations

import math
import random
import re
import textwrap

from helpers import HARD, collected, documents

from sentinela.llm import licenses, queries

UPPER = str.maketrans(licenses.UPPER, licenses.LOWER)


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(UPPER))


def by_definition(text, templates=licenses.TEMPLATES, threshold=licenses.THRESHOLD):
    """Places of the phrases and every line against every template."""
    text = text or ""
    words = words_of(text)
    spots, base = [], set()
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                spots.append(i)
                base.add(label)
    best, labels = 0.0, set(base)
    for line in text.split("\n"):
        own = set(words_of(line))
        for label, members in licenses.template_sets(templates):
            share = len(own & set(members)) / len(members)
            if share >= threshold - 1e-12:
                labels.add(label)
                best = max(best, share)
    return {
        "n_words": len(words), "n_base": len(spots), "first_word": min(spots, default=None), "last_word": max(spots, default=None),
        "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(labels)), "score": 1.0 if spots else best,
    }


def check(spark, rows, **options):
    found = collected(licenses.licenses(documents(spark, rows), **options))
    assert len(found) == len(rows)
    texts = {row[0]: row[1] for row in rows}
    for row in found:
        doc_id = row.pop("doc_id")
        if doc_id is not None:
            assert row == by_definition(texts[doc_id], **options), doc_id
    return found


def test_templates_whole_cut_and_shuffled(spark):
    rng = random.Random(3)
    rows = []
    for label, text in licenses.TEMPLATES:
        words = text.split()
        for share in (1.0, 0.9, 0.8, 0.75, 0.5):
            part = rng.sample(words, max(1, round(share * len(words))))
            for line in (" ".join(part), "x1 " + " filler ".join(part) + " the and of", " ".join(words)):
                rows.append((len(rows), f"first line\n{line}\nlast MIT\nLicense line", "en", "a", 1))
    found = check(spark, rows)
    assert sum(row["labels"] != row["base_labels"] for row in found) > 20
    check(spark, rows, threshold=0.6)


def test_random_sets_against_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"t{i}" for i in range(40)]
    templates = tuple((f"l{i}", " ".join(rng.sample(vocabulary, rng.randrange(1, 12)))) for i in range(15))
    rows = [(i, "\n".join(" ".join(rng.choices(vocabulary, k=rng.randrange(0, 25))) for _ in range(4)), "en", "a", 1) for i in range(120)]
    for threshold in (0.5, 0.7, 1.0):
        check(spark, rows, templates=templates, threshold=threshold)


def test_phrases_across_lines_and_marks(spark):
    texts = [
        "The MIT-License, the mit\nlicense; mit licensed", "MİT license", "apache apache license license", "general public public license",
        "GENERAL  public\tLicense GNU general public license", "license", "mit", "émit license", "mit 1 license", "KK license mit_license",
    ]
    check(spark, [(i, text, "en", "a", 1) for i, text in enumerate(texts)])


def by_windows(text, threshold=licenses.THRESHOLD):
    """Labels of the templates that some run of as many words as the threshold allows contains."""
    words, labels = words_of(text), set()
    for label, template in licenses.TEMPLATES:
        span = math.ceil(len(words_of(template)) / threshold - 1e-9)
        own = set(words_of(template))
        for at in range(len(words)):
            window = set(words[at : at + span])
            if len(window & own) / len(own) >= threshold - 1e-12 and own & licenses.NAMING <= window:
                labels.add(label)
    return labels


def test_templates_wrapped_over_lines(spark):
    rng = random.Random(5)
    prose = "the of and software this work is under license licensed terms public in to version released by 4 0 file".split()
    rows, owed = [], []
    for label, template in licenses.TEMPLATES:
        for mark in ("", "# ", " * ", "// "):
            for lead in ("", "Copyright 2020 by the authors of this file. " * 4):
                for width in (30, 72):
                    lines = textwrap.wrap(lead + template, width)
                    noise = [" ".join(rng.choices(prose, k=9)) for _ in range(30)]
                    rows.append((len(rows), "\n".join([*noise, "", *[mark + line for line in lines], "", *noise]), "en", "a", 1))
                    owed.append(label)
    rows += [(len(rows) + i, "\n".join(" ".join(rng.choices(prose, k=8)) for _ in range(40)), "en", "a", 1) for i in range(20)]
    rows.append((len(rows), "released under the terms\nof the license of the Apache project", "en", "a", 1))
    for row in collected(licenses.licenses(documents(spark, rows), wrapped=True)):
        text = rows[row["doc_id"]][1]
        lines = by_definition(text)
        assert set(row["labels"].split(",")) - {""} == {*lines["labels"].split(","), *by_windows(text)} - {""}, text
        if row["doc_id"] < len(owed):
            assert owed[row["doc_id"]] in row["labels"].split(",") and row["score"] == 1.0, text
    assert row["labels"] == "" and row["doc_id"] == len(rows) - 1


def test_wrapped_notices_are_found_by_the_query(spark, tmp_path):
    notice = textwrap.fill(next(text for label, text in licenses.TEMPLATES if label == "bsd"), 72)
    documents(spark, [*HARD, (8, notice, "en", "a", 1)]).write.parquet(f"{tmp_path}/documents.parquet")
    found = collected(queries.op3_license_scans(spark, str(tmp_path)))
    assert len(found) == len(HARD) + 1
    assert [(row["labels"], row["score"]) for row in found if row["doc_id"] == 8] == [("bsd", 1.0)]


def test_hard_documents(spark):
    check(spark, [*HARD, (8, "word " * 5000 + "MIT License", "en", "a", 1)])
    assert licenses.licenses(documents(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    plan = licenses.licenses(documents(spark, HARD[:3]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval", plan)
