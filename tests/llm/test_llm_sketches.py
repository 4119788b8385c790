from __future__ import annotations

import random
import re
from hashlib import md5, sha256

import pytest
from helpers import HARD, collected, documents
from pyspark.sql import functions as F

from sentinela.llm import sketches


def paragraphs(text):
    return {line for line in text.split("\n") if line.strip(" ")}


def likeness(left, right):
    return 1.0 if not left | right else len(left & right) / len(left | right)


def check(spark, rows):
    found = collected(sketches.fingerprints(documents(spark, rows)))
    assert len(found) == len(rows)
    ordered = sorted(rows, key=lambda row: (row[0] is None, row[0]))
    seen = {}
    by_id = {row["doc_id"]: row for row in found}
    for i, (doc_id, text, *_) in enumerate(ordered):
        text, following = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        row = by_id[doc_id]
        assert row["n_chars"] == len(text) and row["edited_sha256"] == sha256(edited.encode()).hexdigest()
        assert row["near_edited"] == pytest.approx(likeness(paragraphs(text), paragraphs(edited)))
        assert row["near_next"] == pytest.approx(likeness(paragraphs(text), paragraphs(following)))
        assert seen.setdefault(text, row["fingerprint"]) == row["fingerprint"]
        assert seen.setdefault(edited, row["edited_fingerprint"]) == row["edited_fingerprint"]


def sample(n=60, seed=8):
    rng = random.Random(seed)
    lines = [f"line number {i} é" for i in range(400)]
    return [(i * 3, "\n".join(rng.choices(lines, k=rng.choice([0, 1, 3, 8, 30, 200]))), "en", "a", 1) for i in range(n)]


def test_likeness_equals_the_paragraph_sets(spark):
    check(spark, sample())


def test_ranges_change_nothing(spark, monkeypatch):
    for docs, quantiles in ((7, 4), (7, 512), (1, 3)):
        monkeypatch.setattr(sketches, "RANGE_DOCS", docs)
        monkeypatch.setattr(sketches, "QUANTILES", quantiles)
        rows = documents(spark, sample(25))
        found = {row["doc_id"]: (row["text"], row["next_text"]) for row in sketches.with_next(rows).collect()}
        ordered = sorted(sample(25))
        want = {row[0]: (row[1], ordered[(i + 1) % len(ordered)][1]) for i, row in enumerate(ordered)}
        assert found == want


def test_a_third_without_id_is_dealt_to_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(sketches, "RANGE_DOCS", 64)
    rows = [(None if i % 3 == 0 else 7 if i % 10 == 1 else i, f"text {i}", "en", "a", 1) for i in range(6000)]
    found = sketches.with_next(documents(spark, rows))
    sizes = sorted(row["n"] for row in found.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())
    assert sizes[-1] < 400 and len(sizes) > 60  # some ranges share a task
    got = [(row["doc_id"], row["text"], row["next_text"]) for row in found.collect()]
    ordered = sorted(rows, key=lambda row: (row[0] is None, row[0] or 0, md5(row[1].encode()).hexdigest()))
    want = [(row[0], row[1], ordered[(i + 1) % len(ordered)][1]) for i, row in enumerate(ordered)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_hard_documents(spark):
    single = [row for row in HARD if row[0] is not None and row != HARD[1]]
    check(spark, single)
    check(spark, [HARD[3]])
    found = collected(sketches.fingerprints(documents(spark)))
    assert len(found) == len(HARD) and sum(row["doc_id"] is None for row in found) == 2
    assert sketches.fingerprints(documents(spark, [])).count() == 0


def test_peeling_recovers_the_differing_digests(spark):
    rng = random.Random(9)
    left, right = [rng.getrandbits(62) for _ in range(30)], [rng.getrandbits(62) for _ in range(20)]
    shared = [rng.getrandbits(62) for _ in range(1000)]
    pairs = spark.createDataFrame([(1, left + shared, shared + right)], "row long, left array<long>, right array<long>")
    got = {(row["digest"], row["side"]) for row in sketches.recovered(pairs, ["row"], 64).collect()}
    assert got == {(d, 1) for d in left} | {(d, -1) for d in right}


def test_recovering_retries_until_nothing_is_stuck(spark):
    rng = random.Random(10)
    rows = [(i, [rng.getrandbits(62) for _ in range(i * i)], [rng.getrandbits(62) for _ in range(2 * i)]) for i in range(30)]
    pairs = spark.createDataFrame(rows, "row long, left array<long>, right array<long>")
    got = sorted(tuple(row) for row in sketches.recovered(pairs, ["row"]).select("row", "digest", "side").collect())
    assert got == sorted([(i, d, 1) for i, left, _ in rows for d in left] + [(i, d, -1) for i, _, right in rows for d in right])


def test_a_sketch_that_is_too_small_is_retried_larger(spark):
    rows = [(i, list(range(i * 1000, i * 1000 + 5 * i)), list(range(i * 1000 + 4 * i, i * 1000 + 9 * i))) for i in range(0, 60)]
    pairs = spark.createDataFrame(rows, "row long, left array<long>, right array<long>")
    found = {row["row"]: (row["left_only"], row["right_only"]) for row in sketches.differences(pairs, ["row"]).collect()}
    assert all(found[i] == (4 * i, 4 * i) for i in range(1, 60))


def test_no_python_in_the_plan(spark):
    plan = sketches.fingerprints(documents(spark, HARD[:3]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval", plan)


def test_stored_cells_are_the_first_attempt(spark):
    digests = spark.createDataFrame([([5, 6, 7, 8],)], "d array<long>")
    stored = digests.select(sketches.stored_sketch(F.col("d")).alias("s")).first()["s"]
    pairs = digests.select(F.lit(1).alias("row"), F.col("d").alias("left"), F.array().cast("array<long>").alias("right"))
    cells = sketches.difference_cells(pairs, ["row"], F.lit(sketches.STORED), 0).collect()
    for cell in cells:
        own = stored[cell["subtable"] * sketches.STORED + cell["cell"]]
        assert (own["n"], own["digest"], own["check"]) == (cell["n"], cell["digest"], cell["check"])
    assert sum(cell["n"] for cell in stored) == 12
