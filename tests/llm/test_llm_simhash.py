from __future__ import annotations

import random

import numpy as np
from helpers import HARD, documents
from xxhash import xxh64_intdigest

from sentinela.llm import simhash


def by_definition(text, shingle=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [b" ".join(words)]
    hashes = [xxh64_intdigest(part, 42) for part in parts]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def linked(pairs):
    """Smallest reachable id by brute force over (id, fingerprint)."""
    least = {i: i for i, _ in pairs}
    changed = True
    while changed:
        changed = False
        for i, f in pairs:
            for j, g in pairs:
                if (f ^ g).bit_count() <= 2 and least[j] < least[i]:
                    least[i], changed = least[j], True
    return least


def test_fingerprints_by_definition():
    for text in ["", "one", "one two", "One two THREE", "a b c d e f", "x " * 50, HARD[5][1], HARD[9][1], "É é K K"]:
        assert simhash.fingerprint(text) == by_definition(text)


def test_hard_documents(spark):
    found = simhash.near_duplicates(documents(spark)).collect()
    assert len(found) == len(HARD)
    by_id = {row["doc_id"]: row for row in found if row["doc_id"] is not None}
    for doc_id, text, *_ in HARD:
        if doc_id is not None:
            assert int(by_id[doc_id]["fingerprint"], 16) == by_definition(text)
    # Empty texts and white space have fingerprint zero and are one component, null ids or not.
    assert {by_id[i]["component_id"] for i in (2, 3, 4)} == {2}
    assert by_id[6]["component_id"] == by_id[1]["component_id"] == 1
    nulls = sorted((row["component_id"] or -1) for row in found if row["doc_id"] is None)
    assert nulls == [-1, 2]
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


def test_the_tree_finds_what_brute_force_finds():
    rng = random.Random(1)
    centres = [rng.getrandbits(64) for _ in range(5)]
    values = sorted({c ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(6))) & (2**64 - 1) for c in centres * 60})
    tree = simhash.BkTree(values)
    asked = np.array(values, dtype=np.uint64)
    for radius in (0, 1, 2, 5):
        got = {(node, query) for node, hits in tree.within(asked, radius) for query in hits.tolist()}
        assert got == {(a, b) for a in values for b in values if (a ^ b).bit_count() <= radius}
    for node, edges in tree.children.items():
        assert all((node ^ child).bit_count() == distance for distance, child in edges.items())


def test_components_with_small_trees_and_hot_buckets(spark):
    rng = random.Random(2)
    base = rng.getrandbits(64)
    values = [base]
    for _ in range(150):  # chains and clouds around one value share buckets
        values.append(values[rng.randrange(len(values))] ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    values += [rng.getrandbits(64) for _ in range(100)]
    values = list(dict.fromkeys(values))
    signed = np.array(values, dtype=np.uint64).view(np.int64).tolist()
    classes = spark.createDataFrame([(v,) for v in signed], "fp long")
    for tree_size in (8, 4096):
        roots = {row["node"]: row["root"] for row in simhash.components(simhash.links(classes, 2, tree_size)).collect()}
        least = linked(list(zip(signed, values)))
        assert {v: roots.get(v, v) for v in signed} == least


def test_long_chains_become_one_component(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(200)], "u long, v long")
    roots = simhash.components(edges).collect()
    assert len(roots) == 200 and {row["root"] for row in roots} == {0}


def test_one_of_each_group_stays_with_its_columns(spark):
    docs = documents(spark)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted(row["doc_id"] for row in rows if row["doc_id"] is not None) == [1, 2, 5, 7]
    assert len([row for row in rows if row["doc_id"] is None]) == 2


def test_repeated_and_missing_ids_lose_no_text(spark):
    words = " ".join(f"w{i}" for i in range(3000))
    near = words + " end"
    assert (simhash.fingerprint(words) ^ simhash.fingerprint(near)).bit_count() <= 2
    other = "something else altogether in a row"
    rows = [
        (1, words, "en", "a", 1), (1, other, "en", "a", 1), (2, near, "en", "a", 1), (3, other, "en", "b", 1), (1, words, "en", "0", 1),
        (None, near, "en", "a", 1), (None, words, "en", "a", 1), (None, words, "en", "b", 1), (None, "no id at all", "en", "a", 1),
    ]
    results = []
    for given in (rows, rows[::-1]):
        kept = simhash.one_of_each(documents(spark, given).repartition(3)).collect()
        assert sorted(row["text"] for row in kept if row["doc_id"] == 1) == sorted([words, other])
        assert len(kept) == 4 and {row["doc_id"] for row in kept} == {1, None}
        results.append({tuple(row) for row in kept})
    assert results[0] == results[1]
