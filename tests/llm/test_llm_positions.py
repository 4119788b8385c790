from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
from helpers import HARD, documents

from sentinela.llm import positions

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))


def by_definition(docs, items, k=50):
    counted = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    counted = [(doc_id, c) for doc_id, c in counted if c]
    total, length = len(counted), sum(c.total() for _, c in counted)
    df = Counter(term for _, c in counted for term in c)
    out = []
    for item_id, text in sorted(set(items), key=str):
        scored = []
        for doc_id, c in counted:
            m = 100 - 50 + (50 * c.total() * total) // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(terms(text))
                if t in c
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, doc_id, -score) for rank, (score, _, _, doc_id) in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=str)


def found(rows):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows.collect()), key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(200)] + ["É", "ñandú", "A-B", "x_y"]
    shares = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, shares, k=rng.randint(1, 60)))) for i in range(n)]
    docs += [(n + i, docs[0][1]) for i in range(70)]  # more ties than places
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(12)]
    items += [(50, docs[0][1]), (51, "nothing-like-it"), (52, ""), (53, None), (None, "w1 w2"), (0, items[0][1]), (0, "w0 w5")]
    return docs, items


def frames(spark, docs, items):
    return (
        documents(spark, [(i, text, None, None, None) for i, text in docs]),
        spark.createDataFrame([(i, text, "c") for i, text in items], "item_id long, text string, term string"),
    )


def test_equal_to_brute_force(spark):
    docs, items = corpus(3, 400)
    given = frames(spark, docs, items)
    want = by_definition(docs, items)
    assert found(positions.search(*given)) == want
    # Small shards, small blocks and the way without a vocabulary.
    assert found(positions.search(*given, shard=37, item_block=3, most_words=5)) == want
    assert found(positions.search(*given, k=3, shard=64)) == by_definition(docs, items, 3)


def test_hard_documents(spark):
    items = [(1, "plain words"), (2, "ÜNÏ cödé"), (3, "word5 and"), (4, None)]
    docs = [(doc_id, text) for doc_id, text, *_ in HARD]
    got = found(positions.search(*frames(spark, docs, items)))
    assert got == by_definition(docs, items)
    assert positions.search(*frames(spark, [], items)).count() == 0
    assert positions.search(*frames(spark, docs, [])).count() == 0
    assert positions.search(*frames(spark, [(1, None), (2, "--")], items)).count() == 0


def shard_of(rng, n_docs, n_terms):
    rows = []
    for term in range(n_terms):
        held = rng.choice(n_docs, rng.integers(1, n_docs), replace=False)
        rows += [(term, doc, int(rng.pareto(1.2) * 50) + 1) for doc in held]
    return positions.ImpactLists(*np.array(rows, dtype=np.int64).T, n_docs), rows


def test_a_search_stops_early_with_the_whole_answer():
    rng = np.random.default_rng(6)
    read = whole = 0
    for _ in range(40):
        lists, rows = shard_of(rng, 600, 8)
        names = np.sort(rng.choice(8, 3, replace=False))
        totals = Counter()
        for term, doc, impact in rows:
            if term in names:
                totals[doc] += impact
        result = lists.best(names, 10, step=4)
        least = sorted(totals.values())[-10]
        by_doc = dict(zip(result.docs.tolist(), result.scores.tolist()))
        assert len(by_doc) == len(result.docs)
        assert all(by_doc[doc] == totals[doc] for doc in by_doc)
        # All documents at or above the k-th score are there.
        assert {doc for doc, score in totals.items() if score >= least} <= by_doc.keys()
        read += result.read
        whole += sum(term in names for term, _, _ in rows)
    assert read < 0.6 * whole


def test_documents_tied_with_the_last_place_are_all_found():
    rows = [(term, doc, 10) for term in range(2) for doc in range(100)]
    lists = positions.ImpactLists(*np.array(rows, dtype=np.int64).T, 100)
    assert len(lists.best(np.array([0, 1]), 5).docs) == 100
