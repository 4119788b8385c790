from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import HARD, collected, documents
from hypothesis import given
from hypothesis import strategies as st

from sentinela.llm import katz
from sentinela.llm.common import table

END = b""


def discounts(of_counts):
    """Katz's formula, as a function of the count."""
    n = [0, *of_counts]
    for k in range(5, 0, -1):
        if any(n[r] <= 0 for r in range(1, k + 2)) or (k + 1) * n[k + 1] >= n[1]:
            continue
        common = (k + 1) * n[k + 1] / n[1]
        ratio = {r: ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common) for r in range(1, k + 1)}
        if all(0 < value < 1 for value in ratio.values()):
            return lambda count: count * ratio.get(count, 1.0)
    return lambda count: count - 0.5


class Model:
    def __init__(self, texts):
        self.words, followers = Counter(), defaultdict(Counter)
        for tokens in texts:
            self.words.update(tokens)
            for before, word in zip([None, *tokens], tokens):
                followers[before][word] += 1
        self.n, self.followers = sum(self.words.values()), followers
        low = discounts([sum(c == r for c in self.words.values()) for r in range(1, 7)])
        pairs = [c for row in followers.values() for c in row.values()]
        self.high = discounts([sum(c == r for c in pairs) for r in range(1, 7)])
        self.single = {word: low(count) / self.n for word, count in self.words.items()}
        self.unknown = 1 - sum(self.single.values()) if self.n else 1.0

    def probability(self, before, word):
        lower = self.single.get(word, self.unknown)
        row = self.followers.get(before)
        if not row:
            return lower
        total = sum(row.values())
        seen = {w: self.high(c) / total for w, c in row.items()}
        if sum(seen.values()) > 1 - 1e-12:
            seen = {w: p * total / (total + 1) for w, p in seen.items()}
        if word in seen:
            return seen[word]
        return (1 - sum(seen.values())) / (1 - sum(self.single[w] for w in seen)) * lower


def tokens_of(text):
    return [*(text or "").encode().lower().split(), END]


def held(doc_id, folds=10):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % folds == 0


def check(spark, rows, folds=10):
    found = collected(katz.katz_scores(documents(spark, rows), folds))
    assert len(found) == len(rows)
    model = Model([tokens_of(text) for doc_id, text, *_ in rows if not held(doc_id, folds)])
    distinct = len(model.words)
    want = []
    for doc_id, text, *_ in rows:
        tokens = tokens_of(text)
        base = sum(math.log10((model.words[t] + 0.1) / (model.n + 0.1 * (distinct + 1))) for t in tokens)
        score = sum(math.log10(model.probability(b, t)) for b, t in zip([None, *tokens], tokens))
        want.append((str(doc_id), held(doc_id, folds), len(tokens), sum(model.words[t] > 0 for t in tokens), model.n, base, score))
    names = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    got = [(str(row["doc_id"]), *[row[name] for name in names]) for row in found]
    for a, b in zip(sorted(got, key=lambda row: (row[0], row[2], row[6])), sorted(want, key=lambda row: (row[0], row[2], row[6]))):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9, abs=1e-9)
    return model


def sample(spark, n=150):
    rows = table(spark, "/root/testdata/sf0.001", "documents").orderBy("doc_id").limit(n).collect()
    return [(row["doc_id"], row["text"][:1500], "en", "a", 1) for row in rows]


def test_scores_equal_the_definition(spark):
    model = check(spark, sample(spark))
    for before in [None, *list(model.followers)[:40], b"never seen"]:
        total = sum(model.probability(before, word) for word in model.words) + model.probability(before, b"never seen")
        assert total == pytest.approx(1, abs=1e-9)


def test_chunks_partitions_and_spread_contexts_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(katz, "CHUNK_TOKENS", 500)
    monkeypatch.setattr(katz, "SPREAD_SHARE", 0.001)
    check(spark, sample(spark, 80))


def test_hard_documents(spark):
    check(spark, HARD)
    check(spark, HARD[:1], folds=1)  # nothing to learn from
    assert katz.katz_scores(documents(spark, [])).count() == 0


def test_backoff_leaves_every_word_a_chance():
    sums = np.array([[0, 0, 0, 0, 0, 1, 9], [2, 0, 0, 0, 0, 0, 0], [0] * 7])
    parts = katz.contexts(sums, np.array([0.3, 0.2, 0.0]), katz.good_turing(np.array([10, 2, 1, 0, 0, 0])))
    assert (parts.backoff > 0).all() and parts.backoff[2] == 1 and parts.scale[0] == pytest.approx(0.9)


@given(st.lists(st.integers(0, 2**63 - 1), max_size=50))
def test_packed_numbers_come_back(values):
    array = np.array(values, dtype=np.int64)
    assert katz.unpack(katz.pack(array)).tolist() == values
    assert katz.unpack_rising(katz.pack_rising(np.sort(array))).tolist() == sorted(values)
    floats = array.astype(float) / 7
    assert katz.unpack(katz.pack(floats), "<f8").tolist() == floats.tolist()


def test_held_out_text_scores_better_than_by_the_base(spark):
    rows = [row for row in collected(katz.katz_scores(table(spark, "/root/testdata/sf0.001", "documents"))) if row["held_out"]]
    assert sum(row["score"] for row in rows) > sum(row["base_score"] for row in rows)
