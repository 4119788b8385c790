from __future__ import annotations

import random

import numpy as np
from helpers import HARD, documents

from sentinela.llm import oddsketch


def shingles(text, width=4):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {b" ".join(words[i : i + width]) for i in range(len(words) - width + 1)} or {b" ".join(words)}


def by_definition(rows):
    """(doc_id, set size, smallest reachable id) by brute force over all pairs."""
    sets = [shingles(text) for _, text in rows]
    least = [doc_id for doc_id, _ in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    changed = True
    while changed:
        changed = False
        for i, j in links:
            low = min((x for x in (least[i], least[j]) if x is not None), default=None)
            changed |= least[i] != low or least[j] != low
            least[i] = least[j] = low
    return sorted(((doc_id, len(s), root) for (doc_id, _), s, root in zip(rows, sets, least)), key=str)


def found(rows):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows), key=str)


def family(rng, base, n, most):
    """The words with up to ``most`` of them changed, n times."""
    out = []
    for _ in range(n):
        words = list(base)
        for place in rng.sample(range(len(words)), rng.randint(0, most)):
            words[place] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def corpus(seed=5):
    rng = random.Random(seed)
    texts = []
    for group in range(6):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([12, 60, 200]))]
        texts += family(rng, base, 12, max(1, len(base) // 14))
    texts += [" ".join(f"w{rng.randrange(3000)}" for _ in range(40)) for _ in range(20)]
    texts += texts[:5] + [texts[0].upper() + "  ", "one two", "ONE\ttwo", "one"]
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_equal_to_brute_force(spark):
    rows = corpus()
    docs = documents(spark, [(i, text, None, None, None) for i, text in rows])
    got = oddsketch.near_duplicates(docs).collect()
    assert found(got) == by_definition(rows)
    assert len({r["component_id"] for r in got}) < len(got)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_shards_do_not_change_the_result(spark):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(80)]
    rows = list(enumerate(family(rng, base, 120, 5)))
    docs = documents(spark, [(i, text, None, None, None) for i, text in rows])
    small = oddsketch.Settings(shard_rows=16)
    classes = oddsketch.kept(
        oddsketch.signatures(docs, small).selectExpr("node", "size", "keys"), "t"
    )
    assert oddsketch.shared_buckets(classes, small).where("shards > 1").count() > 0
    want = by_definition(rows)
    assert found(oddsketch.near_duplicates(docs, small).collect()) == want
    assert found(oddsketch.near_duplicates(docs, oddsketch.Settings(shard_shingles=500)).collect()) == want


def test_hard_documents(spark):
    got = oddsketch.near_duplicates(documents(spark)).collect()
    assert len(got) == len(HARD)
    want = by_definition([(doc_id, text) for doc_id, text, *_ in HARD])
    assert found(got) == want
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    # Empty texts are linked with nothing; letters of another case are the same words.
    assert [by_id[i]["component_id"] for i in (2, 3, 4)] == [2, 3, 4]
    assert by_id[6]["component_id"] == 1 and not by_id[6]["kept"]
    assert all(r["component_id"] is None and r["kept"] for r in got if r["doc_id"] is None)
    assert oddsketch.near_duplicates(documents(spark, [])).count() == 0


def test_a_row_without_id_links_others(spark):
    words = [f"w{i}" for i in range(40)]
    rows = [(7, " ".join(words)), (None, " ".join(words[2:] + ["x"])), (9, " ".join(words[4:] + ["x", "y"]))]
    docs = documents(spark, [(i, text, None, None, None) for i, text in rows])
    assert found(oddsketch.near_duplicates(docs).collect()) == by_definition(rows)


def test_sketches_estimate_and_hardly_ever_miss():
    settings = oddsketch.Settings()
    keys = oddsketch.sample_keys(settings.samples)
    rng = np.random.default_rng(2)
    limit = oddsketch.most_differing(settings)
    for level in (0.8, 0.9, 0.98):
        off, far = [], 0
        for _ in range(150):
            common = rng.integers(0, 2**63, round(500 * level), dtype=np.uint64)
            own = rng.integers(0, 2**63, 500 - len(common), dtype=np.uint64)
            half = len(own) // 2
            least = np.stack([oddsketch.minima(np.concatenate([common, part]), keys) for part in (own[:half], own[half:])])
            one, two = oddsketch.odd_sketches(least, settings.bits)
            differing = int(np.bitwise_count(one ^ two).sum())
            far += differing > limit
            off.append(float(oddsketch.estimate(differing, settings)) - len(common) / (len(common) + len(own)))
        assert far == 0
        assert abs(np.mean(off)) < 0.01 and np.std(off) < 0.04
    # The closer the pair, the closer the estimate.
    assert np.std(off) < 0.015


def test_far_pairs_fail_the_sketch_test():
    settings = oddsketch.Settings()
    keys = oddsketch.sample_keys(settings.samples)
    rng = np.random.default_rng(3)
    passed = 0
    for _ in range(100):
        common = rng.integers(0, 2**63, 150, dtype=np.uint64)
        least = np.stack([oddsketch.minima(np.concatenate([common, rng.integers(0, 2**63, 75, dtype=np.uint64)]), keys) for _ in range(2)])
        one, two = oddsketch.odd_sketches(least, settings.bits)
        passed += int(np.bitwise_count(one ^ two).sum()) <= oddsketch.most_differing(settings)
    assert passed == 0  # similarity 0.5


def test_runs_of_keys_are_never_divided():
    rng = np.random.default_rng(5)
    rows = oddsketch.pd.DataFrame({"a": np.sort(rng.integers(0, 30, 400)), "v": np.arange(400)})
    for cuts in ([], [1, 2, 3], list(range(10, 400, 7)), list(rng.choice(400, 90))):
        batches = [oddsketch.pd.DataFrame(part, columns=["a", "v"]) for part in np.split(rows.to_numpy(), sorted(cuts))]
        parts = list(oddsketch.whole_groups(batches, ["a"]))
        assert [v for part in parts for v in part["v"]] == list(range(400))
        seen = [set(part["a"]) for part in parts]
        assert all(not one & two for i, one in enumerate(seen) for two in seen[:i])
    one, two = oddsketch.pairs_within(np.array([0, 5]), np.array([3, 2]))
    assert list(zip(one.tolist(), two.tolist())) == [(0, 1), (0, 2), (1, 2), (5, 6)]


def test_sets_by_definition():
    powers = oddsketch.Powers()
    texts = ["", " \t", "one", "One two THREE", "a b c d e f", "x " * 50, HARD[5][1], HARD[9][1], "É é K K \x1c a\x00b"]
    sets = [oddsketch.shingle_set(text, 4, powers) for text in texts]
    assert [len(members) for members in sets] == [len(shingles(text)) for text in texts]
    assert set(oddsketch.shingle_set("A b\nC  d e", 4, oddsketch.Powers())) == set(oddsketch.shingle_set("z a b c d e", 4, powers)) - set(
        oddsketch.shingle_set("z a b c", 4, powers)
    )
    for length in (1, 7, 1000):
        assert all(np.array_equal(oddsketch.shingle_set(text, 4, powers, length), members) for text, members in zip(texts, sets))
    words = {oddsketch.shingle_set(f"w{i}", 4, powers)[0] for i in range(20000)}
    assert len(words) == 20000
