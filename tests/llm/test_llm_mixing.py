from __future__ import annotations

from fractions import Fraction

import pytest
from helpers import HARD, collected, documents

from sentinela.llm import mixing


def targets_by_definition(sizes):
    """Share by weight, hand out again what exceeds twice a source's size, until none exceeds."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {source: (3, 1, 2)[i % 3] for i, source in enumerate(order)}
    total, full = Fraction(3 * sum(sizes.values()), 2), set()
    while True:
        rest = [s for s in order if s not in full]
        left = total - sum(2 * sizes[s] for s in full)
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        above = {s for s in rest if share[s] > 2 * sizes[s]}
        if not above:
            return {**{s: Fraction(2 * sizes[s]) for s in full}, **share}
        full |= above


def sample(n=400):
    return [
        (i, "w " * (i * 7 % 90), "en", [None, "a", "b", "c", "tiny", "big"][0 if i % 50 == 0 else 5 if i % 3 else i % 5], 1)
        for i in range(n)
    ]


def test_targets_and_takes(spark):
    rows = sample()
    schedule, docs = mixing.mix(documents(spark, rows), block=16)
    found = collected(docs)
    assert len(found) == len(rows)
    sizes, taken = {}, {}
    for row in found:
        sizes[row["source"]] = sizes.get(row["source"], 0) + row["size"]
        taken[row["source"]] = taken.get(row["source"], 0) + row["taken"]
        assert 0 <= row["taken"] <= 2 * row["size"]
    want = targets_by_definition(sizes)
    for row in found:
        assert row["source_size"] == sizes[row["source"]]
        assert row["target"] == pytest.approx(float(want[row["source"]]), rel=1e-12)
    assert taken == {source: int(target) for source, target in want.items()}
    slots = collected(schedule)
    assert sum(slot["words"] for slot in slots) == sum(taken.values())
    per_slot = {}
    for slot in slots:
        key = slot["slot"]
        before = per_slot.setdefault(key, [slot["place"], 0])
        assert before[0] == slot["place"]
        before[1] += slot["words"]
    last = {}
    for slot, (place, words) in sorted(per_slot.items()):
        last[place] = words if place not in last else min(last[place], words)
        assert words <= 16
    # Only the last block of a source may be short.
    assert sum(words < 16 for _, words in per_slot.values()) <= len(last)


def test_every_stretch_of_the_schedule_has_the_sources_in_their_shares(spark):
    schedule, _ = mixing.mix(documents(spark, sample()), block=4)
    order = [row["place"] for row in schedule.select("slot", "place").distinct().orderBy("slot").collect()]
    share = {place: order.count(place) / len(order) for place in set(order)}
    for place in share:
        seen = 0
        for n, own in enumerate(order, 1):
            seen += own == place
            assert abs(seen - share[place] * n) <= 2 + len(order).bit_length()


def test_ranks_follow_the_slots_across_runs(spark, monkeypatch):
    whole = sorted(map(tuple, mixing.mix(documents(spark, sample()), block=8)[0].collect()))
    takes = sorted(map(str, mixing.mix(documents(spark, sample()), block=8)[1].collect()))
    monkeypatch.setattr(mixing, "RUN", 4)
    assert sorted(map(tuple, mixing.mix(documents(spark, sample()), block=8)[0].collect())) == whole
    assert sorted(map(str, mixing.mix(documents(spark, sample()), block=8)[1].collect())) == takes


def test_hard_documents(spark):
    docs = documents(spark)
    found = collected(mixing.mix(docs)[1])
    assert len(found) == len(HARD)
    assert {(row["doc_id"], row["size"]) for row in found} >= {(2, 0), (None, 4), (None, 0), (3, 0), (4, 0), (5, 120_000), (7, 5)}
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    words = {}
    for row in mixed.collect():
        key = (row["doc_id"], row["source"])
        words[key] = words.get(key, 0) + len(row["text"].encode().split())
        if row["n_chars"] is not None and row["doc_id"] in (1, 6):
            assert row["n_chars"] == len(row["text"])
    takes = {}
    for row in found:
        if row["taken"]:
            key = (row["doc_id"], row["source"])
            takes[key] = takes.get(key, 0) + row["taken"]
    assert words == takes
    assert mixing.mix(documents(spark, []))[1].count() == 0 and mixing.mixed(documents(spark, [])).count() == 0
