from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from helpers import HARD, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sentinela.llm import packing

EXACT = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return [*EXACT.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def check_pieces(pieces, texts, size):
    """Every id in one piece, pieces gapless in sequences no longer than the size."""
    covered, sequences = {}, {}
    for piece in pieces:
        ids = texts[piece["doc_id"]]
        own = ids[piece["start"] : piece["start"] + piece["length"]]
        assert len(own) == piece["length"] > 0 and piece["doc_tokens"] == len(ids)
        assert piece["ids_crc32"] == zlib.crc32(np.asarray(own, dtype="<u4").tobytes())
        covered.setdefault(piece["doc_id"], []).append((piece["start"], piece["length"]))
        sequences.setdefault(piece["sequence_id"], []).append(piece)
    for parts in sequences.values():
        at = 0
        for piece in sorted(parts, key=lambda piece: piece["offset"]):
            assert piece["offset"] == at
            at += piece["length"]
        assert at <= size and {piece["sequence_length"] for piece in parts} == {at}
    return covered, [sum(piece["length"] for piece in parts) for parts in sequences.values()]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_the_fast_encoder_gives_the_vocabulary_files_ids(text):
    assert packing.byte_bpe()([text]) == [ids_of(text)[:-1]]


def test_the_special_string_is_what_the_vocabulary_file_says():
    text = f"a {packing.SPECIAL} b"
    assert packing.byte_bpe()([text]) == [ids_of(text)[:-1]]


def test_hard_documents(spark):
    rows = [row for row in HARD if row != HARD[1]]
    pieces = packing.pack(documents(spark, rows)).collect()
    own = [piece.asDict() for piece in pieces if piece["doc_id"] is not None]
    texts = {row[0]: ids_of(row[1]) for row in rows if row[0] is not None}
    covered = {}
    for piece in own:
        covered.setdefault(piece["doc_id"], []).append((piece["start"], piece["length"]))
    for doc_id, ids in texts.items():
        at = 0
        for start, length in sorted(covered[doc_id]):
            assert start == at
            at += length
        assert at == len(ids)
    assert sum(piece["length"] for piece in pieces if piece["doc_id"] is None) == len(ids_of(HARD[3][1])) + 1


def test_repeated_rows_are_packed_each_and_empty_tables_give_nothing(spark):
    assert packing.pack(documents(spark, [HARD[0], HARD[0]])).count() == 2
    assert packing.pack(documents(spark, [])).count() == 0


def test_little_padding_and_whole_coverage(spark):
    rows = [(i, "some words " * (i * 37 % 400 + 1), "en", "a", 1) for i in range(300)]
    pieces = [piece.asDict() for piece in packing.pack(documents(spark, rows).coalesce(1), size=256).collect()]
    covered, lengths = check_pieces(pieces, {row[0]: ids_of(row[1]) for row in rows}, 256)
    assert set(covered) == set(range(300))
    assert sum(length < 256 for length in lengths) <= 1


def level_by_definition(levels, length, size):
    """The level after which the sum of squares over partial windows is smallest, fullest first."""
    best = None
    for level in range(size - length, -1, -1):
        if level and not levels[level]:
            continue
        after = levels.copy()
        if level:
            after[level] -= 1
        after[level + length] += 1
        cost = int((after[1:size] ** 2).sum())
        if best is None or cost < best[0]:
            best = (cost, level)
    return best[1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 15), min_size=1, max_size=80))
def test_pieces_go_where_the_sum_of_squares_is_smallest(lengths):
    packer = packing.Packer(16, 0)
    for number, length in enumerate(lengths):
        assert packer.level_for(length) == level_by_definition(packer.levels, length, 16)
        packer.add(number, [0] * length)
        assert [len(windows) for windows in packer.open[1:]] == packer.levels[1:16].tolist()
    packer.finish()
    assert sum(row[2] for row in packer.out) == sum(lengths)
