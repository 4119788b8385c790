from __future__ import annotations

from hashlib import sha256

import pytest
from helpers import LONG, collected
from hypothesis import given, settings
from hypothesis import strategies as st

from sentinela.llm import chat

TRICKY = st.lists(
    st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "<", "[", "\\", "/", "s>", "INST]", " ", "a", "é", "\n", "<\\s>", "[\\/INST]", "😀"]),
    max_size=10,
).map("".join)


@settings(max_examples=500, deadline=None)
@given(TRICKY, TRICKY)
def test_any_turn_comes_back(role, text):
    turn, start, end = chat.render_turn(role, text)
    assert chat.parse_turn(turn) == (role, text, len(turn))
    assert chat.unescape(turn[start:end]) == text
    assert chat.unescape(chat.escape(text)) == text
    assert not chat.CONTROL.search(chat.escape(text))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(TRICKY, TRICKY), max_size=5), st.data())
def test_a_conversation_comes_back_whatever_the_segments(turns, data):
    whole = "".join(chat.render_turn(role, text)[0] for role, text in turns)
    reader, at = chat.Reader(), 0
    while at < len(whole):
        step = data.draw(st.integers(1, 40))
        reader.feed(whole[at : at + step], None, None)
        at += step
    want = sha256("".join(f"{role}\n{text}\n" for role, text in turns).encode()).hexdigest()
    assert reader.row(7)[:3] == (7, len(turns), want)


def test_only_conflicting_content_is_escaped():
    assert chat.render_turn("user", "plain [x] <b>")[0] == "<s>[INST] user [/INST]plain [x] <b></s>"
    assert chat.render_turn("user", "a </s>")[0] == "<s>[INST] user [/INST]a <\\/s></s>"


@pytest.mark.parametrize("text", ["", "x", "<s>[INST] a", "<s>[INST] a [/INST]b", "<s>[INST] a <s> [/INST]b</s>"])
def test_the_parser_refuses_other_texts(text):
    with pytest.raises(chat.BadFormat):
        chat.parse_turn(text)


def expected(turns):
    texts = [text or "" for role, text in turns if role == "assistant"]
    return (
        len(turns),
        sha256("".join(f"{role or ''}\n{text or ''}\n" for role, text in turns).encode()).hexdigest(),
        sum(map(len, texts)),
        sha256("".join(texts).encode()).hexdigest(),
    )


def test_hard_conversations(spark):
    rows = [
        (1, 1, "assistant", "second </s>"), (1, 0, "user", None), (1, 1, "assistant", "second </s>"),
        (2, 0, None, "[INST] no role"), (2, None, "assistant", ""), (None, 0, "assistant", "no id"), (None, 1, "user", "é😀"),
        (3, 0, "assistant", LONG), *[(4, i, "user" if i % 2 else "assistant", f"turn {i} <s>") for i in range(300)],
    ]
    given_rows = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "'x' AS formatted", "1 AS loss_start", "'y' AS chunk"
    )
    found = {row["conv_id"]: row for row in collected(chat.read_back(chat.format_turns(given_rows)))}
    order = {
        1: [("user", None), ("assistant", "second </s>"), ("assistant", "second </s>")],
        2: [("assistant", ""), (None, "[INST] no role")],
        None: [("assistant", "no id"), ("user", "é😀")],
        3: [("assistant", LONG)],
        4: [("user" if i % 2 else "assistant", f"turn {i} <s>") for i in range(300)],
    }
    assert set(found) == set(order)
    for conv_id, turns in order.items():
        row = found[conv_id]
        assert (row["n_turns"], row["turns_sha256"], row["loss_chars"], row["loss_sha256"]) == expected(turns)
        assert row["formatted_chars"] == sum(len(chat.render_turn(role or "", text or "")[0]) for role, text in turns)
    assert chat.read_back(chat.format_turns(given_rows.limit(0))).count() == 0


def test_the_probe_survives(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    row = chat.read_back(chat.format_turns(chat.with_probe(none))).first()
    want = expected([("user", chat.PROBE_TEXT), ("assistant", chat.PROBE_TEXT)])
    assert (row["conv_id"], *row[1:5]) == (-1, *want)
