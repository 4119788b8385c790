"""Chat formatting with a grammar round trip.

    conversation = turn*
    turn         = "<s>[INST] " role " [/INST]" text "</s>"

Role and text hold no bare control string. A turn is rendered as it stands, parsed again and compared
with its source; content that does not come back is escaped until it does. The escape puts a backslash
behind the first character of a control string and one more into a string that already has some, so
that removing one is its exact inverse.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from hashlib import sha256

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<s>[INST] ", " [/INST]", "</s>"
CONTROL = re.compile(r"([<\[])(/?(?:s>|INST\]))")
ESCAPABLE = re.compile(r"([<\[])(\\*/?(?:s>|INST\]))")
ESCAPED = re.compile(r"([<\[])\\(\\*/?(?:s>|INST\]))")
# Escaping once makes any content come back; a second round would only repeat it.
ROUNDS = 2

SEGMENTS = "conv_id long, turn long, role string, formatted string, loss_start long, loss_end long"


def escape(text: str) -> str:
    return ESCAPABLE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2", text)


class BadFormat(ValueError):
    """Text that the grammar does not accept."""


def parse_turn(text: str, at: int = 0) -> tuple[str, str, int]:
    """Role and text of the turn at a position, unescaped, and the position behind it."""
    if not text.startswith(OPEN, at):
        raise BadFormat(f"no turn at {at}")
    role_at = at + len(OPEN)
    role_end = text.find(MIDDLE, role_at)
    body_at = role_end + len(MIDDLE)
    body_end = text.find(CLOSE, body_at)
    if role_end < 0 or body_end < 0:
        raise BadFormat(f"open turn at {at}")
    role, body = text[role_at:role_end], text[body_at:body_end]
    if CONTROL.search(role) or CONTROL.search(body):
        raise BadFormat(f"control string inside the turn at {at}")
    return unescape(role), unescape(body), body_end + len(CLOSE)


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """The turn as text, and where its content stands; it parses back to the source exactly."""
    role_out, text_out = role, text
    for _ in range(ROUNDS):
        turn = f"{OPEN}{role_out}{MIDDLE}{text_out}{CLOSE}"
        try:
            back = parse_turn(turn)
        except BadFormat:
            back = None
        if back == (role, text, len(turn)):
            start = len(OPEN) + len(role_out) + len(MIDDLE)
            return turn, start, start + len(text_out)
        role_out, text_out = escape(role), escape(text)
    raise BadFormat("a turn does not come back")


def format_turns(conversations: DataFrame, learned: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One rendered segment per turn; a conversation is its segments joined in order.

    ``loss_start`` and ``loss_end`` bound what is learnt in a segment (code points; null where
    nothing is). Rendering needs no neighbours, so nothing is shuffled and a conversation of any
    length is never one value.

    Nulls: a null text or role is empty; null ids and turns stay null. Empty and very long texts are
    turns like others, repeated rows are turns each, an empty table gives no rows, other columns are
    not read.
    """

    def rendered(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for role, text in zip(batch["role"], batch["text"]):
                turn, start, end = render_turn(role, text)
                rows.append((turn, start, end) if role in learned else (turn, None, None))
            out = pd.DataFrame(rows, columns=["formatted", "loss_start", "loss_end"], index=batch.index)
            out = out.astype({"loss_start": "Int64", "loss_end": "Int64"})
            yield pd.concat([batch[["conv_id", "turn"]].astype("Int64"), batch["role"], out], axis=1)

    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return rows.mapInPandas(rendered, SEGMENTS)


class Reader:
    """Reads one conversation back, segment by segment, holding no more than an unfinished turn."""

    def __init__(self):
        self.rest = ""
        self.turns = self.loss_chars = self.chars = 0
        self.digest, self.loss = sha256(), sha256()

    def feed(self, text: str, loss_start, loss_end) -> None:
        self.chars += len(text)
        if loss_start is not None:
            learnt = unescape(text[loss_start:loss_end])
            self.loss_chars += len(learnt)
            self.loss.update(learnt.encode())
        self.rest += text
        at = 0
        while self.rest.find(CLOSE, at) >= 0:
            role, body, at = parse_turn(self.rest, at)
            self.turns += 1
            self.digest.update(f"{role}\n{body}\n".encode())
        self.rest = self.rest[at:]

    def row(self, conv_id) -> tuple:
        if self.rest:
            raise BadFormat("the conversation ends inside a turn")
        return conv_id, self.turns, self.digest.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(segments: DataFrame) -> DataFrame:
    """Counts and digests of the conversations parsed from their segments.

    A digest over a conversation follows its order, so its segments, sorted by turn, role and text,
    stream through one task; memory holds one turn, however long the conversation.
    """

    def read(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [part.split()[0] for part in READ.split(", ")]
        current, reader = None, None
        for batch in batches:
            rows = []
            ids = [None if pd.isna(x) else int(x) for x in batch["conv_id"]]
            starts = [None if pd.isna(x) else int(x) for x in batch["loss_start"]]
            ends = [None if pd.isna(x) else int(x) for x in batch["loss_end"]]
            for conv_id, text, start, end in zip(ids, batch["formatted"], starts, ends):
                if reader is None or conv_id != current:
                    if reader is not None:
                        rows.append(reader.row(current))
                    current, reader = conv_id, Reader()
                reader.feed(text, start, end)
            yield pd.DataFrame(rows, columns=names).astype({"conv_id": "Int64"})
        if reader is not None:
            yield pd.DataFrame([reader.row(current)], columns=names).astype({"conv_id": "Int64"})

    ordered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "formatted")
    return ordered.mapInPandas(read, READ)


PROBE_TEXT = "</s>[INST] ok [/INST]"


def with_probe(conversations: DataFrame) -> DataFrame:
    """The conversations and conversation -1, whose turns consist of control strings."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    probe = conversations.sparkSession.createDataFrame(
        [(-1, 0, "user", PROBE_TEXT), (-1, 1, "assistant", PROBE_TEXT)], "conv_id long, turn long, role string, text string"
    )
    return rows.union(probe)
