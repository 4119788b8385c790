"""Sum-of-squares online packing of tokenised documents into training sequences."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentinela.llm.common import text_of

# The separator between documents, and the one string the vocabulary file marks special.
END_ID = 0
SPECIAL = "<|endoftext|>"

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "sequence_length long"
)

Encoder = Callable[[list[str]], list[list[int]]]


def byte_bpe(vocabulary: str | None = None, ranks: str | None = None) -> Encoder:
    """Encoder of a byte-level BPE vocabulary.

    The rank file holds the same vocabulary and its library is four times as fast; both give the
    same ids for every text without the special string, which goes to the vocabulary file itself.
    """
    import public_tokenizers
    import tiktoken.registry

    ranks = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
    # The library's own list of encodings outlives the task, so a Python worker reads the file once.
    known = tiktoken.registry.ENCODINGS
    if ranks not in known:
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        known[ranks] = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={}
        )
    fast = known[ranks]

    loaded = []

    def exact(text: str) -> list[int]:
        from tokenizers import Tokenizer

        if not loaded:
            loaded.append(Tokenizer.from_file(vocabulary or public_tokenizers.path("byte_bpe_50k.json")))
        return loaded[0].encode(text, add_special_tokens=False).ids

    return lambda texts: [exact(text) if SPECIAL in text else fast.encode_ordinary(text) for text in texts]


class Packer:
    """Online packing into windows of ``size`` tokens.

    ``levels[h]`` counts the partially filled windows of fill level ``h``. A piece of ``s`` tokens
    goes to the level (0: a new window) after which the sum of the squared counts is smallest; ties
    go to the fullest level. A document longer than a window first fills whole windows of its own.
    Pieces leave when their window is full, so memory holds the open windows only. At the end the
    open windows are poured together, which leaves at most one window that needs padding.
    """

    def __init__(self, size: int, first_id: int):
        self.size = size
        self.next_id = first_id
        self.levels = np.zeros(size + 1, dtype=np.int64)
        self.open: list[list[list]] = [[] for _ in range(size)]
        self.out: list[tuple] = []

    def emit(self, window: list) -> None:
        length = sum(len(piece[2]) for piece in window)
        offset = 0
        for doc_id, start, ids, total in window:
            crc = zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())
            self.out.append((doc_id, start, len(ids), crc, total, self.next_id, offset, length))
            offset += len(ids)
        self.next_id += 1

    def level_for(self, length: int) -> int:
        """The fill level whose window takes the piece."""
        last = self.size - length
        counts = self.levels
        change = np.full(last + 1, np.iinfo(np.int64).max)
        usable = np.flatnonzero(counts[1 : last + 1]) + 1
        # Twice (count at the new level - count at the old one), plus 2; closed windows do not count.
        change[usable] = 2 * (counts[usable + length] - counts[usable]) + 2
        change[0] = 2 * counts[length] + 1
        if counts[last] and last:
            change[last] = 1 - 2 * counts[last]
        return last - int(np.argmin(change[::-1]))

    def place(self, piece: tuple) -> None:
        length = len(piece[2])
        level = self.level_for(length)
        window = self.open[level].pop() if level else []
        if level:
            self.levels[level] -= 1
        window.append(piece)
        if level + length == self.size:
            self.emit(window)
        else:
            self.open[level + length].append(window)
            self.levels[level + length] += 1

    def add(self, doc_id, ids: list[int]) -> None:
        total = len(ids)
        whole = total - total % self.size
        for start in range(0, whole, self.size):
            self.emit([(doc_id, start, ids[start : start + self.size], total)])
        if whole < total:
            self.place((doc_id, whole, ids[whole:], total))

    def finish(self) -> None:
        """Pour the open windows, fullest first, into as few as they need."""
        window: list[tuple] = []
        room = self.size
        for level in range(self.size - 1, 0, -1):
            for waiting in self.open[level]:
                for doc_id, start, ids, total in waiting:
                    while ids:
                        window.append((doc_id, start, ids[:room], total))
                        taken = len(window[-1][2])
                        start, ids, room = start + taken, ids[taken:], room - taken
                        if not room:
                            self.emit(window)
                            window, room = [], self.size
        if window:
            self.emit(window)

    def taken(self) -> pd.DataFrame:
        rows, self.out = self.out, []
        return pd.DataFrame(rows, columns=[field.split()[0] for field in PIECES.split(", ")]).astype({"doc_id": "Int64"})


def pack(docs: DataFrame, size: int = 1024, encoder: Callable[[], Encoder] = byte_bpe) -> DataFrame:
    """Pieces of documents in sequences of at most ``size`` tokens.

    Tokenising and packing happen where a document is read: no shuffle, one pass, and each
    partition leaves at most one sequence to pad (``sequence_length`` below ``size``). The sequence
    id holds the partition in its upper bits.

    Nulls: a null text is empty, so the document is its end id alone; a null doc_id stays null.
    Very long texts fill whole windows. Repeated rows are packed each for itself. An empty table
    gives no rows; other columns are not read.
    """

    def packed(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        packer = Packer(size, (context.partitionId() if context else 0) << 40)
        encode = encoder()
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                keys = [None if pd.isna(key) else int(key) for key in part["doc_id"]]
                for key, ids in zip(keys, encode(part["text"].tolist())):
                    packer.add(key, [*ids, END_ID])
            if packer.out:
                yield packer.taken()
        packer.finish()
        if packer.out:
            yield packer.taken()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInPandas(packed, PIECES)
