"""Katz backoff bigram model: Good-Turing discounts, exactly normalised backoff weights.

Documents are tokenised into chunks. What chunks and the tables of the model tell each other are
packed columns, one row per chunk and table partition, so that a word or pair is moved once per chunk
and not once per token:

    chunk -> word partition   its words and their training counts
    word partition -> chunk   the words' numbers and counts in the whole corpus
    chunk -> pair partition   its pairs (previous word, word) and their training counts
    pair partition -> chunk   the pairs' counts, and what the backoff weight of each context needs

Then a chunk scores its tokens by itself. Tables are partitioned by the previous word; the pairs of
the few most frequent contexts are spread over all partitions. All that reaches the driver are counts
of counts and the most frequent contexts, whose number the partitions bound.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from sentinela.llm.common import fold_of, in_groups, kept, lower_words, text_of

# Tokens after which a chunk closes; it bounds a task's memory, results do not depend on it.
CHUNK_TOKENS = 2_000_000
# The token behind the last word; words are never empty. The context of the first token.
END = b""
FIRST = -1
# Counts up to this one are discounted.
DISCOUNTED = 5
# A context is spread over all pair partitions if it has more than this share of an even one.
SPREAD_SHARE = 0.25

ROW = "kind string, chunk long, part int, tokens long, a binary, b binary, c binary, d binary, e binary, f binary"
NAMES = [field.split()[0] for field in ROW.split(", ")]


def pack(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes, no wider than the largest needs."""
    bits = np.ascontiguousarray(values).astype("<u8") if values.dtype.kind != "f" else values.astype("<f8").view("<u8")
    width = max(1, (int(bits.max()).bit_length() + 7) // 8) if len(bits) else 1
    planes = bits.view(np.uint8).reshape(-1, 8)[:, :width].T
    return zstandard.compress(bytes([width]) + planes.tobytes(), 1)


def unpack(data: bytes, kind: str = "<i8") -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), dtype=np.uint8)
    width = int(raw[0])
    planes = raw[1:].reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, :width] = planes.T
    return out.reshape(-1).view(kind)


def pack_rising(values: np.ndarray) -> bytes:
    """Numbers that do not fall, as their steps."""
    return pack(np.diff(values.astype(np.uint64), prepend=np.uint64(0)))


def unpack_rising(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, "<u8"), dtype=np.uint64)


def message(kind: str, chunk: int, part: int, tokens: int, *columns: bytes) -> tuple:
    return (kind, chunk, part, tokens, *columns, *[None] * (6 - len(columns)))


def frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=NAMES)


# Discounts


@dataclass(frozen=True)
class Discounts:
    """What a count is worth after Good-Turing discounting.

    ``ratios[r]`` is Katz's ratio for count r up to the last discounted one; larger counts keep their
    value. Where the counts of counts give no valid ratio for any range, every count loses ``flat``.
    """

    ratios: tuple[float, ...] = (0.0,)
    flat: float = 0.0

    def worth(self, counts: np.ndarray) -> np.ndarray:
        counts = np.asarray(counts, dtype=float)
        if self.flat:
            return np.maximum(0.0, counts - self.flat)
        small = counts < len(self.ratios)
        return counts * np.where(small, np.asarray(self.ratios)[np.where(small, counts, 0).astype(int)], 1.0)


def good_turing(of_counts: np.ndarray, limit: int = DISCOUNTED) -> Discounts:
    """Discounts from n_1 .. n_(limit + 1), the numbers of things seen so often.

    The limit falls until every ratio lies in (0, 1); without any valid limit half a count goes.
    """
    n = [0.0, *map(float, of_counts)]
    for last in range(min(limit, len(n) - 2), 0, -1):
        if any(n[r] <= 0 for r in range(1, last + 2)):
            continue
        cut = (last + 1) * n[last + 1] / n[1]
        if cut >= 1:
            continue
        ratios = [((r + 1) * n[r + 1] / (r * n[r]) - cut) / (1 - cut) for r in range(1, last + 1)]
        if all(0 < ratio < 1 for ratio in ratios):
            return Discounts((0.0, *ratios))
    return Discounts(flat=0.5)


@dataclass(frozen=True)
class Unigrams:
    """The lowest level: known words by discounted count, all unknown ones together the rest."""

    tokens: int
    words: int
    discounts: Discounts
    unknown: float

    def probability(self, counts: np.ndarray) -> np.ndarray:
        counts = np.asarray(counts)
        return np.where(counts > 0, self.discounts.worth(counts) / max(1, self.tokens), self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((np.asarray(counts) + 0.1) / (self.tokens + 0.1 * (self.words + 1)))


def unigrams(tokens: int, words: int, of_counts: np.ndarray) -> Unigrams:
    discounts = good_turing(of_counts)
    if not tokens:
        return Unigrams(0, 0, discounts, 1.0)
    if discounts.flat:
        lost = discounts.flat * words
    else:
        seen = np.arange(1, len(of_counts) + 1)
        lost = float(((seen - discounts.worth(seen)) * of_counts).sum())
    return Unigrams(tokens, words, discounts, lost / tokens)


# Contexts: for each previous word the numbers of followers seen 1 .. DISCOUNTED times, the number
# and sum of the larger counts, and the followers' unigram probability.

CONTEXT_WIDTH = DISCOUNTED + 2


def context_sums(prev: np.ndarray, counts: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of the contexts in sorted pairs, their whole-number sums, their followers' lower probability."""
    starts = np.flatnonzero(np.concatenate([[True], prev[1:] != prev[:-1]])) if len(prev) else np.zeros(0, dtype=int)
    if not len(starts):
        return starts, np.zeros((0, CONTEXT_WIDTH), dtype=np.int64), np.zeros(0)
    big = counts > DISCOUNTED
    columns = [np.add.reduceat((counts == r).astype(np.int64), starts) for r in range(1, DISCOUNTED + 1)]
    columns += [np.add.reduceat(big.astype(np.int64), starts), np.add.reduceat(np.where(big, counts, 0), starts)]
    return starts, np.stack(columns, axis=1), np.add.reduceat(np.where(counts > 0, lower, 0.0), starts)


@dataclass(frozen=True)
class Contexts:
    """Backoff of a row of contexts: their training counts, scale of the seen, weight of the unseen."""

    total: np.ndarray
    scale: np.ndarray
    backoff: np.ndarray


def contexts(sums: np.ndarray, lower: np.ndarray, discounts: Discounts) -> Contexts:
    """The seen followers keep their discounted share; the rest goes to the others by lower level.

    Where no follower is discounted, one more count is set aside, so that every word has a chance.
    """
    small = np.arange(1, DISCOUNTED + 1)
    total = sums[:, :DISCOUNTED] @ small + sums[:, -1]
    kept_mass = sums[:, :DISCOUNTED] @ discounts.worth(small) + sums[:, -1] - discounts.flat * sums[:, -2]
    share = kept_mass / np.maximum(total, 1)
    full = share > 1 - 1e-12
    scale = np.where(full, total / (total + 1.0), 1.0)
    backoff = (1 - share * scale) / np.maximum(1 - lower, 1e-300)
    return Contexts(total, scale, np.where(total > 0, backoff, 1.0))


# Chunks


class Chunk:
    """Tokens of some documents by a vocabulary of their own."""

    def __init__(self):
        self.vocabulary: defaultdict[bytes, int] = defaultdict()
        self.vocabulary.default_factory = self.vocabulary.__len__
        self.streams: list[np.ndarray] = []
        self.docs: list[tuple] = []
        self.size = 0

    def add(self, doc_id, held_out: bool, text: str) -> None:
        words = lower_words(text)
        words.append(END)
        self.streams.append(np.fromiter(map(self.vocabulary.__getitem__, words), dtype=np.uint32, count=len(words)))
        self.docs.append((doc_id is not None, doc_id or 0, held_out, len(words)))
        self.size += len(words)

    def messages(self, number: int, parts: int) -> Iterator[tuple]:
        """The chunk's text, and its words for each word partition, sorted by hash."""
        hashes = np.fromiter(map(xxh64_intdigest, self.vocabulary), dtype=np.uint64, count=len(self.vocabulary))
        part = (hashes % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((hashes, part))
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        stream = np.concatenate(self.streams)
        known, ids, held, lengths = (np.array(column) for column in zip(*self.docs))
        train = np.repeat(~held.astype(bool), lengths)
        counts = np.bincount(stream[train], minlength=len(order))
        yield message(
            "text", number, -1, int(train.sum()),
            pack(stream), pack(place), pack(lengths), pack(ids.astype(np.int64)), pack(known.astype(np.int64)), pack(held.astype(np.int64)),
        )
        ends = np.searchsorted(part[order], np.arange(parts + 1))
        for at in range(parts):
            own = order[ends[at] : ends[at + 1]]
            if len(own):
                yield message("words", number, at, 0, pack_rising(hashes[own]), pack(counts[own]))


def chunked(docs: DataFrame, parts: int, folds: int) -> DataFrame:
    """Chunk texts (kind ``text``) and word messages (kind ``words``)."""

    def tokenise(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        chunk = Chunk()
        for batch in batches:
            for doc_id, held_out, text in zip(batch["doc_id"], batch["held_out"], batch["text"]):
                chunk.add(None if pd.isna(doc_id) else int(doc_id), bool(held_out), text)
                if chunk.size >= CHUNK_TOKENS:
                    yield frame(list(chunk.messages(number, parts)))
                    number, chunk = number + 1, Chunk()
        if chunk.size:
            yield frame(list(chunk.messages(number, parts)))

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (fold_of("doc_id", folds) == 0).alias("held_out"),
        text_of().alias("text"),
    )
    return rows.mapInPandas(tokenise, ROW)


def by_part(rows: DataFrame, work) -> DataFrame:
    """One partition of a table at a time, with the messages of all chunks to it."""
    rows = rows.repartition("part").sortWithinPartitions("part", "chunk")
    return rows.mapInPandas(lambda batches: in_groups(batches, ["part"], work), ROW)


def by_chunk(rows: DataFrame, work, schema: str) -> DataFrame:
    """One chunk at a time, with the messages of all partitions to it."""
    rows = rows.repartition("chunk").sortWithinPartitions("chunk", "kind", "part")
    return rows.mapInPandas(lambda batches: in_groups(batches, ["chunk"], work), schema)


def words_counted(words: DataFrame, parts: int, spread_above: int) -> DataFrame:
    """Messages ``ids`` to the chunks; ``stats`` with counts of counts and the most frequent words."""

    def work(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        hashes = [unpack_rising(data) for data in rows["a"]]
        counts = [unpack(data) for data in rows["b"]]
        distinct, which = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(which, weights=np.concatenate(counts), minlength=len(distinct)).astype(np.int64)
        out, at = [], 0
        for chunk, part in zip(rows["chunk"], hashes):
            own = which[at : at + len(part)]
            at += len(part)
            out.append(message("ids", chunk, key[0], 0, pack_rising(own), pack(total[own])))
        frequent = np.flatnonzero(total > spread_above)
        of_counts = np.bincount(np.minimum(total, DISCOUNTED + 2), minlength=DISCOUNTED + 3)[1 : DISCOUNTED + 2]
        sizes = np.array([(total > 0).sum(), total.sum()])
        out.append(message("stats", -1, key[0], 0, pack(of_counts), pack(sizes), pack(frequent * parts + key[0])))
        return frame(out)

    return by_part(words, work)


class Pairs:
    """The distinct pairs of a chunk, in the order of their messages, and its tokens."""

    def __init__(self, rows: pd.DataFrame, parts: int, spread: np.ndarray):
        text = rows[rows["kind"] == "text"].iloc[0]
        ids = rows[rows["kind"] == "ids"].sort_values("part")
        number = [unpack_rising(data).astype(np.int64) * parts + part for part, data in zip(ids["part"], ids["a"])]
        self.word_id = np.concatenate(number)
        self.word_count = np.concatenate([unpack(data) for data in ids["b"]])
        self.lengths = unpack(text["c"])
        self.doc_ids, self.known, self.held = unpack(text["d"]), unpack(text["e"]).astype(bool), unpack(text["f"]).astype(bool)
        self.current = unpack(text["b"]).astype(np.int32)[unpack(text["a"])]  # places in word_id
        starts = np.cumsum(self.lengths) - self.lengths
        key = np.empty(len(self.current), dtype=np.int64)
        key[1:] = self.current[:-1]
        key[starts] = -1
        key = (key + 1) * len(self.word_id) + self.current
        distinct, which = np.unique(key, return_inverse=True)
        del key
        train = np.repeat(~self.held, self.lengths)
        counts = np.bincount(which[train], minlength=len(distinct))
        place = distinct // len(self.word_id) - 1
        prev = np.where(place < 0, FIRST, self.word_id[place])
        cur = distinct % len(self.word_id)
        part = np.where(np.isin(prev, spread), mixed(prev, self.word_id[cur]), prev) % parts
        order = np.lexsort((self.word_id[cur], prev, part))
        self.part, self.prev, self.cur, self.counts = part[order], prev[order], cur[order], counts[order]
        back = np.empty(len(order), dtype=np.int32)
        back[order] = np.arange(len(order))
        self.which = back[which].astype(np.int32)  # the pair of each token
        self.ends = np.searchsorted(self.part, np.arange(parts + 1))

    def runs(self, part: int) -> tuple[slice, np.ndarray]:
        """The pairs of a partition and the starts of their contexts."""
        own = slice(self.ends[part], self.ends[part + 1])
        prev = self.prev[own]
        return own, np.flatnonzero(np.concatenate([[True], prev[1:] != prev[:-1]])) if len(prev) else np.zeros(0, dtype=int)


def mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A non-negative hash of pairs of numbers."""
    bits = left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ right.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    bits ^= bits >> np.uint64(29)
    return (bits * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(2)).astype(np.int64)


def pair_messages(chunks: DataFrame, parts: int, spread: np.ndarray) -> DataFrame:
    def work(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        pairs = Pairs(rows, parts, spread)
        out = []
        for part in range(parts):
            own, starts = pairs.runs(part)
            if not len(starts):
                continue
            cur = pairs.cur[own]
            sizes = np.diff(starts, append=len(cur))
            out.append(
                message(
                    "pairs", key[0], part, 0, pack(pairs.prev[own][starts] + 1), pack(sizes),
                    pack(pairs.word_id[cur]), pack(pairs.counts[own]), pack(pairs.word_count[cur]),
                )
            )
        return frame(out)

    return by_chunk(chunks, work, ROW)


def pairs_counted(pairs: DataFrame, lowest: Unigrams, spread: np.ndarray) -> DataFrame:
    """Messages ``counts`` to the chunks; ``stats`` with counts of counts; ``spread`` context sums."""

    def work(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        heads = [unpack(data) - 1 for data in rows["a"]]
        prev = [np.repeat(head, unpack(sizes)) for head, sizes in zip(heads, rows["b"])]
        lengths = [len(part) for part in prev]
        prev, cur = np.concatenate(prev), np.concatenate([unpack(data) for data in rows["c"]])
        counts = np.concatenate([unpack(data) for data in rows["d"]])
        lower = np.concatenate([unpack(data) for data in rows["e"]])
        order = np.lexsort((cur, prev))
        prev, cur, counts, lower = prev[order], cur[order], counts[order], lower[order]
        new = np.concatenate([[True], (prev[1:] != prev[:-1]) | (cur[1:] != cur[:-1])])
        starts = np.flatnonzero(new)
        total = np.add.reduceat(counts, starts)
        pair_prev = prev[starts]
        context_at, sums, seen = context_sums(pair_prev, total, lowest.probability(lower[starts]))
        context_ids = pair_prev[context_at]
        per_row = np.empty(len(order), dtype=np.int64)
        per_row[order] = total[np.cumsum(new) - 1]
        out, at = [], 0
        for chunk, head, length in zip(rows["chunk"], heads, lengths):
            place = np.searchsorted(context_ids, head)
            out.append(message("counts", chunk, key[0], 0, pack(per_row[at : at + length]), pack(sums[place].reshape(-1)), pack(seen[place])))
            at += length
        of_counts = np.bincount(np.minimum(total, DISCOUNTED + 2), minlength=DISCOUNTED + 3)[1 : DISCOUNTED + 2]
        hot = np.flatnonzero(np.isin(context_ids, spread))
        out.append(message("stats", -1, key[0], 0, pack(of_counts), pack(context_ids[hot] + 1), pack(sums[hot].reshape(-1)), pack(seen[hot])))
        return frame(out)

    return by_part(pairs, work)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scored(chunks: DataFrame, parts: int, spread: dict, lowest: Unigrams, discounts: Discounts) -> DataFrame:
    """The chunks' documents with their log10 probability under the unigram base and the Katz model."""
    spread_ids = np.array(sorted(spread), dtype=np.int64)
    spread_sums = np.array([spread[i][0] for i in spread_ids], dtype=np.int64).reshape(-1, CONTEXT_WIDTH)
    spread_seen = np.array([spread[i][1] for i in spread_ids], dtype=float)

    def work(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        pairs = Pairs(rows, parts, spread_ids)
        logs = np.zeros(len(pairs.prev))
        told = {part: columns for part, *columns in rows[rows["kind"] == "counts"][["part", "a", "b", "c"]].itertuples(index=False)}
        for part in range(parts):
            own, starts = pairs.runs(part)
            if not len(starts):
                continue
            counts, sums, seen = unpack(told[part][0]), unpack(told[part][1]).reshape(-1, CONTEXT_WIDTH), unpack(told[part][2], "<f8")
            heads = pairs.prev[own][starts]
            hot = np.isin(heads, spread_ids)
            if hot.any():  # a spread context has its sums over all partitions
                place = np.searchsorted(spread_ids, heads[hot])
                sums, seen = sums.copy(), seen.copy()
                sums[hot], seen[hot] = spread_sums[place], spread_seen[place]
            context = contexts(sums, seen, discounts)
            of = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(counts)))
            lower = lowest.probability(pairs.word_count[pairs.cur[own]])
            direct = discounts.worth(counts) * context.scale[of] / np.maximum(context.total[of], 1)
            logs[own] = np.log10(np.where(counts > 0, direct, context.backoff[of] * lower))
        starts = np.cumsum(pairs.lengths) - pairs.lengths
        token_counts = pairs.word_count[pairs.current]
        return pd.DataFrame(
            {
                "doc_id": pd.array(np.where(pairs.known, pairs.doc_ids, 0), dtype="Int64").copy(),
                "held_out": pairs.held,
                "n_tokens": pairs.lengths,
                "n_known": np.add.reduceat((token_counts > 0).astype(np.int64), starts),
                "train_tokens": lowest.tokens,
                "base_score": np.add.reduceat(lowest.base(token_counts), starts),
                "score": np.add.reduceat(logs[pairs.which], starts),
            }
        ).assign(doc_id=lambda out: out["doc_id"].mask(~pairs.known))

    return by_chunk(chunks, work, SCORES)


def katz_scores(docs: DataFrame, folds: int = 10) -> DataFrame:
    """Every document's token counts, unigram base score and Katz score (log10), learnt outside fold 0.

    A text's probability is that of its words and the end, each given the word before. A pair not
    seen in training backs off to the word, an unseen word to the mass that discounts leave.

    Nulls: a null text is empty, so its only token is the end; a null doc_id is held out and stays
    null. Long texts are scored whole. Repeated rows come out each and count each. Without training
    documents all probabilities are 1. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = kept(chunked(docs, parts, folds), "chunks")
    text, words = chunks.where("kind = 'text'"), chunks.where("kind = 'words'")
    tokens = text.agg(F.sum("tokens")).first()[0] or 0
    ids = kept(words_counted(words, parts, int(SPREAD_SHARE * tokens / parts)), "word-ids")
    stats = ids.where("kind = 'stats'").select("a", "b", "c").collect()  # one short row per partition
    of_counts = sum((unpack(row["a"]) for row in stats), np.zeros(DISCOUNTED + 1, dtype=np.int64))
    distinct = sum(int(unpack(row["b"])[0]) for row in stats)
    lowest = unigrams(tokens, distinct, of_counts)
    # At most parts / SPREAD_SHARE words can be above the bound; the first context is always spread.
    spread = np.unique(np.concatenate([[FIRST], *[unpack(row["c"]) for row in stats]]).astype(np.int64))
    told = text.union(ids.where("kind = 'ids'"))
    counts = kept(pairs_counted(pair_messages(told, parts, spread), lowest, spread), "pair-counts")
    stats = counts.where("kind = 'stats'").select("a", "b", "c", "d").orderBy("part").collect()  # as above
    discounts = good_turing(sum((unpack(row["a"]) for row in stats), np.zeros(DISCOUNTED + 1, dtype=np.int64)))
    sums: dict[int, tuple] = {}
    for row in stats:
        own = zip(unpack(row["b"]) - 1, unpack(row["c"]).reshape(-1, CONTEXT_WIDTH), unpack(row["d"], "<f8"))
        for context, whole, seen in own:
            before = sums.get(int(context), (np.zeros(CONTEXT_WIDTH, dtype=np.int64), 0.0))
            sums[int(context)] = (before[0] + whole, before[1] + float(seen))
    for context in spread:
        sums.setdefault(int(context), (np.zeros(CONTEXT_WIDTH, dtype=np.int64), 0.0))
    return scored(told.union(counts.where("kind = 'counts'")), parts, sums, lowest, discounts)
