"""Ranked lexical search by best positions in impact lists."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from sentinela.llm.common import kept, text_of

# Documents of one index shard and items of one block: what a task holds. Results do not depend on them.
SHARD = 4096
ITEM_BLOCK = 256
# The items' vocabulary travels to the scan up to this many words; beyond it the scan keeps all words.
MOST_WORDS = 500_000
SEED = 13

# Letters, digits and all bytes from 0x80 make terms; A-Z become a-z and all else separates.
TERM_BYTES = bytes(
    code + 32 if 65 <= code <= 90 else code if 48 <= code <= 57 or 97 <= code <= 122 or code >= 128 else 32 for code in range(256)
)


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TERM_BYTES).split()


def term_key(word: bytes) -> int:
    """Signed 64-bit hash of a term."""
    value = xxh64_intdigest(word, SEED)
    return value - (1 << 64) if value >> 63 else value


def item_terms(items: DataFrame) -> DataFrame:
    """``item``, ``item_id``, ``word`` and ``term`` for the distinct terms of every item."""

    def made(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (item, item_id, word, term_key(word))
                for item, item_id, text in zip(batch["item"], batch["item_id"].astype("Int64"), batch["text"])
                for word in sorted(set(terms(text)))
            ]
            frame = pd.DataFrame(rows, columns=["item", "item_id", "word", "term"])
            yield frame.astype({"item_id": "Int64"})

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text")).distinct()
    rows = rows.select(F.concat_ws(":", F.col("item_id").cast("string"), F.md5(F.col("text").cast("binary"))).alias("item"), "*")
    return rows.mapInPandas(made, "item string, item_id long, word binary, term long")


def postings(docs: DataFrame, wanted: set[bytes] | None) -> DataFrame:
    """``place`` (a number that spreads rows evenly), ``doc_id``, ``n`` terms, and ``terms`` with their ``tfs``.

    Only documents with a term; of their terms only those wanted.
    """

    def made(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = TaskContext.get().partitionId() << 40
        keys = None if wanted is None else {word: term_key(word) for word in wanted}
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"].astype("Int64"), batch["text"]):
                words = terms(text)
                if not words:
                    continue
                counts = Counter(words)
                found = counts.keys() if keys is None else counts.keys() & keys.keys()
                named = [term_key(word) if keys is None else keys[word] for word in found]
                rows.append((place, doc_id, len(words), named, [counts[word] for word in found]))
                place += 1
            if rows:
                yield pd.DataFrame(rows, columns=["place", "doc_id", "n", "terms", "tfs"]).astype({"doc_id": "Int64"})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInPandas(made, "place long, doc_id long, n long, terms array<long>, tfs array<long>")


class Found(NamedTuple):
    docs: np.ndarray
    scores: np.ndarray
    # Documents scored, and list places read in order.
    scored: int
    read: int


class ImpactLists:
    """Impact lists of one shard: a list per term, largest impact first, with direct access by document."""

    def __init__(self, terms: np.ndarray, docs: np.ndarray, impacts: np.ndarray, size: int):
        self.names, numbers = np.unique(terms, return_inverse=True)
        numbers = numbers.reshape(-1)
        order = np.lexsort((docs, -impacts, numbers))
        self.docs, self.impacts = docs[order], impacts[order]
        self.starts = np.searchsorted(numbers[order], np.arange(len(self.names) + 1))
        self.size = size
        keys = numbers[order] * size + self.docs
        self.spots = np.argsort(keys, kind="stable")
        self.keys = keys[self.spots]

    def direct(self, lists: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each document in each list (lists by documents), and whether it is there."""
        asked = lists[:, None] * self.size + docs[None, :]
        near = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        return self.spots[near], self.keys[near] == asked

    def best(self, names: np.ndarray, k: int, step: int = 16) -> Found:
        """Every document that can be among the k best, by the best position algorithm.

        Each round reads the next places of all lists in order and looks up every document found in
        the other lists, which marks its places there as seen. A list's best position is the last
        place up to which all places are seen. What is not seen yet scores at most the sum of the
        impacts at the best positions; the search stops when that is strictly below the k-th score,
        so that documents tied with it are all there. ``step`` doubles from round to round.
        """
        lists = np.flatnonzero(np.isin(self.names, names))
        starts, ends = self.starts[lists], self.starts[lists + 1]
        offsets = np.concatenate([[0], np.cumsum(ends - starts)])
        seen = np.zeros(offsets[-1], dtype=bool)
        best = np.zeros(len(lists), dtype=np.int64)
        scored = np.zeros(self.size, dtype=bool)
        docs, scores = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
        depth = read = 0
        while len(lists):
            nexts = [
                self.docs[start + depth : min(start + depth + step, end)] for start, end in zip(starts.tolist(), ends.tolist()) if start + depth < end
            ]
            if not nexts:
                break
            found = np.concatenate(nexts)
            read += len(found)
            depth += step
            step *= 2
            found = np.unique(found[~scored[found]])
            if len(found):
                scored[found] = True
                places, there = self.direct(lists, found)
                docs.append(found)
                scores.append(np.where(there, self.impacts[places], 0).sum(axis=0))
                seen[(places - starts[:, None] + offsets[:-1, None])[there]] = True
            bound = 0
            for i, (begin, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                if best[i] < end - begin:
                    rest = seen[begin + best[i] : end]
                    gap = int(rest.argmin())
                    best[i] += len(rest) if rest[gap] else gap
                if best[i] < end - begin:
                    bound += int(self.impacts[starts[i] + best[i] - 1])
            if bound == 0:
                break
            so_far = np.concatenate(scores)
            if len(so_far) >= k and np.partition(so_far, len(so_far) - k)[len(so_far) - k] > bound:
                break
        return Found(np.concatenate(docs), np.concatenate(scores), int(scored.sum()), read)


def search(
    docs: DataFrame, items: DataFrame, k: int = 50, shard: int = SHARD, item_block: int = ITEM_BLOCK, most_words: int = MOST_WORDS
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the k best documents with a score above 0 for each item.

    Documents are dealt to shards, whose impact lists hold the terms of the items; a task holds one
    shard and one block of items, and gives the k best of its shard for each. Counts (documents,
    terms, documents of a term) are over the whole table.

    Nulls: a null text has no terms; a null doc_id ranks behind the same score with an id; a null
    item_id is an item. Repeated documents rank each. An item row that repeats another's id and text
    counts once; rows of one item_id with different texts are ranked each on its own. Items and
    documents without terms give no rows, nor do empty tables. Other columns are not read.
    """
    asked = kept(item_terms(items), "items")
    words = asked.select("word").distinct().limit(most_words + 1).collect()
    wanted = {bytes(row["word"]) for row in words} if len(words) <= most_words else None
    rows = kept(postings(docs, wanted), "postings")
    count, length = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    blocks = max(1, -(-asked.agg(F.countDistinct("item")).first()[0] // item_block))
    shards = max(1, -(-count // shard))
    held = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(count) + 2) / (2 * F.col("df") + 1)))
    asked = asked.join(held, "term").select("item", "item_id", "term", weight.cast("long").alias("weight"))
    # One row per item; the lists are as long as the item's text.
    asked = asked.groupBy("item", "item_id").agg(F.collect_list(F.struct("term", "weight")).alias("terms"))
    asked = asked.select(
        F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        "item", "item_id", F.col("terms.term").alias("terms"), F.col("terms.weight").alias("weights"),
    )
    slope = 100 - 50 + F.expr(f"(50 * n * {count}L) div {max(1, length)}L")
    indexed = rows.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.pmod(F.xxhash64("place"), F.lit(shards)).cast("int").alias("shard"),
        "doc_id", slope.alias("slope"), "terms", "tfs",
    )
    schema = "item string, item_id long, doc_id long, score long"

    def cell(documents: pd.DataFrame, questions: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"item": pd.Series(dtype=object), "item_id": [], "doc_id": [], "score": []})
        if documents.empty or questions.empty:
            return empty
        lengths = documents["terms"].str.len().to_numpy()
        term = np.concatenate(documents["terms"].to_numpy())
        tf = np.concatenate(documents["tfs"].to_numpy())
        doc = np.repeat(np.arange(len(documents)), lengths)
        slopes = np.repeat(documents["slope"].to_numpy(), lengths)
        names, first = np.unique(np.concatenate(questions["terms"].to_numpy()), return_index=True)
        weights = np.concatenate(questions["weights"].to_numpy())[first]
        if not len(term):
            return empty
        near = np.minimum(np.searchsorted(names, term), len(names) - 1)
        held = names[near] == term
        term, tf, doc, slopes, near = term[held], tf[held], doc[held], slopes[held], near[held]
        if not len(term):
            return empty
        impacts = weights[near] * ((1_000_000_000 * tf) // (1000 * tf + 20 * slopes))
        lists = ImpactLists(term, doc, impacts, len(documents))
        ids = documents["doc_id"].astype("Int64")
        last = ids.isna().to_numpy()
        plain = ids.fillna(0).to_numpy(dtype=np.int64)
        tops = []
        for asked_terms in questions["terms"]:
            found = lists.best(np.sort(asked_terms), k)
            top = np.lexsort((plain[found.docs], last[found.docs], -found.scores))[:k]
            top = top[found.scores[top] > 0]
            tops.append((found.docs[top], found.scores[top]))
        question = np.repeat(np.arange(len(questions)), [len(docs) for docs, _ in tops])
        return pd.DataFrame(
            {
                "item": questions["item"].to_numpy(dtype=object)[question],
                "item_id": questions["item_id"].astype("Int64").array[question],
                "doc_id": ids.array[np.concatenate([docs for docs, _ in tops])],
                "score": np.concatenate([scores for _, scores in tops]),
            }
        )

    found = indexed.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(cell, schema)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
    )
