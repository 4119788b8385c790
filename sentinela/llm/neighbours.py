"""Approximate nearest neighbours by collision counting.

Every vector is projected on random lines; each line keeps the projections as one sorted array. A
query opens a window around its own projection on every line, and a vector that stands in enough of
the windows is verified by its exact inner product. Virtual rehashing widens all windows by a factor
until the neighbours found lie within the radius that the windows stand for; a step counts only the
entries that it takes in.

For inner products the vectors, divided by the largest norm, get one more coordinate that brings them
to norm 1; with queries of norm 1 the nearest are then those of largest inner product.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentinela.llm.common import kept

# Vectors of one index on average, and queries that visit it together: they bound a task's memory.
# Queries that are counted at a time.
SHARD = 8192
QUERY_BLOCK = 1024
CHUNK = 64
# Vectors from which the first radius is estimated. Everything else covers all rows.
SAMPLE = 2048


@dataclass(frozen=True)
class Windows:
    """``lines`` projections; half width per radius; widening factor; how many standard deviations the
    collision threshold lies below the collisions expected at the radius; seed of the lines."""

    lines: int = 48
    half_width: float = 1.2
    widen: float = 1.04
    slack: float = 1.2
    seed: int = 7

    @property
    def threshold(self) -> int:
        chance = math.erf(self.half_width / math.sqrt(2))
        return max(1, math.ceil(self.lines * chance - self.slack * math.sqrt(self.lines * chance * (1 - chance))))


def dot(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products, summed for each row in the same order."""
    return np.einsum("ij,j->i", rows, query)


class CollisionIndex:
    """Sorted projections of distinct vectors, one array a line.

    ``visited`` counts the entries that windows took in, ``verified`` the inner products computed.
    """

    def __init__(self, vectors: np.ndarray, largest_norm: float, windows: Windows):
        if windows.lines > 255:
            raise ValueError("counts are bytes, so at most 255 lines")
        self.vectors, self.largest, self.windows = vectors, largest_norm, windows
        self.visited = self.verified = 0
        scaled = vectors / largest_norm
        rest = np.sqrt(np.maximum(0.0, 1 - (scaled * scaled).sum(axis=1)))
        directions = np.random.default_rng(windows.seed).standard_normal((vectors.shape[1] + 1, windows.lines))
        self.directions = directions
        projections = np.ascontiguousarray((np.hstack([scaled, rest[:, None]]) @ directions).T)
        order = np.argsort(projections, axis=1, kind="stable")
        self.sorted = np.take_along_axis(projections, order, axis=1)
        # The sorted arrays' vectors, line after line.
        self.order = order.astype(np.int32).ravel()

    def search(self, queries: np.ndarray, enough: int, first_radius: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per query the verified vectors and their inner products.

        A query ends with ``enough`` of them within the radius of its windows, or when the radius
        spans the sphere and every vector is verified.
        """
        norms = np.sqrt((queries * queries).sum(axis=1))
        own = (queries / norms[:, None]) @ self.directions[:-1]
        for at in range(0, len(queries), CHUNK):
            part = slice(at, at + CHUNK)
            yield from self.search_chunk(queries[part], norms[part], own[part], enough, first_radius)

    def search_chunk(self, queries, norms, own, enough, radius) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        size = len(self.vectors)
        opened = OpenWindows(self, own)
        done = np.zeros((len(queries), size), dtype=bool)
        ids: list[list] = [[np.zeros(0, dtype=np.int64)] for _ in queries]
        scores: list[list] = [[np.zeros(0)] for _ in queries]
        active = np.arange(len(queries))
        while len(active):
            whole = radius >= 2
            if not whole:
                opened.widen(active, self.windows.half_width * radius)
            going = []
            for i in active:
                chosen = ~done[i] if whole else (opened.counts[i] >= self.windows.threshold) & ~done[i]
                found = np.flatnonzero(chosen)
                if len(found):
                    done[i, found] = True
                    ids[i].append(found)
                    scores[i].append(dot(self.vectors[found], queries[i]))
                    self.verified += len(found)
                bound = (1 - radius * radius / 2) * self.largest * norms[i]
                if not whole and sum(int((part >= bound).sum()) for part in scores[i]) < enough:
                    going.append(i)
            active = np.array(going, dtype=np.int64)
            radius *= self.windows.widen
        for found, values in zip(ids, scores):
            yield np.concatenate(found), np.concatenate(values)


class OpenWindows:
    """The windows of some queries on every line, and in how many of a query's each vector stands."""

    def __init__(self, index: CollisionIndex, own: np.ndarray):
        self.index, self.own = index, own
        self.counts = np.zeros((len(own), len(index.vectors)), dtype=np.uint8)
        self.left = self.ends(own, "left")
        self.right = self.left.copy()

    def ends(self, values: np.ndarray, side: str) -> np.ndarray:
        """Places in ``index.order`` where the values (queries x lines) cut the lines."""
        size = len(self.index.vectors)
        return np.stack([at * size + np.searchsorted(line, values[:, at], side=side) for at, line in enumerate(self.index.sorted)], axis=1)

    def widen(self, asking: np.ndarray, half: float) -> None:
        """Widen the windows of some queries; only entries that come in are visited."""
        left, right = self.ends(self.own[asking] - half, "left"), self.ends(self.own[asking] + half, "right")
        starts = np.hstack([left, self.right[asking]]).tolist()
        stops = np.hstack([self.left[asking], right]).tolist()
        order, size = self.index.order, self.counts.shape[1]
        for i, first, last in zip(asking, starts, stops):
            entered = np.concatenate([order[a:b] for a, b in zip(first, last)])
            self.counts[i] += np.bincount(entered, minlength=size).astype(np.uint8)
            self.index.visited += len(entered)
        self.left[asking], self.right[asking] = left, right


def usable(column: Column) -> Column:
    """Whether a vector takes part: not null, empty or zero, and every component finite."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return column.isNotNull() & (F.size(column) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(column, lambda x: x != 0)


def first_radius(sample: np.ndarray, total: int, k: int, largest: float) -> float:
    """A low estimate of the distance at which a query has k neighbours among all vectors."""
    if len(sample) < 2:
        return 2.0
    scaled = sample / largest
    queries = scaled[:256] / np.sqrt((scaled[:256] ** 2).sum(axis=1))[:, None]
    near = np.sort(queries @ scaled.T, axis=1)[:, ::-1]
    place = min(near.shape[1] - 1, max(1, round(k * len(sample) / total)))  # place 0 is the query itself
    return float(np.clip(np.sqrt(np.maximum(0.0, 2 - 2 * np.quantile(near[:, place], 0.75))), 0.05, 2.0))


FOUND = "query_id long, vec_id long, score double"


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    windows: Windows = Windows(),
    shard: int = SHARD,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k nearest found for each query, nearest first.

    ``vectors`` has vec_id and embedding; ``queries`` says which rows ask. Rows go to index shards by
    hash, queries in blocks to every shard, so a task holds one shard and one block. A shard widens
    its windows until it has its likely share of the k.

    Nulls: vectors that are null, empty, zero or hold a null or non-finite component take no part,
    nor rows without an id. Vectors of another length than the query's are no candidates. A row that
    repeats another's id and vector counts once; equal vectors under different ids all count, ties go
    to the smaller id. Fewer than k candidates give all; empty tables give no rows; other columns are
    not read.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        queries.alias("asks"),
    )
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).withColumn("size", F.size("embedding"))
    rows = rows.groupBy("vec_id", "embedding", "size").agg(F.max("asks").alias("asks"))
    rows = kept(rows, "vectors")
    norm = F.aggregate("embedding", F.lit(0.0), lambda sum, x: sum + x * x, F.sqrt)
    sizes = rows.groupBy("size").agg(
        F.count("*").alias("n"), F.sum(F.col("asks").cast("int")).alias("asking"), F.max(norm).alias("largest")
    )
    found = None
    for size, total, asking, largest in sizes.orderBy("size").collect():  # one row per vector length
        if not asking:
            continue
        same = rows.where(F.col("size") == size)
        sample = same.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding").toPandas()
        radius = first_radius(np.stack(sample["embedding"]), total, k, largest)
        part = searched(same, total, asking, largest, radius, k, windows, shard, query_block)
        found = part if found is None else found.union(part)
    if found is None:
        found = rows.select(F.col("vec_id").alias("query_id"), "vec_id", F.lit(0.0).alias("score")).limit(0)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def searched(rows, total, asking, largest, radius, k, windows, shard, query_block) -> DataFrame:
    """The k best verified of each shard for each query; vectors of one length."""
    shards, blocks = -(-total // shard), -(-asking // query_block)
    share = k / shards
    # What a shard has to bring until it stops: its likely share and one standard deviation.
    enough = min(k, math.ceil(share + math.sqrt(share)))
    spread = F.xxhash64("vec_id", "embedding")
    indexed = rows.select(
        F.pmod(spread, F.lit(shards)).cast("int").alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        "vec_id", "embedding", F.lit(False).alias("query"),
    )
    asked = rows.where("asks").select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.pmod(spread, F.lit(blocks)).cast("int").alias("block"),
        "vec_id", "embedding", F.lit(True).alias("query"),
    )

    def cell(group: pd.DataFrame) -> pd.DataFrame:
        is_query = group["query"].to_numpy()
        ids = group["vec_id"].to_numpy()
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        if is_query.all() or not is_query.any():
            return empty
        vectors = np.stack(group["embedding"].to_numpy()[~is_query]).astype(float)
        owners = ids[~is_query]
        distinct, of = np.unique(vectors, axis=0, return_inverse=True)
        of = of.reshape(-1)
        # Of equal vectors, the k smallest ids besides a query's own can be among its k nearest.
        by_class = np.lexsort((owners, of))
        starts = np.searchsorted(of[by_class], np.arange(len(distinct) + 1))
        index = CollisionIndex(distinct, largest, windows)
        asking_ids = ids[is_query]
        asking_vectors = np.stack(group["embedding"].to_numpy()[is_query]).astype(float)
        # A class's members in ``by_class``, at most k and the query itself.
        first, last = starts[:-1], np.minimum(starts[1:], starts[:-1] + k + 1)
        alone = len(distinct) == len(vectors)
        out_ids, out_scores = [], []
        for query_id, (classes, scores) in zip(asking_ids, index.search(asking_vectors, enough + 1, radius)):
            if len(scores) > k + 1:
                # All of the classes that tie with the last needed one.
                needed = scores >= np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
                classes, scores = classes[needed], scores[needed]
            if alone:
                near, values = owners[by_class[classes]], scores
            else:
                sizes = (last - first)[classes]
                at = np.repeat(first[classes] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                near, values = owners[by_class[at]], np.repeat(scores, sizes)
            other = near != query_id
            near, values = near[other], values[other]
            top = np.lexsort((near, -values))[:k]
            out_ids.append(near[top])
            out_scores.append(values[top])
        lengths = [len(near) for near in out_ids]
        return pd.DataFrame(
            {"query_id": np.repeat(asking_ids, lengths), "vec_id": np.concatenate(out_ids), "score": np.concatenate(out_scores)}
        )

    return indexed.union(asked).groupBy("shard", "block").applyInPandas(cell, FOUND)
