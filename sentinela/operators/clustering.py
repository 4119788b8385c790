"""Municipality clusters by epidemiological profile.

All models of a k-means search, every k with every restart, take their steps together: a round is
one aggregate over the points, whose partial sums per centre are a few hundred rows per task. Points
that are a single small partition take all rounds in its task.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentinela.session import written

# Functions of this module travel to the executors as code, which need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FEATURES = ["confirmados", "obitos", "gestantes", "idade_media", "notificacoes"]

# K-means passes over the features many times; few partitions keep a pass over a small table short.
ROWS_PER_PARTITION = 50_000


class Clusters(NamedTuple):
    members: DataFrame
    centroids: DataFrame
    scores: DataFrame


def standardize(rows: DataFrame, columns: list[str] = FEATURES, suffix: str = "_z") -> DataFrame:
    """Add z-scores with the population deviation; NULL counts as 0, constant columns become 0."""
    filled = rows.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns})
    moments = filled.agg(
        F.struct(
            *[F.avg(c).alias(f"{c}_m") for c in columns], *[F.stddev_pop(c).alias(f"{c}_s") for c in columns]
        ).alias("moments")
    ).scalar()

    def z(c: str):
        spread = F.coalesce(F.nullif(moments.getField(f"{c}_s"), F.lit(0.0)), F.lit(1.0))
        return (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - moments.getField(f"{c}_m")) / spread

    return rows.withColumns({f"{c}{suffix}": z(c) for c in columns})


def silhouette_scores(points: DataFrame, columns: list[str], labels: dict[int, str]) -> DataFrame:
    """Mean squared-Euclidean silhouette of several labellings: ``k, silhouette``.

    ``labels`` maps k to a label column. A point's summed squared distances to a cluster follow from
    the cluster's count, sum vector and sum of squared norms, so one aggregate over the points and
    one row of clusters per labelling are enough at any size.
    """
    values = F.array(*[F.col(c).cast("double") for c in columns])
    named = F.array(*[F.struct(F.lit(k).alias("k"), F.col(label).cast("long").alias("own")) for k, label in labels.items()])
    norm = F.aggregate("x", F.lit(0.0), lambda sum, value: sum + value * value)
    rows = points.select(values.alias("x"), F.explode(named).alias("label")).select("x", norm.alias("norm"), "label.*")
    sums = F.array(*[F.sum(F.get("x", F.lit(i))) for i in range(len(columns))])
    clusters = rows.groupBy("k", "own").agg(
        F.count(F.lit(1)).alias("size"), sums.alias("sums"), F.sum("norm").alias("norms")
    )
    # At most k clusters in each row.
    clusters = clusters.groupBy("k").agg(F.collect_list(F.struct("own", "size", "sums", "norms")).alias("clusters"))

    def spread(cluster: Column) -> Column:
        """Summed squared distances from the point to the cluster's members."""
        product = F.aggregate(F.zip_with("x", cluster["sums"], lambda x, total: x * total), F.lit(0.0), lambda sum, part: sum + part)
        return F.greatest(F.lit(0.0), cluster["size"] * F.col("norm") - 2 * product + cluster["norms"])

    home = F.get(F.filter("clusters", lambda cluster: cluster["own"] == F.col("own")), F.lit(0))
    others = F.filter("clusters", lambda cluster: cluster["own"] != F.col("own"))
    inside = spread(home) / F.greatest(F.lit(1), home["size"] - 1)
    outside = F.array_min(F.transform(others, lambda cluster: spread(cluster) / cluster["size"]))
    scored = rows.join(clusters, "k").select("k", home["size"].alias("size"), inside.alias("a"), outside.alias("b"))
    top = F.nullif(F.greatest("a", "b"), F.lit(0.0))
    score = F.when(F.col("size") > 1, F.coalesce((F.col("b") - F.col("a")) / top, F.lit(0.0))).otherwise(0.0)
    return scored.groupBy("k").agg(F.avg(score).alias("silhouette"))


def best_k(scores: DataFrame) -> DataFrame:
    """The best score; among equals the smallest k."""
    return scores.orderBy(F.desc("silhouette"), "k").limit(1)


class Fits(NamedTuple):
    """K-means models that were fitted together: their centres, costs, and the rounds they took."""

    centres: list[np.ndarray]
    costs: list[float]
    rounds: int


def squared_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Points by centres, as sums of squared differences, so that near-ties keep their order."""
    gaps = np.zeros((len(x), len(centres)))
    for column in range(x.shape[1]):
        gaps += (x[:, column, None] - centres[None, :, column]) ** 2
    return gaps


def _slices(sizes: Sequence[int]) -> list[slice]:
    ends = np.cumsum(sizes)
    return [slice(int(end - size), int(end)) for size, end in zip(sizes, ends)]


def _point_blocks(batches: Iterable[pd.DataFrame], rows: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Marks and coordinates of the points, in blocks that keep the distances of all models small."""
    for batch in batches:
        for start in range(0, len(batch), rows):
            block = batch.iloc[start : start + rows]
            yield block["mark"].to_numpy(), block.drop(columns="mark").to_numpy(dtype=float)


# For each centre of a model: number, cost and sum of the points nearest to it.
Slots = list[tuple[float, float, np.ndarray]]


def _point_sums(blocks: Iterable[np.ndarray], models: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers, costs and sums of the points nearest to each centre, the models' centres one after the other."""
    stacked = np.concatenate(models)
    size, width = stacked.shape
    counts, costs, sums = np.zeros(size), np.zeros(size), np.zeros((size, width))
    for x in blocks:
        gaps = squared_distances(x, stacked)
        for place in _slices([len(model) for model in models]):
            own = place.start + gaps[:, place].argmin(axis=1)
            counts += np.bincount(own, minlength=size)
            costs += np.bincount(own, weights=gaps[np.arange(len(x)), own], minlength=size)
            for column in range(width):
                sums[:, column] += np.bincount(own, weights=x[:, column], minlength=size)
    return counts, costs, sums


def _assigned(points: DataFrame, models: list[np.ndarray]) -> list[Slots]:
    """The slots of each model. One aggregate for all of them."""
    width = models[0].shape[1]

    def partial(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, costs, sums = _point_sums((x for _, x in _point_blocks(batches)), models)
        some = np.flatnonzero(counts)
        yield pd.DataFrame({"slot": some, "n": counts[some], "cost": costs[some], "sums": list(sums[some])})

    parts = points.mapInPandas(partial, "slot int, n double, cost double, sums array<double>")
    totals = parts.groupBy("slot").agg(F.sum("n"), F.sum("cost"), *[F.sum(F.get("sums", F.lit(i))) for i in range(width)])
    found = {slot: (n, cost, np.array(sums)) for slot, n, cost, *sums in totals.collect()}  # one row per centre
    nothing = (0.0, 0.0, np.zeros(width))
    places = _slices([len(model) for model in models])
    return [[found.get(slot, nothing) for slot in range(place.start, place.stop)] for place in places]


def _stepped(models: Sequence[np.ndarray], assigned: Callable[[list[np.ndarray]], list[Slots]], max_rounds: int, tol: float) -> Fits:
    """Rounds of all models that still move, until none does."""
    centres = [np.array(model, dtype=float) for model in models]
    costs = [0.0] * len(centres)
    moving = list(range(len(centres)))
    rounds = 0
    while moving and rounds < max_rounds:
        rounds += 1
        still = []
        for model, slots in zip(moving, assigned([centres[model] for model in moving])):
            costs[model] = float(sum(cost for _, cost, _ in slots))
            moved = np.array([total / n if n else centre for (n, _, total), centre in zip(slots, centres[model])])
            if np.sqrt(((moved - centres[model]) ** 2).sum(axis=1)).max() > tol:
                still.append(model)
            centres[model] = moved
        moving = still
    return Fits(centres, costs, rounds)


def lloyd(
    points: DataFrame, models: Sequence[np.ndarray], max_rounds: int = 300, tol: float = 1e-9, one_task: bool = False
) -> Fits:
    """Move the centres of several models to the means of their points until none moves further than ``tol``.

    ``points`` has a long ``mark`` and one double column per coordinate. A round is one aggregate
    over points and all models that still move. A centre without points stays. The costs are those
    of the centres before the last move. With ``one_task``, for points of a single small partition,
    the same rounds follow each other inside its task.
    """
    models = list(models)
    if not one_task:
        return _stepped(models, lambda moving: _assigned(points, moving), max_rounds, tol)

    def whole(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks = [x for _, x in _point_blocks(batches)]

        def assigned(moving: list[np.ndarray]) -> list[Slots]:
            counts, costs, sums = _point_sums(blocks, moving)
            return [list(zip(counts[place], costs[place], sums[place])) for place in _slices([len(model) for model in moving])]

        fits = _stepped(models, assigned, max_rounds, tol)
        rows = [(model, number, list(centre), fits.costs[model], fits.rounds) for model, found in enumerate(fits.centres) for number, centre in enumerate(found)]
        yield pd.DataFrame(rows, columns=["model", "number", "centre", "cost", "rounds"])

    found = points.mapInPandas(whole, "model int, number int, centre array<double>, cost double, rounds int")
    rows = sorted(found.collect(), key=lambda row: (row["model"], row["number"]))  # one row per centre
    centres = [np.array([row["centre"] for row in rows if row["model"] == model]) for model in range(len(models))]
    costs = {row["model"]: row["cost"] for row in rows}
    return Fits(centres, [costs[model] for model in range(len(models))], rows[0]["rounds"] if rows else 0)


def _drawn(points: DataFrame, models: list[np.ndarray | None], sizes: list[int], seeds: list[int]) -> list[np.ndarray]:
    """For each model, points drawn without repetition with weights that are their squared distances to its centres.

    Models without centres weigh all points alike. A point's draw follows from its mark and the
    model's seed, so it does not depend on how the points are split. The smallest of exponential
    variables with these rates win; no total is needed before drawing.
    """
    width = len(points.columns) - 1

    def best(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0), np.empty((0, width))) for _ in models]
        for marks, x in _point_blocks(batches):
            for number, (model, size, seed) in enumerate(zip(models, sizes, seeds)):
                weight = np.ones(len(x)) if model is None else squared_distances(x, model).min(axis=1)
                with np.errstate(divide="ignore"):
                    times = np.where(weight > 0, -np.log(_uniform(marks, seed)) / weight, np.inf)
                times, rows = np.concatenate([kept[number][0], times]), np.concatenate([kept[number][1], x])
                first = np.lexsort((*rows.T, times))[:size]
                first = first[np.isfinite(times[first])]
                kept[number] = times[first], rows[first]
        frames = [pd.DataFrame({"model": number, "time": times, "x": list(rows)}) for number, (times, rows) in enumerate(kept) if len(times)]
        if frames:
            yield pd.concat(frames, ignore_index=True)

    drawn = points.mapInPandas(best, "model int, time double, x array<double>")
    order = Window.partitionBy("model").orderBy("time", "x")
    limit = F.element_at(F.array(*[F.lit(size) for size in sizes]), F.col("model") + 1)
    first = drawn.withColumn("_place", F.row_number().over(order)).where((F.col("_place") <= max(sizes)) & (F.col("_place") <= limit))
    rows: list[list[list[float]]] = [[] for _ in models]
    for model, _, x in first.orderBy("model", "time", "x").select("model", "time", "x").collect():  # sizes in all
        rows[model].append(x)
    return [np.array(found, dtype=float).reshape(-1, width) for found in rows]


def _uniform(marks: np.ndarray, seed: int) -> np.ndarray:
    """Numbers in (0, 1) that follow from the marks and the seed."""
    mixed = marks.astype(np.int64).view(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    mixed ^= mixed >> np.uint64(31)
    return ((mixed >> np.uint64(12)).astype(float) + 0.5) / 2.0**52


def _plus_plus(candidates: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k of the weighted candidates, far from each other, moved to the means of the candidates nearest to them."""
    chosen = [int(rng.choice(len(candidates), p=weights / weights.sum()))]
    while len(chosen) < min(k, len(candidates)):
        gaps = weights * squared_distances(candidates, candidates[chosen]).min(axis=1)
        if gaps.sum() <= 0:
            break
        chosen.append(int(rng.choice(len(candidates), p=gaps / gaps.sum())))
    centres = candidates[chosen]
    for _ in range(30):
        own = squared_distances(candidates, centres).argmin(axis=1)
        mass = np.bincount(own, weights=weights, minlength=len(centres))
        moved = np.stack([np.bincount(own, weights=weights * column, minlength=len(centres)) for column in candidates.T], axis=1)
        moved = np.where(mass[:, None] > 0, moved / np.maximum(mass, 1e-300)[:, None], centres)
        if np.array_equal(moved, centres):
            break
        centres = moved
    return centres


def seeded(points: DataFrame, tries: Sequence[tuple[int, int]], rounds: int = 2) -> list[np.ndarray]:
    """Starting centres for each (k, seed) by k-means‖: every round draws 2k points far from those drawn so far.

    The candidates, weighted by how many points are nearest to them, are reduced to k on the driver;
    there are 1 + 2 * k * ``rounds`` of them whatever the number of points. All tries share each pass.
    """
    models = _drawn(points, [None] * len(tries), [1] * len(tries), [seed for _, seed in tries])
    for turn in range(1, rounds + 1):
        more = _drawn(points, models, [2 * k for k, _ in tries], [seed + 7919 * turn * (k + 1) for k, seed in tries])
        models = [np.unique(np.concatenate(both), axis=0) for both in zip(models, more)]
    weights = [np.array([n for n, _, _ in slots]) for slots in _assigned(points, models)]
    return [_plus_plus(model, weight, k, np.random.default_rng([seed, k])) for model, weight, (k, seed) in zip(models, weights, tries)]


def coordinates(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``mark``, a hash of the row, and the columns as doubles."""
    mark = F.xxhash64(*[F.col(name) for name in rows.columns]).alias("mark")
    return rows.select(mark, *[F.col(name).cast("double").alias(f"x{place}") for place, name in enumerate(columns)])


def fit_all(rows: DataFrame, columns: Sequence[str], tries: Sequence[tuple[int, int]], max_rounds: int = 300) -> Fits:
    """One k-means model for each (k, seed), seeded and moved together.

    Points of up to ``ROWS_PER_PARTITION`` rows are one partition, whose task takes all rounds.
    """
    parts = max(1, -(-rows.count() // ROWS_PER_PARTITION))
    points = coordinates(rows, columns).coalesce(parts).persist()
    try:
        return lloyd(points, seeded(points, tries), max_rounds, one_task=parts == 1)
    finally:
        points.unpersist()


def nearest_centre(columns: Sequence[str], centres: np.ndarray) -> Column:
    """Number of the nearest centre, the first among equals."""
    gaps = []
    for number, centre in enumerate(centres):
        gap = sum(((F.col(name).cast("double") - F.lit(float(value))) ** 2 for name, value in zip(columns, centre)), F.lit(0.0))
        gaps.append(F.struct(gap.alias("gap"), F.lit(number).alias("number")))
    return F.array_min(F.array(*gaps))["number"]


def label_by_k(
    features: DataFrame,
    columns: list[str] = FEATURES,
    k_max: int = 8,
    restarts: int = 10,
    seed: int = 42,
    k_min: int = 2,
) -> DataFrame:
    """Add z-scores and, for each k from ``k_min`` to ``k_max``, the best of ``restarts`` k-means labels.

    The feature table is written once, since every round and everything after it reads it.
    """
    return _label_by_k(written(features, "features"), columns, k_max, restarts, seed, k_min)


def _label_by_k(
    features: DataFrame, columns: list[str], k_max: int, restarts: int, seed: int, k_min: int = 2
) -> DataFrame:
    scaled = written(standardize(features, columns), "scaled")
    scores = [f"{c}_z" for c in columns]
    every_k = range(k_min, k_max + 1)
    tries = [(k, seed + restart) for k in every_k for restart in range(restarts)]
    fits = fit_all(scaled, scores, tries)
    labels = {}
    for k in every_k:
        best = min((cost, number) for number, ((of_k, _), cost) in enumerate(zip(tries, fits.costs)) if of_k == k)[1]
        labels[f"cluster_{k}"] = nearest_centre(scores, fits.centres[best])
    return scaled.withColumns(labels)


def silhouette_by_k(labelled: DataFrame, columns: list[str] = FEATURES, k_max: int = 8) -> DataFrame:
    """Score of each k-means labelling made by ``label_by_k``."""
    return silhouette_scores(labelled, [f"{c}_z" for c in columns], {k: f"cluster_{k}" for k in range(2, k_max + 1)})


def centroids(members: DataFrame, columns: list[str] = FEATURES) -> DataFrame:
    """Mean profile of each cluster in original units, to one decimal."""
    return members.groupBy("cluster").agg(
        *[F.round(F.avg(F.coalesce(F.col(c).cast("double"), F.lit(0.0))), 1).alias(c) for c in columns]
    )


def centroid_heatmap(centres: DataFrame, columns: list[str] = FEATURES) -> DataFrame:
    """Centroids with z-scores across clusters."""
    return standardize(centres, columns)


def kmeans_municipalities(
    features: DataFrame,
    columns: list[str] = FEATURES,
    k_max: int = 8,
    restarts: int = 10,
    seed: int = 42,
    least: int = 10,
) -> Clusters | None:
    """Cluster municipalities with the k of the best silhouette; ``None`` for too few rows."""
    features = written(features, "features")
    if features.limit(least).count() < least:
        return None
    labelled = _label_by_k(features, columns, k_max, restarts, seed)
    scores = silhouette_by_k(labelled, columns, k_max)
    chosen = best_k(scores).first()["k"]
    members = labelled.select(*features.columns, F.col(f"cluster_{chosen}").alias("cluster"))
    return Clusters(members, centroids(members, columns), scores)
