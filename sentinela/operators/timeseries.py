"""Weekly series per key: gap filling, seasonal decomposition, trend, forecast.

Each key (a state, a municipality, or nothing for the national series) is one independent series.
Rows are summed to one per key and week before any of them is collected, so a series handed to
pandas is bounded by the calendar, 52 rows a year, however many notifications it counts.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Callable, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Functions of this module travel to the executors as code, which need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WEEKS_PER_YEAR = 52


# No form is older; an older week is a mistyped date.
FIRST_WEEK = dt.date(1900, 1, 1)


def _in_calendar(week: str, since: dt.date, until: dt.date | None) -> tuple[Column, Column]:
    """Whether a week is not too early, and whether it is not too late; by default today is the last day."""
    last = F.current_date() if until is None else F.lit(until)
    return F.col(week) >= F.lit(since), F.col(week) <= last


def gap_fill_weekly(
    series: DataFrame,
    keys: Sequence[str] = (),
    week: str = "inicio_sem",
    value: str = "casos_confirmados",
    since: dt.date = FIRST_WEEK,
    until: dt.date | None = None,
) -> DataFrame:
    """One row per key and Monday between the key's first and last, 0 where nothing was counted.

    Weeks before ``since`` or after ``until`` (today unless given) are left out, so that one mistyped
    date does not stretch a series over thousands of years; ``refused_weeks`` reports them.
    """
    early, late = _in_calendar(week, since, until)
    weekly = series.where(early & late).groupBy(*keys, week).agg(F.sum(value).alias(value))
    span = weekly.groupBy(*keys).agg(F.min(week).alias("_first"), F.max(week).alias("_last"))
    mondays = F.sequence("_first", "_last", F.expr("interval 7 days"))
    grid = span.where(F.col("_first").isNotNull()).select(
        *keys, F.explode(mondays).alias(week), F.lit(0).cast(weekly.schema[value].dataType).alias(value)
    )
    return grid.unionByName(weekly).groupBy(*keys, week).agg(F.sum(value).alias(value))


def refused_weeks(
    series: DataFrame,
    keys: Sequence[str] = (),
    week: str = "inicio_sem",
    value: str = "casos_confirmados",
    since: dt.date = FIRST_WEEK,
    until: dt.date | None = None,
) -> DataFrame:
    """What ``gap_fill_weekly`` leaves out, summed per key and week, with the reason."""
    early, late = _in_calendar(week, since, until)
    reason = F.when(F.col(week).isNull(), f"{week}:missing").when(~early, f"{week}:early").when(~late, f"{week}:late")
    refused = series.withColumn("motivo", reason).where("motivo IS NOT NULL")
    return refused.groupBy(*keys, week, "motivo").agg(F.sum(value).alias(value))


def _local_fit(y: np.ndarray, at: np.ndarray, width: int, weights: np.ndarray | None) -> np.ndarray:
    """Locally weighted straight lines through ``y`` at positions 0, 1, …, evaluated at ``at``.

    The last axis of ``y`` and ``weights`` is time; several series are fitted at once. Tricube
    weights over the ``width`` nearest points; a wider window than the series widens the
    bandwidth. NaN where every point in the window has weight 0.
    """
    n = y.shape[-1]
    size = min(width, n)
    first = np.clip(np.rint(at).astype(int) - (size - 1) // 2, 0, n - size)
    near = first[:, None] + np.arange(size)
    distance = np.abs(near - at[:, None])
    reach = distance.max(axis=-1, keepdims=True) + max(width - n, 0) // 2
    share = np.divide(distance, reach, out=np.zeros_like(distance), where=reach > 0)
    w = np.where(share <= 0.001, 1.0, np.where(share < 0.999, (1 - share**3) ** 3, 0.0))
    if weights is not None:
        w = w * weights[..., near]
    mass = w.sum(axis=-1, keepdims=True)
    w = np.divide(w, mass, out=np.full_like(w, np.nan), where=mass > 0)
    centre = (w * near).sum(axis=-1, keepdims=True)
    offset = near - centre
    spread = (w * offset**2).sum(axis=-1, keepdims=True)
    steep = (at[:, None] - centre) * offset
    tilt = np.divide(steep, spread, out=np.zeros_like(steep), where=np.sqrt(spread) > 0.001 * max(n - 1, 1))
    return (w * (1 + tilt) * y[..., near]).sum(axis=-1)


def _smooth_phases(rest: np.ndarray, period: int, width: int, weights: np.ndarray | None) -> np.ndarray:
    """Each phase of the cycle smoothed over the years and extended by one year on both sides.

    Phases with the same number of years are fitted together.
    """
    n = len(rest)
    cycle = np.empty(n + 2 * period)
    whole_years, extra = divmod(n, period)
    for phases, years in ((np.arange(extra), whole_years + 1), (np.arange(extra, period), whole_years)):
        if len(phases) == 0:
            continue
        places = phases[:, None] + period * np.arange(years)
        part = rest[places]
        fit = _local_fit(part, np.arange(-1.0, years + 1), width, None if weights is None else weights[places])
        raw = np.concatenate([part[:, :1], part, part[:, -1:]], axis=1)
        cycle[phases[:, None] + period * np.arange(years + 2)] = np.where(np.isnan(fit), raw, fit)
    return cycle


def _moving_mean(x: np.ndarray, width: int) -> np.ndarray:
    return np.convolve(x, np.full(width, 1.0 / width), mode="valid")


def _odd_at_least(x: float) -> int:
    n = int(np.ceil(x))
    return n + (n % 2 == 0)


def stl(
    y: np.ndarray, period: int = WEEKS_PER_YEAR, seasonal: int = 7, robust: bool = True
) -> tuple[np.ndarray, np.ndarray]:
    """Trend and seasonal part of a regular series (Cleveland et al., 1990).

    Trend and low-pass windows follow the usual defaults for the given period. Needs at least one
    full period.
    """
    n = len(y)
    trend_width = _odd_at_least(1.5 * period / (1 - 1.5 / seasonal))
    low_width = _odd_at_least(period + 1)
    inner, outer = (2, 15) if robust else (5, 0)
    place = np.arange(n, dtype=float)
    trend, season, weights = np.zeros(n), np.zeros(n), None
    for turn in range(outer + 1):
        for _ in range(inner):
            cycle = _smooth_phases(y - trend, period, seasonal, weights)
            low = _moving_mean(_moving_mean(_moving_mean(cycle, period), period), 3)
            season = cycle[period : period + n] - _local_fit(low, place, low_width, None)
            smooth = _local_fit(y - season, place, trend_width, weights)
            trend = np.where(np.isnan(smooth), y - season, smooth)
        if turn < outer:
            miss = np.abs(y - trend - season)
            limit = 6 * np.median(miss)
            u = np.divide(miss, limit, out=np.where(miss > 0, np.inf, 0.0), where=limit > 0)
            weights = np.where(u <= 0.001, 1.0, np.where(u <= 0.999, (1 - np.minimum(u, 1) ** 2) ** 2, 0.0))
    return trend, season


def _per_series(
    rows: DataFrame, keys: Sequence[str], make: Callable[[pd.DataFrame], pd.DataFrame], extra: list[T.StructField]
) -> DataFrame:
    """Run ``make`` on each key's rows; its result gets the key columns in front.

    The rows are few but each series takes long, so they are spread over a fixed number of
    partitions, which adaptive execution does not merge.
    """
    if keys:
        rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    fields = [rows.schema[key] for key in keys]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        made = make(group)
        for position, key in enumerate(keys):
            made.insert(position, key, group[key].iloc[0])
        return made

    return rows.groupBy(*keys).applyInPandas(run, T.StructType([*fields, *extra]))


def seasonal_decompose(
    series: DataFrame,
    keys: Sequence[str] = (),
    week: str = "inicio_sem",
    value: str = "casos_confirmados",
    period: int = WEEKS_PER_YEAR,
    robust: bool = True,
    since: dt.date = FIRST_WEEK,
    until: dt.date | None = None,
) -> DataFrame:
    """Trend, seasonal part and residual per key and week; the three add up to the observation.

    ``serie_curta`` marks series shorter than two periods; below one period the parts are NULL.
    ``since`` and ``until`` are those of ``gap_fill_weekly``.
    """

    def decompose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(week)
        y = group[value].to_numpy(dtype=float)
        if len(y) >= period:
            trend, season = stl(y, period=period, robust=robust)
        else:
            trend = season = np.full(len(y), np.nan)
        out = pd.DataFrame(
            {
                week: group[week].to_numpy(),
                "observado": y,
                "tendencia": trend,
                "sazonal": season,
                "residuo": y - trend - season,
                "serie_curta": len(y) < 2 * period,
            }
        )
        return out.astype(object).where(out.notna(), None)

    parts = [T.StructField(name, T.DoubleType()) for name in ("observado", "tendencia", "sazonal", "residuo")]
    extra = [T.StructField(week, T.DateType()), *parts, T.StructField("serie_curta", T.BooleanType())]
    return _per_series(gap_fill_weekly(series, keys, week, value, since, until), keys, decompose, extra)


def seasonal_by_week(decomposed: DataFrame, keys: Sequence[str] = (), week: str = "inicio_sem") -> DataFrame:
    """Mean seasonal part per ISO week."""
    return decomposed.groupBy(*keys, F.weekofyear(week).alias("semana")).agg(F.avg("sazonal").alias("sazonal"))


def linear_trend(
    yearly: DataFrame,
    first_year: int | None = None,
    last_year: int | None = None,
    key: str = "uf",
    year: str = "ano",
    value: str = "casos_confirmados",
    least: int = 3,
) -> DataFrame:
    """Least-squares line of yearly cases per key, with the first and last year's cases.

    The cases are ``casos_<year>``; without a given year, those of the first or last year of the
    whole table as ``casos_primeiro_ano`` and ``casos_ultimo_ano``. Keys with fewer than ``least``
    years are left out; missing years are not counted as 0.
    """
    def cases_in(given: int | None, edge: Column, name: str):
        if given is not None:
            edge, name = F.lit(given), str(given)
        found = F.sum(F.when(F.col(year) == edge, F.col(value)))
        return F.coalesce(found, F.lit(0).cast("bigint")).alias(f"casos_{name}")

    if first_year is not None:
        yearly = yearly.where(F.col(year) >= first_year)
    if last_year is not None:
        yearly = yearly.where(F.col(year) <= last_year)
    edges = [yearly.agg(edge(year)).scalar() for edge in (F.min, F.max)]
    return (
        yearly.where(F.col(year).isNotNull())
        .groupBy(key)
        .agg(
            F.regr_slope(value, year).alias("slope_anual"),
            F.regr_intercept(value, year).alias("intercept"),
            cases_in(first_year, edges[0], "primeiro_ano"),
            cases_in(last_year, edges[1], "ultimo_ano"),
            F.count(F.lit(1)).alias("_n"),
        )
        .where(F.col("_n") >= least)
        .drop("_n")
    )


def _year_waves(days: np.ndarray, order: int) -> np.ndarray:
    """Sine and cosine columns of the yearly cycle up to ``order``."""
    turns = 2 * np.pi * np.outer(days / 365.25, np.arange(1, order + 1))
    return np.hstack([np.sin(turns), np.cos(turns)])


def _solve(design: np.ndarray, y: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    return np.linalg.solve(design.T @ design + np.diag(penalty), design.T @ y)


# The part of the history in which the trend may bend.
REACH = 0.95
# Share of the trend's energy that holds the cycle's waves back.
RIDGE = 1e-3
# The cycle is fitted around a straight line first, lest the line bend with the seasons.
STRAIGHT_ROUNDS = 3


class Trend(NamedTuple):
    """Piecewise linear trend times a yearly cycle, over history and future."""

    estimate: np.ndarray
    trend: np.ndarray
    cycle: np.ndarray
    # Places in the history where the slope changes, and by how much per day.
    bends: np.ndarray
    changes: np.ndarray
    # What the penalised fit leaves unsolved: 0 at its optimum, in units of the penalty.
    unsolved: float


def lasso(gram: np.ndarray, target: np.ndarray, limit: float, start: np.ndarray, sweeps: int = 2000, tol: float = 1e-6) -> np.ndarray:
    """Coordinate descent for the least of b'Gb/2 - target'b + limit * sum of |b|.

    Full sweeps alternate with sweeps over the coefficients that are not zero, until a full sweep
    leaves every gradient within ``tol`` limits of the optimum.
    """
    diagonal = gram.diagonal()
    usable = np.flatnonzero(diagonal > 1e-12 * max(diagonal.max(initial=0.0), 1e-300)).tolist()
    solved = np.zeros(len(start))
    solved[usable] = start[usable]
    rest = target - gram @ solved
    # Plain floats: a step touches one coefficient at a time.
    b, widths = solved.tolist(), diagonal.tolist()

    def sweep(places: list[int]) -> float:
        most = 0.0
        for j in places:
            pull = float(rest[j]) + widths[j] * b[j]
            new = (pull - limit) / widths[j] if pull > limit else (pull + limit) / widths[j] if pull < -limit else 0.0
            step = new - b[j]
            if step:
                np.subtract(rest, gram[j] * step, out=rest)
                b[j] = new
                most = max(most, abs(step) * widths[j])
        return most

    done = 0
    while done < sweeps:
        done += 1
        if sweep(usable) <= tol * limit:
            break
        active = [j for j in usable if b[j]]
        while done < sweeps:
            done += 1
            if sweep(active) <= tol * limit:
                break
    return np.array(b)


def _gradient_excess(gram: np.ndarray, target: np.ndarray, limit: float, b: np.ndarray) -> float:
    """How far the optimality conditions of ``lasso`` are missed, in units of the limit."""
    rest = target - gram @ b
    off = np.where(b != 0, np.abs(rest - limit * np.sign(b)), np.maximum(np.abs(rest) - limit, 0.0))
    return float(off.max(initial=0.0) / limit)


def _hinges(t: np.ndarray, knots: np.ndarray) -> np.ndarray:
    return np.maximum(t[:, None] - t[knots][None, :], 0.0)


def _without(base: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """What the base's columns cannot explain."""
    q = np.linalg.qr(base)[0]
    return columns - q @ (q.T @ columns)


def _joined_bends(knots: np.ndarray, changes: np.ndarray, spacing: float) -> np.ndarray:
    """Bends at neighbouring knots in the same direction are one bend between them."""
    active = np.flatnonzero(changes)
    joined: list[list[int]] = []
    for j in active:
        if joined and knots[j] - knots[joined[-1][-1]] <= 1.5 * spacing and changes[j] * changes[joined[-1][-1]] > 0:
            joined[-1].append(j)
        else:
            joined.append([j])
    weights = np.abs(changes)
    places = [round(float(np.average(knots[group], weights=weights[group]))) for group in joined]
    return np.unique(np.array(places, dtype=int))


def _worth_keeping(t: np.ndarray, cycle: np.ndarray, y: np.ndarray, knots: np.ndarray) -> np.ndarray:
    """The bends without those whose week and size cost more than they explain (Bayes information criterion)."""
    plain = np.column_stack([np.ones(len(t)), t])

    def missed(places: np.ndarray) -> float:
        base = np.column_stack([plain, _hinges(t, places)]) * cycle[:, None]
        return max(float((_without(base, y[:, None]) ** 2).sum()), 1e-12)

    while len(knots):
        now = missed(knots)
        without = [missed(np.delete(knots, j)) for j in range(len(knots))]
        least = int(np.argmin(without))
        if len(t) * np.log(without[least] / now) >= 3 * np.log(len(t)):
            break
        knots = np.delete(knots, least)
    return knots


def _moved_bends(t: np.ndarray, cycle: np.ndarray, y: np.ndarray, knots: np.ndarray, spacing: float, last: int) -> np.ndarray:
    """Each bend in turn at the week, up to a knot's spacing away, where the line fits best given the others."""
    knots = knots.copy()
    plain = np.column_stack([np.ones(len(t)), t])
    for _ in range(3):
        before = knots.copy()
        for j in range(len(knots)):
            others = np.delete(knots, j)
            low, high = max(1, int(knots[j] - spacing)), min(last, int(knots[j] + spacing))
            tried = np.setdiff1d(np.arange(low, high + 1), others)
            if not len(tried):
                continue
            base = np.column_stack([plain, _hinges(t, others)]) * cycle[:, None]
            columns = _without(base, _hinges(t, tried) * cycle[:, None])
            norms = (columns**2).sum(axis=0)
            rest = _without(base, y[:, None])[:, 0]
            gains = np.where(norms > 1e-12, (columns.T @ rest) ** 2 / np.maximum(norms, 1e-12), 0.0)
            knots[j] = tried[int(gains.argmax())]
        if np.array_equal(before, knots):
            break
    return np.unique(knots)


def fit_trend(
    days: np.ndarray,
    y: np.ndarray,
    future: np.ndarray,
    order: int = 10,
    rounds: int = 10,
    changepoints: int = 25,
    reach: float = REACH,
    looseness: float = 0.05,
) -> Trend:
    """Piecewise linear trend times a yearly cycle, fitted in turns.

    The slope may change at up to ``changepoints`` weeks spread over the first ``reach`` of the
    history; the changes carry an L1 penalty (noise variance divided by ``looseness``), so most are
    zero. After half of the rounds, and once more before the last two, neighbouring changes are joined,
    those that explain too little go, and the others move, week by week, to where they fit best; the
    penalised fit goes on with these weeks.
    """
    every = np.concatenate([days, future]).astype(float)
    past = len(days)
    length = max(float(days[-1] - days[0]), 1.0)
    t = (every - every[0]) / length
    history = t[:past]
    scale = max(float(np.abs(y).max(initial=0.0)), 1e-9)
    level = y / scale
    plain = np.column_stack([np.ones(len(t)), t])
    waves = _year_waves(every, order)
    last = max(int(reach * past) - 1, 0)
    knots = np.unique(np.rint(np.linspace(0, last, min(changepoints, last) + 1)).astype(int)[1:])
    spacing = max(last / max(len(knots), 1), 1.0)
    cycle, changes, unsolved = np.ones(len(t)), np.zeros(len(knots)), 0.0
    trend = np.zeros(len(t))
    strength = np.full(2 * order, RIDGE * max(float(np.mean(np.abs(level))), 1e-9) ** 2 * past)
    noise = float(np.var(_without(plain[:past], level[:, None])))
    for turn in range(rounds):
        if turn in (rounds // 2, rounds - 2) and changes.any():
            knots = _joined_bends(knots, changes, spacing if turn == rounds // 2 else 1.0)
            knots = _worth_keeping(history, cycle[:past], level, knots)
            knots = _moved_bends(history, cycle[:past], level, knots, spacing, last)
            changes = np.zeros(len(knots))
        now = cycle[:past, None]
        limit = max(noise, 1e-7) / looseness
        if len(knots) and turn >= STRAIGHT_ROUNDS:
            bent = _without(plain[:past] * now, _hinges(history, knots) * now)
            rest = _without(plain[:past] * now, level[:, None])[:, 0]
            gram, target = bent.T @ bent, bent.T @ rest
            changes = lasso(gram, target, limit, changes)
            unsolved = _gradient_excess(gram, target, limit, changes)
        bends = np.maximum(t[:, None] - history[knots][None, :], 0.0) @ changes
        line = np.linalg.lstsq(plain[:past] * now, level - bends[:past] * cycle[:past], rcond=None)[0]
        trend = plain @ line + bends
        cycle = 1 + waves @ _solve(waves[:past] * trend[:past, None], level - trend[:past], strength)
        noise = float(np.mean((level - (trend * cycle)[:past]) ** 2))
    some = changes != 0
    return Trend(trend * cycle * scale, trend * scale, cycle, knots[some], changes[some] * scale / length, unsolved)


def simulated_trends(
    trend: Trend, days: np.ndarray, future: np.ndarray, noise: float, samples: int, rng: np.random.Generator, reach: float = REACH
) -> np.ndarray:
    """Samples by future weeks: how far the trend may lie from its estimate.

    Its level, slope and bends are known as well as ``noise`` allows, and the slope goes on changing
    as often as it did, with Laplace sizes of the same mean.
    """
    past = len(days)
    every = np.concatenate([days, future]).astype(float) - days[0]
    t = every / max(every[past - 1], 1.0)
    base = np.column_stack([np.ones(len(t)), t, np.maximum(t[:, None] - t[trend.bends][None, :], 0.0)])
    # Square root of the inverse of the normal equations, without the directions that the data leave open.
    _, sizes, turned = np.linalg.svd(base[:past] * trend.cycle[:past, None], full_matrices=False)
    known = sizes > 1e-9 * sizes.max(initial=0.0)
    spread = turned[known].T / sizes[known]
    moved = (noise * rng.normal(size=(samples, int(known.sum()))) @ spread.T) @ base[past:].T
    if len(trend.bends):
        steps = np.diff(np.concatenate([days[-1:], future]).astype(float))
        often = min(1.0, len(trend.bends) / max(reach * past, 1.0))
        changes = rng.laplace(0.0, np.abs(trend.changes).mean(), (samples, len(future)))
        slopes = np.cumsum(np.where(rng.random(changes.shape) < often, changes, 0.0), axis=1)
        moved += np.cumsum(slopes * steps, axis=1)
    return moved


def fit_and_extend(
    days: np.ndarray,
    y: np.ndarray,
    future: np.ndarray,
    order: int = 10,
    level: float = 0.8,
    rounds: int = 10,
    changepoints: int = 25,
    looseness: float = 0.05,
    samples: int = 1000,
    seed: int = 42,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Estimate, lower and upper limit over history and future.

    The limits hold the middle ``level`` of the residuals; in the future, of residuals drawn again on
    top of simulated trends, so they widen with the horizon. The draws are fixed by ``seed``.
    """
    trend = fit_trend(days, y, future, order, rounds, changepoints, looseness=looseness)
    past = len(days)
    miss = y - trend.estimate[:past]
    rng = np.random.default_rng(seed)
    moved = simulated_trends(trend, days, future, float(miss.std()), samples, rng) * trend.cycle[past:]
    ahead = moved + rng.choice(miss, moved.shape)
    edges = [(1 - level) / 2, (1 + level) / 2]
    low, high = np.concatenate([np.repeat(np.quantile(miss, edges)[:, None], past, axis=1), np.quantile(ahead, edges, axis=0)], axis=1)
    return trend.estimate, trend.estimate + np.minimum(low, 0.0), trend.estimate + np.maximum(high, 0.0)


def forecast_weekly(
    series: DataFrame,
    keys: Sequence[str] = (),
    week: str = "inicio_sem",
    value: str = "casos_confirmados",
    horizon: int = WEEKS_PER_YEAR,
    level: float = 0.8,
    changepoints: int = 25,
    since: dt.date = FIRST_WEEK,
    until: dt.date | None = None,
) -> DataFrame:
    """Estimate and limits for every past week and the next ``horizon`` Mondays, per key.

    The input is gap-filled first, so that a week split over two years counts once.
    """

    def forecast(group: pd.DataFrame) -> pd.DataFrame:
        past, ahead, days, values = _laid_out(group, week, value, horizon)
        estimate, low, high = fit_and_extend(
            days[: len(past)], values, days[len(past) :], level=level, changepoints=changepoints
        )
        return pd.DataFrame({"ds": past + ahead, "yhat": estimate, "yhat_lower": low, "yhat_upper": high})

    extra = [
        T.StructField("ds", T.DateType()),
        *[T.StructField(name, T.DoubleType()) for name in ("yhat", "yhat_lower", "yhat_upper")],
    ]
    return _per_series(gap_fill_weekly(series, keys, week, value, since, until), keys, forecast, extra)


def _laid_out(group: pd.DataFrame, week: str, value: str, horizon: int) -> tuple[list, list, np.ndarray, np.ndarray]:
    """Past and future Mondays, all of them as day numbers, and the past values."""
    group = group.sort_values(week)
    past = list(group[week])
    ahead = [past[-1] + dt.timedelta(days=7 * step) for step in range(1, horizon + 1)]
    return past, ahead, np.array([day.toordinal() for day in past + ahead]), group[value].to_numpy(dtype=float)


def trend_changes(
    series: DataFrame,
    keys: Sequence[str] = (),
    week: str = "inicio_sem",
    value: str = "casos_confirmados",
    changepoints: int = 25,
    since: dt.date = FIRST_WEEK,
    until: dt.date | None = None,
) -> DataFrame:
    """Where the forecast's trend bends, per key: Monday ``ds``, and the slope per week before and after it."""

    def changes(group: pd.DataFrame) -> pd.DataFrame:
        past, _, days, values = _laid_out(group, week, value, 0)
        found = fit_trend(days, values, days[:0], changepoints=changepoints)
        slopes = 7 * np.diff(found.trend) / np.diff(days) if len(days) > 1 else np.zeros(0)
        return pd.DataFrame(
            {
                "ds": pd.Series([past[place] for place in found.bends], dtype=object),
                "antes": slopes[found.bends - 1],
                "depois": slopes[found.bends - 1] + 7 * found.changes,
            }
        )

    extra = [T.StructField("ds", T.DateType()), T.StructField("antes", T.DoubleType()), T.StructField("depois", T.DoubleType())]
    return _per_series(gap_fill_weekly(series, keys, week, value, since, until), keys, changes, extra)
