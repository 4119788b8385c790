from __future__ import annotations

import datetime as dt
import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from sentinela.operators import clustering, timeseries
from sentinela.plans import reports

MONDAY = dt.date(2018, 1, 1)


def weekly(spark, values, key="PE"):
    rows = [(key, MONDAY + dt.timedelta(days=7 * i), int(v)) for i, v in enumerate(values) if v is not None]
    return spark.createDataFrame(rows, "uf string, inicio_sem date, casos_confirmados bigint")


def test_gaps_are_filled_and_repeated_weeks_summed(spark):
    series = weekly(spark, [3, None, None, 5]).unionByName(weekly(spark, [1]))
    for keys in ([], ["uf"]):
        filled = timeseries.gap_fill_weekly(series, keys).orderBy("inicio_sem").collect()
        assert [r["casos_confirmados"] for r in filled] == [4, 0, 0, 5]


def test_null_keys_are_a_series(spark):
    series = weekly(spark, [3, None, 5]).withColumn("uf", F.lit(None).cast("string"))
    assert [r["casos_confirmados"] for r in timeseries.gap_fill_weekly(series, ["uf"]).orderBy("inicio_sem").collect()] == [3, 0, 5]


def test_stl_recovers_trend_and_season_despite_outliers():
    t = np.arange(468)
    season = 10 * np.sin(2 * np.pi * t / 52)
    y = 50 + 0.05 * t + season + np.random.default_rng(2).normal(0, 0.5, len(t))
    y[[100, 250, 400]] += 200
    trend, seasonal = timeseries.stl(y)
    assert np.abs(trend - (50 + 0.05 * t)).max() < 1
    assert np.abs(seasonal - season).max() < 2
    plain_trend, _ = timeseries.stl(y, robust=False)
    assert np.abs(plain_trend - (50 + 0.05 * t)).max() > np.abs(trend - (50 + 0.05 * t)).max()


def test_local_fit_agrees_with_a_plain_loop():
    rng = np.random.default_rng(1)
    y, weights, width = rng.normal(size=23), rng.uniform(0.2, 1, 23), 9
    x = np.arange(23)
    for at in (-1.0, 0.0, 4.0, 11.0, 22.0, 23.0):
        near = np.argsort(np.abs(x - at), kind="stable")[:width]
        reach = np.abs(near - at).max()
        w = np.where(np.abs(near - at) < 0.999 * reach, (1 - (np.abs(near - at) / reach) ** 3) ** 3, 0) * weights[near]
        slope, level = np.polyfit(near, y[near], 1, w=np.sqrt(w))
        got = timeseries._local_fit(y, np.array([at]), width, weights)[0]
        assert got == pytest.approx(level + slope * at, abs=1e-8)


def test_decomposition_adds_up_per_key(spark):
    t = np.arange(160)
    rows = weekly(spark, 20 + 10 * np.sin(2 * np.pi * t / 52)).unionByName(weekly(spark, [5] * 60, "SP")).unionByName(weekly(spark, [5] * 10, "RJ"))
    parts = timeseries.seasonal_decompose(rows, ["uf"]).toPandas()
    long = parts[parts["uf"] != "RJ"]
    assert np.allclose(long["tendencia"] + long["sazonal"] + long["residuo"], long["observado"])
    assert parts.groupby("uf")["serie_curta"].first().to_dict() == {"PE": False, "SP": True, "RJ": True}
    assert parts[parts["uf"] == "RJ"]["tendencia"].isna().all()
    by_week = timeseries.seasonal_by_week(timeseries.seasonal_decompose(rows, ["uf"]), ["uf"])
    assert by_week.where("uf = 'PE'").count() in (52, 53)


def test_trend_needs_three_years_and_matches_the_published_table(spark):
    rows = [("AA", 2018 + i, n) for i, n in enumerate([8, 11, 13, 10, 12, 9, 10, 9, 6])]
    rows += [("BB", 2018, 1), ("BB", 2019, 2)]
    yearly = spark.createDataFrame(rows, "uf string, ano int, casos_confirmados bigint")
    got = timeseries.linear_trend(yearly, 2018, 2026).collect()
    x, y = np.arange(2018, 2027), [n for uf, _, n in rows if uf == "AA"]
    slope, intercept = np.polyfit(x, y, 1)
    assert len(got) == 1 and (got[0]["casos_2018"], got[0]["casos_2026"]) == (8, 6)
    assert got[0]["slope_anual"] == pytest.approx(slope) and got[0]["intercept"] == pytest.approx(intercept, rel=1e-6)


# Trend per year and level in the middle year 2022 of three states whose nine yearly
# counts are whole numbers; 60 * slope and 9 * level are therefore whole as well.
@pytest.mark.parametrize("slope, intercept, first, last", [
    (-0.65, 1324.0777777776068, 8, 6), (0.2666666666665507, -529.6444444442099, 14, 11), (0.8166666666666278, -1644.2999999999208, 4, 10),
])
def test_yearly_counts_with_a_given_line_reproduce_it(spark, slope, intercept, first, last):
    weighted, total = round(60 * slope), round(9 * (intercept + slope * 2022))
    middle = solve_counts(weighted - 4 * (last - first), total - first - last)
    counts = [first, *middle, last]
    rows = [("UF", 2018 + i, n) for i, n in enumerate(counts)]
    got = timeseries.linear_trend(spark.createDataFrame(rows, "uf string, ano int, casos_confirmados bigint"), 2018, 2026).first()
    assert got["slope_anual"] == pytest.approx(slope, abs=1e-9) and got["intercept"] == pytest.approx(intercept, abs=1e-4)
    assert (got["casos_2018"], got["casos_2026"]) == (first, last)


def test_trend_without_a_range_takes_every_year(spark):
    rows = [("AA", year, year - 2000) for year in (2009, 2012, 2031)] + [("BB", year, 5) for year in (2012, 2013, 2014)]
    got = timeseries.linear_trend(spark.createDataFrame(rows, "uf string, ano int, casos_confirmados bigint")).collect()
    found = {row["uf"]: (round(row["slope_anual"], 9), row["casos_primeiro_ano"], row["casos_ultimo_ano"]) for row in got}
    assert found == {"AA": (1.0, 9, 31), "BB": (0.0, 0, 0)}


def solve_counts(weighted: int, total: int) -> list[int]:
    """Seven whole numbers for places -3..3 with the given weighted and plain sums."""
    counts = [0] * 7
    counts[3] = total
    step = 1 if weighted > 0 else -1
    while weighted:
        move = min(3, abs(weighted))
        counts[3 + step * move] += 1
        counts[3] -= 1
        weighted -= step * move
    return counts


def test_forecast_continues_a_seasonal_series(spark):
    t = np.arange(52 * 5)
    level = lambda i: (100 + 0.2 * i) * (1 + 0.3 * np.sin(2 * np.pi * i * 7 / 365.25))
    rows = weekly(spark, np.rint(level(t)))
    out = timeseries.forecast_weekly(rows).orderBy("ds").toPandas()
    assert len(out) == len(t) + 52
    assert (out["yhat_lower"] <= out["yhat"]).all() and (out["yhat"] <= out["yhat_upper"]).all()
    ahead = np.arange(len(t), len(t) + 52)
    assert np.abs(out["yhat"].to_numpy()[-52:] / level(ahead) - 1).max() < 0.05
    assert all(day.weekday() == 0 for day in out["ds"])
    bands = reports.forecast_bands(timeseries.forecast_weekly(rows))
    assert bands.count() == 3 * len(out)


def bent(weeks, bends, noise, seed=1):
    """Weekly values whose slope changes by 0.8 up or down at the given weeks, times a yearly cycle."""
    t = np.arange(weeks)
    line = 100 + 0.3 * t + sum((-1) ** (i + 1) * 0.8 * np.maximum(t - week, 0) for i, week in enumerate(bends))
    return line * (1 + 0.2 * np.sin(2 * np.pi * t * 7 / 365.25)) + np.random.default_rng(seed).normal(0, noise, weeks)


@pytest.mark.parametrize("bends, noise", [((150, 300), 1), ((150, 300), 4), ((100,), 2), ((60, 200, 280), 2), ((120, 131), 1)])
def test_known_bends_are_found_within_two_weeks(bends, noise):
    days = np.arange(468) * 7.0
    found = timeseries.fit_trend(days, bent(468, bends, noise), days[:0])
    assert found.unsolved < 0.01
    large = found.bends[np.abs(found.changes) * 7 > 0.3]
    assert len(large) == len(bends) and np.abs(large - np.array(bends)).max() <= 2
    # What else bends does so by less than a tenth.
    assert np.abs(np.delete(found.changes, np.flatnonzero(np.abs(found.changes) * 7 > 0.3)) * 7).max(initial=0) < 0.1


def test_a_straight_line_stays_straight():
    days = np.arange(468) * 7.0
    found = timeseries.fit_trend(days, bent(468, (), 2), days[:0])
    assert np.abs(found.changes * 7).max(initial=0) < 0.05


def test_coordinate_descent_meets_the_optimality_conditions():
    rng = np.random.default_rng(9)
    x, y = rng.normal(size=(80, 12)), rng.normal(size=80)
    gram, target = x.T @ x, x.T @ y
    for limit in (0.5, 5.0, 1e3):
        b = timeseries.lasso(gram, target, limit, np.zeros(12))
        rest = target - gram @ b
        assert np.abs(rest[b == 0]).max(initial=0) <= limit * (1 + 1e-5)
        assert np.allclose(rest[b != 0], limit * np.sign(b[b != 0]), rtol=1e-4)
    assert not b.any()


def test_limits_widen_with_the_horizon_and_cover_what_comes():
    rng = np.random.default_rng(11)
    inside, first, last = [], [], []
    for _ in range(40):
        slopes = 0.2 + np.cumsum(np.where(rng.random(364) < 6 / 312, rng.laplace(0, 0.5, 364), 0))
        y = 400 + np.cumsum(slopes) + rng.normal(0, 3, 364)
        days = np.arange(364) * 7.0
        _, low, high = timeseries.fit_and_extend(days[:312], y[:312], days[312:])
        inside.append(((y[312:] >= low[312:]) & (y[312:] <= high[312:])).mean())
        first.append(high[312] - low[312])
        last.append(high[-1] - low[-1])
    assert np.mean(last) > 2 * np.mean(first)
    assert 0.6 < np.mean(inside) < 0.95


def test_bends_of_each_key(spark):
    rows = weekly(spark, np.rint(bent(300, (150,), 1) * 10)).unionByName(weekly(spark, [5] * 60, "SP")).unionByName(weekly(spark, [5], "RJ"))
    found = timeseries.trend_changes(rows, ["uf"]).collect()
    assert {r["uf"] for r in found} == {"PE"}
    largest = max(found, key=lambda r: abs(r["depois"] - r["antes"]))
    assert abs((largest["ds"] - MONDAY).days / 7 - 150) <= 2
    assert largest["antes"] == pytest.approx(3, abs=0.5) and largest["depois"] == pytest.approx(-5, abs=0.5)


def test_a_mistyped_date_is_refused_and_does_not_stretch_the_series(spark):
    far = spark.createDataFrame(
        [("PE", dt.date(9999, 12, 27), 4), ("PE", dt.date(201, 3, 2), 1), ("PE", None, 2)], "uf string, inicio_sem date, casos_confirmados bigint"
    )
    series = weekly(spark, [3, None, 5]).unionByName(far)
    assert timeseries.gap_fill_weekly(series, ["uf"]).count() == 3
    refused = {(r["inicio_sem"], r["motivo"], r["casos_confirmados"]) for r in timeseries.refused_weeks(series, ["uf"]).collect()}
    assert refused == {(dt.date(9999, 12, 27), "inicio_sem:late", 4), (dt.date(201, 3, 2), "inicio_sem:early", 1), (None, "inicio_sem:missing", 2)}
    assert timeseries.gap_fill_weekly(series, ["uf"], until=MONDAY).count() == 1
    assert timeseries.forecast_weekly(series, ["uf"]).count() == 3 + 52


def test_forecast_of_a_single_week_and_of_zeros(spark):
    for values in ([4], [0] * 60):
        out = timeseries.forecast_weekly(weekly(spark, values), ["uf"]).toPandas()
        assert len(out) == len(values) + 52 and np.isfinite(out["yhat"]).all()


@pytest.mark.parametrize("function, call", [
    (timeseries.stl, "len(f(numpy.arange(104.0))[0])"),
    (timeseries.fit_and_extend, "len(f(numpy.arange(52.0) * 7, numpy.ones(52), numpy.arange(52.0, 104) * 7)[0])"),
    (clustering.squared_distances, "len(f(numpy.ones((104, 2)), numpy.ones((3, 2))))"),
])
def test_task_functions_run_where_the_package_is_not_installed(tmp_path, function, call):
    code = f"import sys, pickle, numpy; f = pickle.loads(sys.stdin.buffer.read()); print({call})"
    done = subprocess.run(
        [sys.executable, "-c", code], input=cloudpickle.dumps(function), cwd=tmp_path, capture_output=True, check=True
    )
    assert done.stdout.strip() == b"104"


def clouds(spark, per=40):
    rng = np.random.default_rng(3)
    centres = [(0, 0), (10, 0), (0, 10)]
    rows = [(g, float(x + rng.normal(0, 0.5)), float(y + rng.normal(0, 0.5))) for g, (x, y) in enumerate(centres) for _ in range(per)]
    return spark.createDataFrame(rows, "grupo int, x double, y double")


def test_standardize(spark):
    rows = spark.createDataFrame([(1.0, 5), (3.0, 5), (None, 5)], "x double, c int")
    z = clustering.standardize(rows, ["x", "c"]).toPandas()
    x = np.array([1.0, 3.0, 0.0])
    assert np.allclose(np.sort(z["x_z"]), np.sort((x - x.mean()) / x.std())) and (z["c_z"] == 0).all()


def test_silhouette_against_brute_force(spark):
    rows = clouds(spark, 12).withColumn("um", F.lit(1)).withColumn("so", F.when(F.col("x") > 10.5, 7).otherwise(F.col("grupo")))
    pdf = rows.toPandas()
    points = pdf[["x", "y"]].to_numpy()
    want = {}
    for k, column in {3: "grupo", 4: "so", 1: "um"}.items():
        labels, scores = pdf[column].to_numpy(), []
        for i, p in enumerate(points):
            gap = ((points - p) ** 2).sum(axis=1)
            own, others = labels == labels[i], set(labels) - {labels[i]}
            if own.sum() == 1 or not others:
                scores.append(0.0)
                continue
            a = gap[own].sum() / (own.sum() - 1)
            b = min(gap[labels == g].mean() for g in others)
            scores.append((b - a) / max(a, b))
        want[k] = np.mean(scores)
    got = clustering.silhouette_scores(rows, ["x", "y"], {3: "grupo", 4: "so", 1: "um"}).collect()
    assert {row["k"]: row["silhouette"] for row in got} == pytest.approx(want)


def test_kmeans_finds_three_clouds(spark):
    clusters = clustering.kmeans_municipalities(clouds(spark), ["x", "y"], k_max=5, restarts=2)
    best = clustering.best_k(clusters.scores).first()
    assert best["k"] == 3
    assert clusters.members.select("grupo", "cluster").distinct().count() == 3
    assert clusters.centroids.count() == 3
    heat = clustering.centroid_heatmap(clusters.centroids, ["x", "y"]).agg(F.avg("x_z")).first()[0]
    assert abs(heat) < 1e-9


def plain_lloyd(x, centres, rounds):
    for _ in range(rounds):
        gaps = ((x[:, None, :] - centres[None]) ** 2).sum(axis=2)
        own = gaps.argmin(axis=1)
        centres = np.stack([x[own == j].mean(axis=0) if (own == j).any() else centres[j] for j in range(len(centres))])
    return centres, gaps.min(axis=1).sum()


@pytest.mark.parametrize("parts", [1, 5])
def test_models_that_step_together_move_like_each_alone(spark, parts):
    rows = clouds(spark)
    points = clustering.coordinates(rows, ["x", "y"]).repartition(parts)
    x = rows.select("x", "y").toPandas().to_numpy()
    starts = [x[[0, 1]], x[[0, 50, 100]], x[[3, 4, 5, 6]], np.array([[0.0, 0.0], [99.0, 99.0]])]
    for rounds in (1, 4):
        fits = clustering.lloyd(points, starts, max_rounds=rounds, tol=-1.0)
        assert fits.rounds == rounds
        for start, centres, cost in zip(starts, fits.centres, fits.costs):
            want, want_cost = plain_lloyd(x, start, rounds)
            assert np.allclose(centres, want) and cost == pytest.approx(want_cost)
    fits = clustering.lloyd(points, starts)
    within = clustering.lloyd(points.coalesce(1), starts, one_task=True)
    assert within.rounds == fits.rounds and np.allclose(within.costs, fits.costs)
    assert all(np.allclose(one, other) for one, other in zip(within.centres, fits.centres))
    for centres in fits.centres:
        assert np.allclose(plain_lloyd(x, centres, 1)[0], centres)
    assert list(fits.centres[3][1]) == [99.0, 99.0]  # without points


def test_seeds_do_not_depend_on_the_partitions_and_lie_apart(spark):
    rows = clouds(spark)
    points = clustering.coordinates(rows, ["x", "y"])
    tries = [(3, seed) for seed in range(6)]
    one, many = clustering.seeded(points, tries), clustering.seeded(points.repartition(7), tries)
    assert all(np.allclose(a, b) for a, b in zip(one, many))
    apart = sum(len({(round(p[0] / 10), round(p[1] / 10)) for p in start}) == 3 for start in one)
    assert apart >= 5
    assert len({start.tobytes() for start in one}) > 1


def test_all_restarts_are_kept_and_the_cheapest_wins(spark):
    rows = clouds(spark).drop("grupo")
    tries = [(k, seed) for k in (2, 3) for seed in range(4)]
    fits = clustering.fit_all(rows, ["x", "y"], tries)
    assert len(fits.centres) == len(fits.costs) == 8
    labelled = clustering.label_by_k(rows, ["x", "y"], k_max=3, restarts=4, seed=0).toPandas()
    z = labelled[["x_z", "y_z"]].to_numpy()
    for k in (2, 3):
        own = labelled[f"cluster_{k}"].to_numpy()
        centres = np.stack([z[own == j].mean(axis=0) for j in range(k)])
        assert (((z[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1) == own).all()


def test_points_that_are_all_equal(spark):
    rows = spark.createDataFrame([(1.0, 2.0)] * 12, "x double, y double")
    members = clustering.kmeans_municipalities(rows, ["x", "y"], k_max=3, restarts=2).members
    assert members.select("cluster").distinct().count() == 1


def test_kmeans_skips_few_rows(spark):
    assert clustering.kmeans_municipalities(clouds(spark, 3), ["x", "y"]) is None


def test_best_k_prefers_the_smaller_k(spark):
    scores = spark.createDataFrame([(4, 0.5), (2, 0.5), (3, 0.4)], "k int, silhouette double")
    assert clustering.best_k(scores).first()["k"] == 2
