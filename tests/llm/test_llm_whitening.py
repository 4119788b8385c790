from __future__ import annotations

import math

import numpy as np
import pytest

from sentinela.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n string, z string, index string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, None, "x", "n", "z", "i") for i, v in rows], SCHEMA)


def by_definition(rows, components=4):
    usable = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    as_long = [(i, tuple(math.floor(256 * float(np.float32(c))) for c in v)) for i, v in usable]
    fit = np.array(sorted({x for _, x in as_long}), dtype=float)
    n, mean = len(fit), fit.mean(axis=0)
    values, directions = np.linalg.eigh((fit - mean).T @ (fit - mean) / n)
    values, directions = values[::-1], directions[:, ::-1]
    exact = [sum(int(c) for c in column) for column in fit.T]
    out = {}
    for i, x in as_long:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, exact))
        for c in range(min(components, len(x))):
            out[i, c + 1] = (n, deviation, (np.array(x) - mean) @ directions[:, c] / math.sqrt(values[c]), values[c] / values.sum())
    return out


def check(got, want):
    assert {(r["vec_id"], r["component"]) for r in got} == set(want)
    signs = {}
    for r in got:
        n, deviation, value, explained = want[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert math.isclose(r["explained"], explained, rel_tol=1e-9)
        assert r["identity_error"] < 1e-9
        if abs(value) > 1e-6:
            sign = signs.setdefault(r["component"], math.copysign(1, value * r["whitened"]))
            assert math.isclose(sign * r["whitened"], value, rel_tol=1e-7, abs_tol=1e-9)


@pytest.mark.parametrize("block_rows", [7, 1024])
def test_equal_to_the_definition(spark, block_rows):
    rng = np.random.default_rng(4)
    spread = np.diag([3.0, 2.0, 1.5, 1.0, 0.5, 0.2]) @ rng.normal(size=(6, 6))
    data = (rng.normal(size=(150, 6)) @ spread).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(data)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)]
    got = whitening.whitened(vectors(spark, rows), block_rows=block_rows).collect()
    check(got, by_definition(rows))


def test_hard_vectors(spark):
    good = [(1, [0.5, -1.0]), (2, [1.25, 0.75]), (2, [1.25, 0.75]), (None, [-0.5, 2.0]), (4, [0.001, -0.001])]
    bad = [(5, None), (6, [1.0, None]), (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (9, [])]
    got = whitening.whitened(vectors(spark, good + bad)).collect()
    assert len(got) == 2 * len(good)
    check(got, by_definition(good))
    assert whitening.whitened(vectors(spark, [])).count() == 0
    assert whitening.whitened(vectors(spark, bad)).count() == 0
    with pytest.raises(ValueError):
        whitening.whitened(vectors(spark, [(1, [1.0]), (2, [1.0, 2.0])]))


def test_components_without_variance(spark):
    one = whitening.whitened(vectors(spark, [(1, [1.0, 2.0, 3.0])] * 3)).collect()
    assert len(one) == 9 and all(r["whitened"] is None and r["explained"] is None and r["identity_error"] is None for r in one)
    assert all((r["n"], r["deviation"]) == (1, 0) for r in one)
    line = whitening.whitened(vectors(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(5)])).collect()
    first = [r for r in line if r["component"] == 1]
    assert all(math.isclose(r["explained"], 1.0) for r in first) and all(r["identity_error"] < 1e-9 for r in line)
    assert all(r["whitened"] is None for r in line if r["component"] > 1)


def test_the_work_of_the_product_is_cut(spark):
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(90, 3))
    matrix = whitening.IndexedRowMatrix(
        spark.sparkContext.parallelize([whitening.IndexedRow(i, v) for i, v in enumerate(rows)], 3), 90, 3
    ).toBlockMatrix(8, 3)
    for cuts in (1, 4, 12):
        assert np.allclose(whitening.gram(matrix, cuts), rows.T @ rows)
