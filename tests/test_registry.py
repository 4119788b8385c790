"""Every registered query against its checking SQL, or at least to its end."""

from __future__ import annotations

import pytest
from compare import connect, differences

import __spark_entry__ as registry

FOLDER = "/root/testdata/sf0.001"
CHECKS = registry.oracle_sql()
# The smallest data has hardly any municipality with 30 forms and hardly any duplicates; these are
# compared at the next size.
LARGER = {
    "best_k",
    "detect_duplicates",
    "detect_duplicates_crowded",
    "duplicate_members",
    "duplicate_top",
    "duplicate_window",
    "municipality_features",
    "silhouette_scores",
    "sql_duplicates",
    "standardize",
}


@pytest.fixture(scope="module")
def engines():
    return {folder: connect(folder) for folder in (FOLDER, "/root/testdata/sf0.01")}


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_its_check(spark, engines, name):
    folder = "/root/testdata/sf0.01" if name in LARGER else FOLDER
    assert differences(spark, folder, name, registry.queries()[name], CHECKS[name], engines[folder]) == []


# Too few municipalities to cluster in the smallest data; tests/test_series.py clusters points.
CLUSTERS = {"kmeans_municipalities", "silhouette_by_k", "centroid_heatmap"}


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(CHECKS) - CLUSTERS))
def test_query_without_check_runs(spark, name):
    assert not registry.queries()[name](spark, FOLDER).isEmpty()


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(registry.queries())


def test_entry(spark):
    assert registry.entry(spark).columns == [
        "uf", "regiao", "ano", "semana_epi", "inicio_sem", "casos_total", "casos_confirmados",
    ]
