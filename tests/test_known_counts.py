"""Counts known beforehand for the derived tables at the second data size."""

from __future__ import annotations

import pytest

import __spark_entry__ as registry

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def run(spark):
    return lambda name: registry.queries()[name](spark, FOLDER)


def test_rule_hits(run):
    hits = {row["regra"]: row["n_linhas"] for row in run("rule_report").collect()}
    assert hits == {"A1": 380, "A2": 173, "A3": 334, "B1": 969, "B2": 33, "C": 167, "D": 936, "E": 169, "F": 149}


@pytest.mark.parametrize("name, rows", [
    ("weekly_series_state", 7069), ("epi_summary", 208), ("notification_latency", 208), ("detect_duplicates", 161),
    ("municipality_features", 221), ("linear_trend", 25), ("admit_rows", 13041), ("distinct_health_units", 97),
])
def test_row_counts(run, name, rows):
    assert run(name).count() == rows


def test_classifications(run):
    kpis = run("kpis").first()
    assert (kpis["total_notificacoes"], kpis["total_confirmados"], kpis["total_descartados"]) == (15000, 4674, 4727)
