from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sentinela.operators import audit, duplicates
from sentinela.plans import reports

D = dt.date
CASE = {"cod_mun_resi": 261160, "cod_sexo": "F", "idade_anos": Decimal("25.00")}


def ids(fact, **options):
    """Member ids of every group, from the long form; the short form must have the same groups."""
    members, groups = {}, duplicates.detect_duplicates(fact, **options)
    for row in duplicates.duplicate_members(fact, **options).collect():
        members.setdefault(tuple(row[name] for name in groups.columns), []).append(row["id_notif"])
    assert sorted(map(str, members)) == sorted(str(tuple(row)) for row in groups.collect())
    assert all(key[1] == len(found) for key, found in members.items())
    return sorted(sorted(found) for found in members.values())


def test_buckets_restart_at_new_year_while_windows_do_not(fact):
    rows = fact({**CASE, "dt_sintomas": D(2024, 1, 2)}, {**CASE, "dt_sintomas": D(2023, 12, 31)})
    assert ids(rows) == []
    assert ids(rows, mode="window") == [[1, 2]]


def test_missing_ages_group_over_all_dates(fact):
    old = {**CASE, "idade_anos": None}
    rows = fact({**old, "dt_sintomas": D(2023, 5, 1)}, {**old, "dt_sintomas": D(2024, 5, 1)})
    group = duplicates.detect_duplicates(rows).first()
    assert group["grupo_hash"] is None and group["idade_anos"] is None and group["n_ocorrencias"] == 2
    assert (group["dt_sintomas_min"], group["dt_sintomas_max"]) == (D(2023, 5, 1), D(2024, 5, 1))
    assert ids(rows, drop_null_age=True) == []


def test_rows_without_place_sex_or_date_are_not_compared(fact):
    day = {"dt_sintomas": D(2024, 5, 1)}
    rows = fact({**day, **CASE, "cod_sexo": None}, {**day, **CASE, "cod_sexo": None}, {**CASE}, {**CASE})
    assert ids(rows) == []


def test_ages_are_compared_rounded_half_up(fact):
    day = {"dt_sintomas": D(2024, 5, 1)}
    rows = fact({**CASE, **day, "idade_anos": Decimal("24.50")}, {**CASE, **day}, {**CASE, **day, "idade_anos": Decimal("25.50")})
    assert ids(rows) == [[1, 2]]


@pytest.mark.parametrize("mode", ["bucket", "window"])
def test_a_large_group_is_one_row_and_all_its_members(fact, mode):
    day = {"dt_sintomas": D(2024, 5, 1)}
    rows = fact(*[{**CASE, **day}] * 50, {**CASE, **day, "cod_sexo": "M"})
    assert ids(rows, mode=mode) == [list(range(1, 51))]


def test_the_largest_groups_are_different_groups(fact):
    """One group that dwarfs the others does not hide them."""
    large = [{**CASE, "dt_sintomas": D(2024, 5, 1)}] * 400
    pairs = [{**CASE, "cod_mun_resi": 261000 + i, "dt_sintomas": D(2024, 6, 3)} for i in range(30) for _ in range(2)]
    top = reports.duplicate_top(duplicates.detect_duplicates(fact(*large, *pairs))).collect()
    assert len({row["grupo_hash"] for row in top}) == 20
    assert [row["n_ocorrencias"] for row in top] == [400, *[2] * 19]


def test_windows_chain_close_dates(spark):
    days = [1, 3, 6, 10, 13, 20]
    rows = spark.createDataFrame([("k", D(2024, 5, d)) for d in days] + [("k", D(2024, 5, 3))], "k string, d date")
    runs = {r["d"].day: r["inicio_grupo"].day for r in duplicates.duplicate_window(rows, ["k"], "d", 3).collect()}
    assert runs == {1: 1, 3: 1, 6: 1, 10: 10, 13: 10, 20: 20}


def snapshot(spark, *rows):
    return spark.createDataFrame(list(rows), "id_notif bigint, cod_classificacao int, dt_obito date")


def test_audit_of_equal_snapshots_is_empty(spark):
    rows = snapshot(spark, (1, 2, None), (2, None, D(2024, 1, 1)))
    assert audit.audit_diff(rows, rows, ["id_notif"], "t").isEmpty()


def test_audit_of_changes(spark):
    before = snapshot(spark, (1, 2, None), (2, None, None), (3, 1, None), (4, 1, D(2024, 1, 1)), (6, 0, None))
    after = snapshot(spark, (1, 1, None), (2, 0, None), (4, 1, None), (5, 2, None), (6, 0, None))
    log = {r["pk_alvo"]: r for r in audit.audit_diff(before, after, ["id_notif"], "t").collect()}
    assert {k: r["operacao"] for k, r in log.items()} == {"1": "U", "2": "U", "3": "D", "4": "U", "5": "I"}
    change = log["1"]["diff"]["cod_classificacao"]
    assert (change["de"], change["para"]) == ("2", "1") and set(log["1"]["diff"]) == {"cod_classificacao"}
    assert log["2"]["diff"]["cod_classificacao"]["de"] is None
    assert log["4"]["diff"]["dt_obito"]["para"] is None
    assert log["3"]["diff"] is None and log["3"]["dados_depois"] is None
    assert json.loads(log["5"]["dados_depois"]) == {"id_notif": 5, "cod_classificacao": 2, "dt_obito": None}


def test_diff_applied_to_before_gives_after(spark):
    before = snapshot(spark, *[(i, i % 3, None) for i in range(30)])
    after = snapshot(spark, *[(i, (i * 7) % 3, D(2024, 1, 1) if i % 4 == 0 else None) for i in range(30)])
    state = {r["id_notif"]: {"cod_classificacao": r["cod_classificacao"], "dt_obito": r["dt_obito"]} for r in before.collect()}
    for row in audit.audit_diff(before, after, ["id_notif"], "t").collect():
        for name, change in row["diff"].items():
            value = change["para"]
            state[int(row["pk_alvo"])][name] = value if value is None or name == "dt_obito" else int(value)
    want = {r["id_notif"]: (r["cod_classificacao"], r["dt_obito"] and str(r["dt_obito"])) for r in after.collect()}
    assert {k: (v["cod_classificacao"], v["dt_obito"]) for k, v in state.items()} == want


def test_backfill_points_only_to_living_rows(spark):
    log = spark.createDataFrame([("fato_notificacao", "1"), ("fato_notificacao", "9"), ("dim_uf", "1"), ("fato_notificacao", None), ("fato_notificacao", "a")], "tabela string, pk_alvo string")
    fact = spark.createDataFrame([(1,)], "id_notif bigint")
    got = {tuple(r) for r in audit.audit_ref_backfill(log, fact).collect()}
    assert got == {("fato_notificacao", "1", 1), ("fato_notificacao", "9", None), ("dim_uf", "1", None), ("fato_notificacao", None, None), ("fato_notificacao", "a", None)}


def test_log_defaults(spark):
    entries = audit.audit_diff(snapshot(spark), snapshot(spark, (1, 1, None)), ["id_notif"], "t")
    row = audit.audit_log(entries).first()
    assert row["usuario_db"] and row["momento"]
