from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from sentinela.operators import rules
from sentinela.schemas import states

D = dt.date


def errors(rows):
    return {r["id_notif"]: (list(r["errors"]), list(r["warnings"])) for r in rows.collect()}


def test_clinical_rules(fact):
    day = D(2024, 6, 10)
    rows = fact(
        {"dt_sintomas": day, "dt_notificacao": D(2024, 6, 9)},
        {"dt_sintomas": day, "dt_obito": D(2024, 6, 1), "cod_sexo": "M", "cod_classificacao": 1, "cod_evolucao": 1},
        {"dt_sintomas": day, "dt_notificacao": D(2024, 6, 11), "dt_encerramento": D(2024, 6, 10)},
        {"cod_evolucao": 2},
        {"dt_sintomas": day, "cod_sexo": "M", "cod_gestante": 1, "cod_classificacao": 1},
        {"cod_gestante": 1},
        {"cod_gestante": 4, "cod_sexo": "F"},
        {"cod_gestante": 5, "cod_sexo": "M"},
        {"idade_anos": Decimal("121.00")},
        {"sem_sintomas": 0},
        {"sem_sintomas": 53},
        {"sem_sintomas": 54},
        {"dt_sintomas": day, "ano_nascimento": 2025},
        {"dt_sintomas": day, "ano_nascimento": 2024},
        {},
    )
    assert errors(rules.validate_clinical(rows)) == {
        1: (["A1"], []), 2: (["A2", "B2"], []), 3: (["A3"], []), 4: ([], ["B1"]), 5: (["C"], []), 6: ([], []),
        7: ([], []), 8: ([], []), 9: (["D"], []), 10: (["E"], []), 11: ([], []), 12: (["E"], []), 13: (["F"], []),
        14: ([], []), 15: ([], []),
    }


def test_first_error_follows_rule_order(fact):
    row = rules.validate_clinical(
        fact({"dt_sintomas": D(2024, 6, 10), "dt_obito": D(2024, 6, 1), "cod_evolucao": 1, "sem_sintomas": 99})
    ).first()
    assert row["first_error"] == "A2"


def test_derived_age_escapes_the_range_rule_unless_checked(fact):
    rows = fact({"nu_idade_codificada": 4130})
    assert errors(rules.validate_clinical(rows)) == {1: ([], [])}
    assert errors(rules.validate_clinical(rows, check_derived=True)) == {1: (["D"], [])}


def test_fill_derived(fact):
    rows = rules.fill_derived(
        fact(
            {"nu_idade_codificada": 2364, "dt_sintomas": D(2024, 12, 30)},
            {"dt_sintomas": D(2024, 1, 1), "nu_ano": 1999, "sem_sintomas": 7, "faixa_etaria": "x", "idade_anos": Decimal("3.00")},
        )
    )
    got = [(r["idade_anos"], r["faixa_etaria"], r["nu_ano"], r["sem_sintomas"]) for r in rows.orderBy("id_notif").collect()]
    assert got == [(Decimal("1.00"), "1-4", 2025, 1), (Decimal("3.00"), "x", 1999, 7)]
    assert rules.fill_derived(fact({})).first()["faixa_etaria"] is None


def test_insert_rules(spark, fact):
    good = {"dt_sintomas": D(2024, 6, 10), "cod_sexo": "F", "cod_classificacao": 1, "cod_uf_resi": 26}
    rows = fact(
        good,
        {**good, "dt_sintomas": None},
        {**good, "dt_sintomas": D(2024, 7, 2)},
        {**good, "dt_sintomas": D(2009, 12, 31)},
        {**good, "dt_notificacao": D(2024, 6, 9)},
        {**good, "dt_obito": D(2024, 6, 9)},
        {**good, "cod_sexo": None},
        {**good, "cod_classificacao": 5},
        {**good, "cod_uf_resi": 99},
        {**good, "cod_uf_resi": None, "nu_idade_codificada": 4025},
    )
    checked = rules.validate_insert(rows, states(spark), today=D(2024, 7, 1))
    found = {r["id_notif"]: list(r["errors"]) for r in checked.collect()}
    assert found == {1: [], 2: ["I1"], 3: ["I2"], 4: ["I3"], 5: ["I4"], 6: ["I5"], 7: ["I6"], 8: ["I7"], 9: ["I8"], 10: []}
    last = checked.where("id_notif = 10").first()
    assert (last["idade_anos"], last["faixa_etaria"], last["nu_ano"], last["sem_sintomas"]) == (Decimal("25.00"), "20-29", 2024, 24)


def test_quarantine_modes(fact):
    checked = rules.validate_clinical(fact({"sem_sintomas": 0}, {}))
    counts = {m: tuple(p.count() for p in rules.split_quarantine(checked, m)) for m in ("enforce", "report", "off")}
    assert counts == {"enforce": (1, 1), "report": (2, 1), "off": (2, 0)}
    with pytest.raises(ValueError):
        rules.split_quarantine(checked, "maybe")


def test_rule_report(fact):
    checked = rules.validate_clinical(fact({"sem_sintomas": 0}, {"sem_sintomas": 54}, {"cod_evolucao": 2}, {}))
    assert {tuple(r) for r in rules.rule_report(checked).collect()} == {("E", "erro", 2), ("B1", "aviso", 1)}
