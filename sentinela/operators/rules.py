"""Clinical validation as data: each rule adds its code to a row's errors or warnings.

A comparison with NULL is NULL, and a NULL condition adds nothing, so missing values never break
a rule by accident. Rules keep their order: ``first_error`` is the one that would have stopped
the insert.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentinela.functions.ages import age_band, decode_age, stored_age
from sentinela.functions.dates import iso_week, iso_year
from sentinela.operators.filters import pregnant
from sentinela.schemas import CODE_LISTS, CURED, DIED


# Fixed value: symptoms before this day are taken for typing errors.
EARLIEST = dt.date(2010, 1, 1)


class Rule(NamedTuple):
    code: str
    broken: Column
    warning: bool = False


class Quarantine(NamedTuple):
    passed: DataFrame
    blocked: DataFrame


def clinical_rules() -> list[Rule]:
    """Rules of the row check before insert or update."""
    symptoms, notified = F.col("dt_sintomas"), F.col("dt_notificacao")
    death, closed = F.col("dt_obito"), F.col("dt_encerramento")
    age, week = F.col("idade_anos"), F.col("sem_sintomas")
    outcome = F.col("cod_evolucao")
    return [
        Rule("A1", notified < symptoms),
        Rule("A2", death < symptoms),
        Rule("A3", closed < notified),
        Rule("B1", (outcome == DIED) & death.isNull(), warning=True),
        Rule("B2", death.isNotNull() & (outcome == CURED)),
        Rule("C", pregnant() & (F.col("cod_sexo") != "F")),
        Rule("D", ~age.between(0, 120)),
        Rule("E", ~week.between(1, 53)),
        Rule("F", F.col("ano_nascimento") > F.year(symptoms)),
    ]


def insert_rules(today: Column, earliest: Column) -> list[Rule]:
    """Rules of the validated insert; ``uf_conhecida`` says whether the state code exists."""
    symptoms = F.col("dt_sintomas")

    def unlisted(column: str, name: str) -> Column:
        codes = [code for code, _ in CODE_LISTS[name]]
        return ~F.coalesce(F.col(column).isin(*codes), F.lit(False))

    return [
        Rule("I1", symptoms.isNull()),
        Rule("I2", symptoms > today),
        Rule("I3", symptoms < earliest),
        Rule("I4", F.col("dt_notificacao") < symptoms),
        Rule("I5", F.col("dt_obito") < symptoms),
        Rule("I6", unlisted("cod_sexo", "sexo")),
        Rule("I7", unlisted("cod_classificacao", "classificacao")),
        Rule("I8", F.col("cod_uf_resi").isNotNull() & F.col("uf_conhecida").isNull()),
    ]


def broken_codes(rules: list[Rule]) -> Column:
    if not rules:
        return F.array().cast("array<string>")
    # Flattening is compiled with the rest, unlike a filter by a lambda.
    none = F.array().cast("array<string>")
    return F.flatten(F.array(*[F.when(rule.broken, F.array(F.lit(rule.code))).otherwise(none) for rule in rules]))


def apply_rules(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``errors``, ``warnings`` and ``first_error``."""
    return rows.withColumns(
        {
            "errors": broken_codes([rule for rule in rules if not rule.warning]),
            "warnings": broken_codes([rule for rule in rules if rule.warning]),
        }
    ).withColumn("first_error", F.try_element_at("errors", F.lit(1)))


def fill_derived(rows: DataFrame) -> DataFrame:
    """Fill missing age, band, ISO year and ISO week from the row's own values.

    The band follows the stored two-decimal age and stays NULL without an age.
    """
    filled = rows.withColumn(
        "idade_anos",
        F.coalesce(F.col("idade_anos").cast("decimal(5,2)"), stored_age(F.col("nu_idade_codificada"))),
    )
    age, symptoms = F.col("idade_anos"), F.col("dt_sintomas")
    return filled.withColumns(
        {
            "faixa_etaria": F.coalesce("faixa_etaria", F.when(age.isNotNull(), age_band(age))),
            "nu_ano": F.coalesce("nu_ano", iso_year(symptoms)),
            "sem_sintomas": F.coalesce("sem_sintomas", iso_week(symptoms)),
        }
    )


def validate_clinical(rows: DataFrame, check_derived: bool = False) -> DataFrame:
    """Check the clinical rules, then fill derived columns.

    The rules see the row as it arrived, so an age derived afterwards is not range-checked;
    ``check_derived`` fills first.
    """
    if check_derived:
        return apply_rules(fill_derived(rows), clinical_rules())
    return fill_derived(apply_rules(rows, clinical_rules()))


def known_state(rows: DataFrame, dim_uf: DataFrame) -> DataFrame:
    """Add ``uf_conhecida``, the state code if the dimension has it."""
    codes = dim_uf.select(F.col("cod_uf").alias("uf_conhecida"))
    return rows.join(codes, rows["cod_uf_resi"] == codes["uf_conhecida"], "left")


def validate_insert(
    rows: DataFrame,
    dim_uf: DataFrame,
    today: dt.date | None = None,
    earliest: dt.date = EARLIEST,
) -> DataFrame:
    """Check new rows and derive age, band, ISO year and ISO week from code and symptom date."""
    day = F.current_date() if today is None else F.lit(today)
    checked = apply_rules(known_state(rows, dim_uf), insert_rules(day, F.lit(earliest)))
    age = decode_age(F.col("nu_idade_codificada"))
    return checked.drop("uf_conhecida").withColumns(
        {
            "idade_anos": age.cast("decimal(5,2)"),
            "faixa_etaria": age_band(age),
            "nu_ano": iso_year(F.col("dt_sintomas")),
            "sem_sintomas": iso_week(F.col("dt_sintomas")),
        }
    )


def split_quarantine(validated: DataFrame, mode: str = "enforce") -> Quarantine:
    """Separate rows with errors.

    ``enforce`` keeps them out, ``report`` lets them pass but still lists them, and ``off``, the
    bulk-load setting, lets everything pass and lists nothing.
    """
    faulty = F.size("errors") > 0
    if mode == "enforce":
        return Quarantine(validated.where(~faulty), validated.where(faulty))
    if mode == "report":
        return Quarantine(validated, validated.where(faulty))
    if mode == "off":
        return Quarantine(validated, validated.where(F.lit(False)))
    raise ValueError(f"unknown quarantine mode: {mode}")


def rule_report(validated: DataFrame) -> DataFrame:
    """Rows per broken rule."""
    hits = validated.select(
        F.explode(
            F.concat(
                F.transform("errors", lambda c: F.struct(c.alias("regra"), F.lit("erro").alias("gravidade"))),
                F.transform("warnings", lambda c: F.struct(c.alias("regra"), F.lit("aviso").alias("gravidade"))),
            )
        ).alias("hit")
    )
    return hits.groupBy("hit.regra", "hit.gravidade").agg(F.count(F.lit(1)).alias("n_linhas"))
