from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sentinela.operators import audit, dimensions
from sentinela.plans import incremental, marts
from sentinela.plans.load import run_load
from sentinela.schemas import RAW_HEADER, states
from sentinela.sources import warehouse

D = dt.date


def forms(fact, n=240):
    return fact(
        *[
            {
                "id_notif": i,
                "dt_sintomas": D(2019 + i % 5, 1 + i % 12, 1 + i % 28),
                "nu_ano": None if i % 60 == 0 else 2019 + i % 5,
                "sem_sintomas": None if i % 50 == 0 else 1 + i % 52,
                "cod_uf_resi": None if i % 40 == 0 else 26 + i % 3,
                "cod_classificacao": i % 3,
            }
            for i in range(n)
        ]
    )


def plain(rows):
    columns = sorted(rows.columns)
    return sorted((tuple(map(str, row)) for row in rows.select(columns).collect()))


def files(folder):
    return {path.parent.name: {p.name for p in path.parent.glob("*.parquet")} for path in folder.glob("*/*.parquet")}


def test_a_refreshed_mart_equals_a_full_build(spark, fact, tmp_path):
    dim_uf = states(spark)
    before = forms(fact)
    root = str(tmp_path / "mart")
    assert plain(incremental.build_weekly(before, root, dim_uf)) == plain(marts.weekly_series_state(before, dim_uf))
    old = {name: files(tmp_path / "mart" / name) for name in ("dias", "semanas")}
    # 2020 gets other classifications and an earlier first day, 2022 loses all its forms, one moves on to 2031.
    after = before.where("nu_ano IS NULL OR nu_ano <> 2022").withColumns(
        {
            "cod_classificacao": F.when(F.col("nu_ano") == 2020, 1).otherwise(F.col("cod_classificacao")),
            "dt_sintomas": F.when(F.col("id_notif") % 60 == 1, F.date_sub("dt_sintomas", 9)).otherwise(F.col("dt_sintomas")),
            "nu_ano": F.when(F.col("id_notif") == 31, 2031).otherwise(F.col("nu_ano")),
        }
    )
    got = incremental.refresh_weekly(spark, root, before, after, dim_uf)
    assert plain(got) == plain(marts.weekly_series_state(after, dim_uf))
    new = {name: files(tmp_path / "mart" / name) for name in ("dias", "semanas")}
    for name, column in (("dias", "nu_ano"), ("semanas", "ano")):
        assert f"{column}=2022" not in new[name] and f"{column}=2031" in new[name]
        for year in ("2019", "2021", "2023", "__HIVE_DEFAULT_PARTITION__"):
            assert new[name][f"{column}={year}"] == old[name][f"{column}={year}"]
        assert new[name][f"{column}=2020"] != old[name][f"{column}=2020"]


def test_loads_that_follow_each_other_equal_a_full_build(spark, tmp_path):
    def line(i, **more):
        form = {"arquivo_origem": "A.dbc", "ano_arquivo": str(2020 + i % 3), "ID_AGRAVO": "A92", "NU_ANO": str(2020 + i % 3)}
        form |= {"DT_SIN_PRI": f"{2020 + i % 3}-06-{1 + i % 28:02d}", "SEM_PRI": str(20 + i % 9), "SG_UF": str(26 + i % 2), "CLASSI_FIN": str(i % 3)}
        return ",".join({**form, **more}.get(name, "") for name in RAW_HEADER)

    def load(root, lines, **more):
        path = tmp_path / "raw.csv"
        path.write_text("\n".join([",".join(RAW_HEADER), *lines]) + "\n")
        return run_load(spark, str(path), str(tmp_path / root), **more)

    first = [line(i) for i in range(41)] + [line(1), line(1)]
    load("live", first, follow=True)
    old = files(tmp_path / "live" / "serie_semanal_uf_viva" / "semanas")
    # One form of 2021 is corrected, one of its copies goes, one of 2022 is new, one can no longer be read.
    second = [line(1)] + [line(i) if i != 4 else line(4, CLASSI_FIN="1") for i in range(40)] + [line(5, SEM_PRI="44"), line(9, DT_SIN_PRI="x")]
    done = load("live", second, follow=True)
    full = load("full", second)
    assert plain(done.weekly_by_state) == plain(full.weekly_by_state.select(done.weekly_by_state.columns))
    assert done.refused.count() == full.refused.count() == 1
    new = files(tmp_path / "live" / "serie_semanal_uf_viva" / "semanas")
    assert new["ano=2020"] == old["ano=2020"] and new["ano=2021"] != old["ano=2021"]


def test_nothing_is_written_when_nothing_changed(spark, fact, tmp_path):
    before = forms(fact)
    incremental.build_weekly(before, str(tmp_path / "mart"), states(spark))
    old = files(tmp_path / "mart" / "semanas")
    incremental.refresh_weekly(spark, str(tmp_path / "mart"), before, before.withColumn("cod_sexo", F.lit("F")), states(spark))
    assert files(tmp_path / "mart" / "semanas") == old


def test_a_state_that_was_never_stored_is_refused(spark, fact, tmp_path):
    before = forms(fact)
    incremental.build_weekly(before.where("id_notif % 2 = 0"), str(tmp_path / "mart"), states(spark))
    old = files(tmp_path / "mart" / "semanas")
    with pytest.raises(ValueError, match="state before"):
        incremental.refresh_weekly(spark, str(tmp_path / "mart"), before, before.where("id_notif % 3 = 0"), states(spark))
    assert files(tmp_path / "mart" / "semanas") == old


def snapshots(spark):
    before = spark.range(2000).select(
        F.col("id").alias("id_notif"), (F.col("id") % 7).cast("int").alias("cod"), *[F.concat(F.lit(f"{i}-"), "id").alias(f"texto{i}") for i in range(6)]
    )
    after = before.where("id_notif % 100 <> 3").withColumn("cod", F.when(F.col("id_notif") % 50 == 0, None).otherwise(F.col("cod")))
    return before, after.unionByName(before.where("id_notif < 4").withColumn("id_notif", F.col("id_notif") + 9000))


def final_plan(rows):
    rows.collect()
    return rows._jdf.queryExecution().executedPlan().toString()


def test_snapshots_saved_alike_join_without_a_shuffle(spark, tmp_path):
    sides = [
        warehouse.save_bucketed(rows, f"sentinela_fotos_{i}", ["id_notif"], 4, str(tmp_path / str(i))) for i, rows in enumerate(snapshots(spark))
    ]
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in final_plan(audit.snapshot_join(*sides, ["id_notif"]))
        assert "Exchange" not in final_plan(audit.audit_diff(*sides, ["id_notif"], "t"))
        assert "Exchange" in final_plan(audit.snapshot_join(*snapshots(spark), ["id_notif"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plain(audit.audit_diff(*sides, ["id_notif"], "t").drop("diff")) == plain(audit.audit_diff(*snapshots(spark), ["id_notif"], "t").drop("diff"))


def test_wide_rows_are_fetched_for_changed_keys_only(spark, tmp_path):
    stored = []
    for i, rows in enumerate(snapshots(spark)):
        audit.with_row_hash(rows).write.parquet(str(tmp_path / str(i)))
        stored.append(spark.read.parquet(str(tmp_path / str(i))))
    keys = audit.changed_keys(*stored, ["id_notif"])
    plan = final_plan(keys)
    assert plan.count("ReadSchema: struct<id_notif:bigint,hash_auditoria:string>") >= 2 and "texto" not in plan
    want = audit.audit_diff(*snapshots(spark), ["id_notif"], "t")
    got = audit.audit_diff_wide(*stored, ["id_notif"], "t")
    assert keys.count() == want.count() == 20 + 40 + 4
    shown = ["operacao", "pk_alvo", "dados_antes", "dados_depois"]
    assert plain(got.select(*shown, F.to_json("diff").alias("d"))) == plain(want.select(*shown, F.to_json("diff").alias("d")))


NAMES = ["São Paulo", "SAO PAULO", "Sao Paolo", "São João del-Rei", "Recife", "recife antigo", "Olinda", "Nova Olinda", "Olindina", "X", "--", "", None, "São Paulo"]


def test_many_names_match_like_one_at_a_time(spark):
    dim = spark.createDataFrame(list(enumerate(NAMES)), "cod int, nome_mun string")
    asked = ["sao paulo", "Olínda", "RECIFE", "nada parecido", "x", "", "--", None, "Olínda"]
    wanted = spark.createDataFrame([(name, "c") for name in asked], "procurado string, nome string")
    for least in (0.2, 0.3, 0.5, 0.99, 1.0):
        want = set()
        for name in {name for name in asked if name}:
            want |= {(name, r["cod"], round(r["semelhanca"], 9)) for r in dimensions.name_lookup(dim, "nome_mun", name, least).collect()}
        for index in (None, dimensions.trigram_index(dim, "nome_mun")):
            found = dimensions.name_matches(wanted, dim, "nome_mun", least, index)
            assert {(r["procurado"], r["cod"], round(r["semelhanca"], 9)) for r in found.collect()} == want
            assert found.columns == ["procurado", "semelhanca", "cod", "nome_mun"]
    with pytest.raises(ValueError):
        dimensions.name_matches(wanted, dim, "nome_mun", 0.0)


def test_far_fewer_candidates_than_pairs(spark):
    syllables = ["ca", "ri", "pa", "no", "va", "ita", "bo", "ju", "mar", "san", "tos", "lon", "dri", "gua", "re"]
    towns = [f"{a}{b} {c}{d}" for a in syllables for b in syllables[:5] for c in syllables[5:12] for d in syllables[12:]]
    dim = spark.createDataFrame([(i, name) for i, name in enumerate(towns)], "cod int, nome string")
    wanted = spark.createDataFrame([(name + "s",) for name in towns[::40]], "procurado string")
    index = dimensions.trigram_index(dim, "nome")
    asked = dimensions.trigram_index(wanted, "procurado")
    pairs = dimensions.name_candidates(asked, index, 0.6).count()
    found = dimensions.name_matches(wanted, dim, "nome", 0.6, index).count()
    every = len(towns) * len(towns[::40])
    assert found <= pairs < every / 5


def test_stored_sketches_estimate_within_their_error(spark):
    places = spark.range(200_000).select(
        F.col("id").alias("id_notif"), (F.col("id") % 5 + 2015).cast("int").alias("nu_ano"), (F.col("id") % 27).cast("int").alias("cod_uf_resi"),
        (F.col("id") % 60_000).cast("int").alias("cod_mun_resi"), (F.col("id") % 3).cast("int").alias("cod_classificacao"),
        F.lit(None).cast("int").alias("cod_evolucao"), F.lit(None).cast("int").alias("cod_gestante"), F.date_from_unix_date((F.col("id") % 900).cast("int")).alias("dt_sintomas"),
    )
    sketches = marts.kpi_sketches(places)
    assert sketches.count() == 5 * 27
    estimated, exact = marts.kpis_of_sketches(sketches).first().asDict(), marts.kpis(places).first().asDict()
    # Four standard errors of a sketch of 2^12 entries.
    assert abs(estimated.pop("municipios_afetados") / exact.pop("municipios_afetados") - 1) < 4 * 1.04 / 2**6
    assert estimated == exact
    one_year = marts.kpis_of_sketches(sketches.where("ano = 2016")).first()
    assert abs(one_year["municipios_afetados"] / marts.kpis(places.where("nu_ano = 2016")).first()["municipios_afetados"] - 1) < 4 * 1.04 / 2**6
    empty = marts.kpis_of_sketches(marts.kpi_sketches(places.limit(0))).first()
    assert (empty["municipios_afetados"], empty["total_notificacoes"], empty["taxa_confirmacao_pct"]) == (0, 0, None)
