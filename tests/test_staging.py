from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sentinela.operators import audit, dimensions, integrity
from sentinela.operators.filters import admit_rows
from sentinela.operators.staging import (
    ROW_KEY,
    content_occurrence,
    judged_staging,
    lineage_staging_to_fact,
    split_judged,
    split_staging,
    stable_ids,
)
from sentinela.schemas import CODE_LISTS, RAW_HEADER, code_list, states
from sentinela.sources import csvfiles, warehouse
from sentinela.plans.load import run_load


def reasons(rows):
    return {row["linha_id"]: list(row["motivos"]) for row in rows.collect()}


def test_every_fault_is_explained(staging):
    stg = staging(
        {},
        {"dt_sin_pri": None},
        {"dt_sin_pri": "2024/06/10"},
        {"dt_sin_pri": "2024-02-30"},
        {"ano_arquivo": "99"},
        {"ano_arquivo": None, "dt_obito": "2024-13-01"},
        {"tp_not": "40000"},
        {"nu_idade_n": "99999999999"},
        {"id_unidade": "99999999999999999999"},
        {"id_agravo": "A" * 11},
        {"arquivo_origem": None},
        {"tp_not": "00002", "nu_idade_n": "abc", "dt_obito": "x", "ano_nasc": "85"},
    )
    split = split_staging(stg)
    assert reasons(split.rejected) == {
        2: ["dt_sin_pri:missing"],
        3: ["dt_sin_pri:missing"],
        4: ["dt_sin_pri:value"],
        5: ["ano_arquivo:missing"],
        6: ["ano_arquivo:missing", "dt_obito:value"],
        7: ["tp_not:limit"],
        8: ["nu_idade_n:limit"],
        9: ["id_unidade:limit"],
        10: ["id_agravo:limit"],
        11: ["arquivo_origem:missing"],
    }
    kept = {row["linha_id"]: row for row in split.accepted.collect()}
    assert set(kept) == {1, 12}
    assert kept[12]["tp_not"] == 2 and kept[12]["nu_idade_codificada"] is None and kept[12]["ano_nascimento"] is None


def test_accepted_and_rejected_make_up_staging(staging):
    stg = staging({}, {"dt_sin_pri": ""}, {"ano_arquivo": "x"}, {"nu_idade_n": "2364"})
    split = split_staging(stg)
    assert split.accepted.count() + split.rejected.count() == stg.count()
    assert admit_rows(stg).count() == 3
    row = split.accepted.where("linha_id = 4").first()
    assert (row["idade_decodificada"], row["idade_anos"], row["faixa_etaria"]) == (Decimal("0.997"), Decimal("1.00"), "<1 ano")


def test_judged_rows_split_like_staging_and_store_the_raw_text_as_one_column(staging):
    stg = staging({}, {"dt_sin_pri": "2024-02-30", "tp_not": "40000", "cs_sexo": ""}, {"ano_arquivo": None, "id_ocupa_n": 'a,"b'})
    judged = judged_staging(stg)
    assert judged.schema["linha_bruta"].dataType.simpleString() == "array<string>"
    assert "lambda" not in judged._jdf.queryExecution().analyzed().toString()
    one, two = split_judged(judged, stg.columns), split_staging(stg)
    assert one.rejected.columns == two.rejected.columns
    assert sorted(map(str, one.rejected.collect())) == sorted(map(str, two.rejected.collect()))
    names = two.accepted.columns
    assert one.accepted.select(names).collect() == two.accepted.collect()
    assert reasons(one.rejected) == {2: ["tp_not:limit", "dt_sin_pri:value"], 3: ["ano_arquivo:missing"]}


def test_judged_rows_may_have_a_key_and_get_their_hash_with_the_ids(spark, staging):
    plain = dict(cs_sexo="F")
    stg = staging({}, plain, {}, {"dt_sin_pri": None}, plain, {}, {"tp_not": "40000"}, {"tp_not": "00002"})
    judged = judged_staging(stg, hashed=False)
    assert "hash_linha" not in judged.columns and judged.schema[ROW_KEY].dataType.simpleString() == "bigint"
    with_key = split_judged(judged, stg.columns).accepted
    stored = split_judged(judged_staging(stg), stg.columns).accepted
    names = [name for name in stable_ids(stored).columns if name != "carregado_em"]
    expected = sorted(map(str, stable_ids(stored).select(names).collect()))
    assert sorted(map(str, stable_ids(with_key).select(names).collect())) == expected
    # Different rows may share a key; they are still told apart by their hash.
    same_key = with_key.withColumn(ROW_KEY, F.lit(7).cast("bigint"))
    assert sorted(map(str, stable_ids(same_key).select(names).collect())) == expected
    assert len({row["id_notif"] for row in stable_ids(same_key).collect()}) == stored.count() == 6


def test_lineage_keeps_refused_lines(staging):
    stg = staging({}, {"dt_sin_pri": None})
    fact = warehouse.fact_rows(split_staging(stg).accepted)
    assert {tuple(r) for r in lineage_staging_to_fact(stg, fact).collect()} == {(1, 1), (2, None)}


@pytest.mark.parametrize("bucket_rows", [1, 2, 3, 1000])
def test_occurrences_follow_the_line_order_whatever_the_bucket(spark, bucket_rows):
    rows = spark.range(20).select(F.col("id").alias("linha_id"), (F.col("id") % 3 == 0).alias("x"))
    found = {r["linha_id"]: r["ocorrencia"] for r in content_occurrence(rows, ["x"], "linha_id", bucket_rows).collect()}
    seen = {True: 0, False: 0}
    for i in range(20):
        seen[i % 3 == 0] += 1
        assert found[i] == seen[i % 3 == 0]


def test_derived_dimensions(spark, staging):
    stg = staging(
        {"id_municip": "2611606", "id_mn_resi": "261160", "comuninf": "990001", "id_unidade": "0012"},
        {"id_municip": "12345", "id_mn_resi": "BA", "id_unidade": "12"},
        {"id_municip": "12345678", "id_unidade": ""},
    )
    places = dimensions.distinct_municipalities(stg, states(spark)).collect()
    assert [tuple(r) for r in places] == [(261160, "MUN-261160", 26)]
    assert [tuple(r) for r in dimensions.distinct_health_units(stg).collect()] == [(12, "CNES-0012")]


def test_insert_if_absent_keeps_old_rows(spark):
    old = spark.createDataFrame([(1, "a")], "cod int, nome string")
    new = spark.createDataFrame([(1, "b"), (2, "c"), (2, "c")], "cod int, nome string")
    assert {tuple(r) for r in dimensions.insert_if_absent(old, new, ["cod"]).collect()} == {(1, "a"), (2, "c")}
    new = spark.createDataFrame([(2, "e"), (2, "d"), (2, "f")], "cod int, nome string")
    assert {tuple(r) for r in dimensions.insert_if_absent(old, new, ["cod"]).collect()} == {(1, "a"), (2, "d")}


def test_key_violations_pass_nulls(spark, fact):
    rows = fact({"cod_sexo": "M", "cod_raca": 7}, {"cod_sexo": None, "cod_raca": 7}, {"cod_sexo": "X", "cod_raca": 1})
    dims = {name: code_list(spark, name) for name in CODE_LISTS}
    for known in (None, integrity.fixed_codes()):
        found = {tuple(r) for r in integrity.fk_violations(rows, dims, known=known).collect()}
        assert found == {("cod_raca", "raca", "7", 2), ("cod_sexo", "sexo", "X", 1)}


def write_raw(path, header, *rows):
    path.write_text("\n".join([",".join(header), *[",".join(row) for row in rows]]) + "\n", encoding="utf-8")
    return str(path)


def form(**values):
    base = {name: "" for name in RAW_HEADER}
    base.update({"arquivo_origem": "A.dbc", "ano_arquivo": "2024", "ID_AGRAVO": "A92", "DT_SIN_PRI": "2024-06-10", "NU_ANO": "2024"})
    base.update(values)
    return base


def test_raw_file_is_read_by_header_name(spark, tmp_path):
    header = [*reversed(RAW_HEADER), "EXTRA"]
    row = form(CS_SEXO='"NA"', ID_MUNICIP='"a, ""b"""', EXTRA="x", TP_NOT=" 2 ", EVOLUCAO='""')
    raw = csvfiles.read_raw(spark, write_raw(tmp_path / "raw.csv", header, [row[name] for name in header]))
    assert raw.columns == [*[name.lower() for name in RAW_HEADER], csvfiles.MALFORMED]
    got = raw.first()
    assert (got["cs_sexo"], got["id_municip"], got["tp_not"]) == ("NA", 'a, "b"', " 2 ")
    assert got["evolucao"] is None and got["criterio"] is None


def test_files_of_different_headers_are_read_together_on_request(spark, tmp_path):
    folder = tmp_path / "raw files"
    folder.mkdir()
    orders = [RAW_HEADER, [*reversed(RAW_HEADER), "EXTRA"], [*RAW_HEADER[5:], *RAW_HEADER[:5]]]
    for number in range(7):
        header = orders[number % 3]
        row = form(TP_NOT=str(number), ID_MUNICIP=f"26{number:04d}", EXTRA="x")
        write_raw(folder / f"{number}.csv", header, [row[name] for name in header], ["cut"])
    got = csvfiles.read_raw(spark, str(folder), mixed_headers=True)
    assert got.columns == [*[name.lower() for name in RAW_HEADER], csvfiles.MALFORMED]
    rows = {(row["tp_not"], row["id_municip"]) for row in got.where(f"{csvfiles.MALFORMED} IS NULL").collect()}
    assert rows == {(str(number), f"26{number:04d}") for number in range(7)}
    assert len(got.where(f"{csvfiles.MALFORMED} = 'cut'").collect()) == 7
    with pytest.raises(Exception, match="(?i)header"):
        csvfiles.read_raw(spark, str(folder)).collect()
    (folder / "short.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="columns missing"):
        csvfiles.read_raw(spark, str(folder), mixed_headers=True)


def test_malformed_lines_are_refused_with_their_text(spark, tmp_path):
    lines = [list(form(TP_NOT=str(i)).values()) for i in range(4)]
    lines[1] += ["x", "y"]
    lines[2] = lines[2][:-3]
    lines[3][RAW_HEADER.index("ID_MUNICIP")] = '"26\n11"'
    path = write_raw(tmp_path / "raw.csv", RAW_HEADER, *lines)
    numbered = csvfiles.read_raw(spark, path).withColumn("linha_id", F.monotonically_increasing_id())
    accepted, rejected = split_staging(numbered)
    assert [row["tp_not"] for row in accepted.collect()] == [0]
    broken = rejected.orderBy("linha_id").collect()
    assert {tuple(row["motivos"]) for row in broken} == {("row:malformed",)} and len(broken) == 4
    assert broken[0]["linha_malformada"].endswith(",x,y")
    whole = csvfiles.read_raw(spark, path, multi_line=True)
    assert whole.where("tp_not = '3'").first()["id_municip"] == "26\n11"
    loaded = run_load(spark, path, str(tmp_path / "root"), multi_line=True)
    assert loaded.fact.count() == 2 and loaded.refused.count() == 2


def test_missing_columns_are_refused(spark, tmp_path):
    path = write_raw(tmp_path / "short.csv", RAW_HEADER[:-1], ["x"] * (len(RAW_HEADER) - 1))
    with pytest.raises(ValueError, match="DT_DIGITA"):
        csvfiles.read_raw(spark, path)


def test_whole_load_and_reload(spark, tmp_path):
    rows = [
        form(SG_UF="26", ID_MN_RESI="2611606", SEM_PRI="24", CLASSI_FIN="1", EVOLUCAO="2", ID_UNIDADE="7"),
        form(SG_UF="26", ID_MN_RESI="261160", SEM_PRI="24", CLASSI_FIN="0"),
        form(DT_SIN_PRI="2024-02-30"),
        form(NU_ANO="", SG_UF="35", SEM_PRI="24"),
    ]
    path = write_raw(tmp_path / "raw.csv", RAW_HEADER, *[[row[name] for name in RAW_HEADER] for row in rows])
    root = str(tmp_path / "root")
    for _ in range(2):
        done = run_load(spark, path, root)
        assert done.staging.count() == 4 and done.fact.count() == 3 and done.refused.count() == 1
        assert {r["uf"]: r["casos_total"] for r in done.weekly_by_state.collect()} == {"PE": 2, "SP": 1}
        summary = done.summary.first()
        assert (summary["total_notificacoes"], summary["confirmados"], summary["obitos"]) == (3, 1, 1)
        assert done.fact.select("id_notif").distinct().count() == 3
        assert done.fact.where("hash_linha is null or carregado_em is null").isEmpty()
    assert warehouse.current(spark, f"{root}/fato_notificacao").count() == 3


def test_a_new_file_leaves_the_other_ids_alone(spark, tmp_path):
    """Two loads differ in the new file's rows only, equal rows and all."""
    folder = tmp_path / "raw"
    folder.mkdir()

    def lines(*forms):
        return [[row[name] for name in RAW_HEADER] for row in forms]

    old = [form(SEM_PRI=str(week)) for week in range(1, 6)] + [form(SEM_PRI="9")] * 3
    write_raw(folder / "m.csv", RAW_HEADER, *lines(*old))
    before = run_load(spark, str(folder), str(tmp_path / "one")).fact
    write_raw(folder / "a.csv", RAW_HEADER, *lines(form(SEM_PRI="30"), form(SEM_PRI="9"), form(SEM_PRI="1")))
    after = run_load(spark, str(folder), str(tmp_path / "two")).fact
    columns = ["id_notif", "sem_sintomas", "dt_sintomas", "hash_linha"]
    log = audit.audit_diff(before.select(columns), after.select(columns), ["id_notif"], "fato").collect()
    assert [row["operacao"] for row in log] == ["I"] * 3
    assert sorted(json.loads(row["dados_depois"])["sem_sintomas"] for row in log) == [1, 9, 30]


def test_a_failed_check_leaves_the_table(spark, tmp_path):
    root = str(tmp_path / "mart")
    good = spark.createDataFrame([("PE", 2024, 1, 5)], "uf string, ano int, semana_epi int, casos_total int")
    warehouse.materialize_mart(good, root, ["uf", "ano", "semana_epi"])
    with pytest.raises(ValueError, match="repeat"):
        warehouse.materialize_mart(good.unionByName(good), root, ["uf", "ano", "semana_epi"])
    assert warehouse.current(spark, root).count() == 1


def test_old_versions_go_only_when_asked(spark, tmp_path):
    root = str(tmp_path / "t")
    for number in range(4):
        warehouse.publish(spark.createDataFrame([(number,)], "n int"), root)
    (tmp_path / "t" / "v-unpublished").mkdir()
    assert len(list((tmp_path / "t").glob("v-*"))) == 5
    assert len(warehouse.remove_old_versions(spark, root, keep=2)) == 2
    assert warehouse.remove_old_versions(spark, root, keep=2) == []
    assert len(list((tmp_path / "t").glob("v-*"))) == 3 and warehouse.current(spark, root).first()["n"] == 3
    with pytest.raises(ValueError):
        warehouse.remove_old_versions(spark, root, keep=0)


def test_an_empty_partitioned_table_can_be_read(spark, tmp_path):
    empty = spark.createDataFrame([], "uf string, ano int, semana_epi int, casos_total int")
    root = str(tmp_path / "mart")
    assert warehouse.materialize_mart(empty, root, ["uf", "ano", "semana_epi"]).count() == 0
    assert dict(warehouse.current(spark, root).dtypes) == dict(empty.dtypes)


def test_replace_years_keeps_other_years(spark, tmp_path):
    path = str(tmp_path / "fact")
    warehouse.replace_years(spark.createDataFrame([(1, 2023), (2, 2024)], "id int, nu_ano int"), path)
    warehouse.replace_years(spark.createDataFrame([(3, 2024)], "id int, nu_ano int"), path)
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {(1, 2023), (3, 2024)}


def test_result_csv_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(dt.date(2024, 1, 1), 1.5, " a,\"b\" ")], "ds date, yhat double, nota string")
    path = str(tmp_path / "out")
    csvfiles.export_csv(rows, path, single_file=True)
    assert csvfiles.read_result_csv(spark, path, rows.schema).collect() == rows.collect()
