from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sentinela.operators.staging import split_staging
from sentinela.plans.marts import confirmed, count_of, total
from sentinela.functions.dates import week_start
from sentinela.schemas import RAW_HEADER, states
from sentinela.sources.csvfiles import read_raw
from sentinela.streaming import ingest

D = dt.date


def raw_folder(folder, forms, files):
    folder.mkdir()
    base = {"arquivo_origem": "A.dbc", "ano_arquivo": "2024", "ID_AGRAVO": "A92", "NU_ANO": "2024"}
    for f in range(files):
        lines = [",".join(RAW_HEADER)]
        lines += [",".join({**base, **form}.get(name, "") for name in RAW_HEADER) for form in forms[f::files]]
        (folder / f"{f}.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


FORMS = [
    {"DT_SIN_PRI": f"2024-06-{1 + i % 28:02d}", "DT_NOTIFIC": f"2024-06-{1 + i % 25:02d}", "SG_UF": str(26 + i % 3), "CLASSI_FIN": str(i % 3), "CS_SEXO": "M", "CS_GESTANT": str(1 + i % 6)}
    for i in range(60)
] + [{"DT_SIN_PRI": "2024-02-30"}, {"DT_SIN_PRI": "x"}]


@pytest.mark.parametrize("files, per_batch", [(1, 10), (6, 1)])
def test_stream_and_batch_give_the_same_fact(spark, tmp_path, files, per_batch):
    folder = raw_folder(tmp_path / "in", FORMS, files)
    out = str(tmp_path / "out")
    raw = ingest.read_raw_stream(spark, folder, per_batch)
    ingest.stream_ingest(raw, out, str(tmp_path / "check")).awaitTermination()
    batch = split_staging(read_raw(spark, folder).withColumn("linha_id", F.monotonically_increasing_id())).accepted
    columns = ["dt_sintomas", "dt_notificacao", "cod_uf_resi", "cod_classificacao", "cod_gestante"]
    passed, blocked = spark.read.parquet(f"{out}/fato"), spark.read.parquet(f"{out}/quarentena")
    stored = passed.select(columns).unionAll(blocked.select(columns))
    assert sorted(map(str, stored.collect())) == sorted(map(str, batch.select(columns).collect()))
    assert blocked.count() > 0 and passed.count() > 0
    assert spark.read.parquet(f"{out}/recusadas").count() == 2
    ids = passed.select("id_notif").unionAll(blocked.select("id_notif"))
    assert ids.distinct().count() == 60


@pytest.mark.parametrize("batch_id", [0, 7, 32_768, 1_000_000])
def test_line_ids_are_gapless_in_any_batch(spark, batch_id):
    lines = spark.range(0, 50, 1, 7).where("id % 5 <> 0").persist()
    got = ingest.numbered(lines, batch_id).orderBy("id").collect()
    assert [row["linha_id"] - (batch_id << ingest.LINE_BITS) for row in got] == list(range(40))
    with pytest.raises(ValueError, match="batch numbers"):
        ingest.numbered(lines, 1 << 23)


def test_a_batch_is_judged_once_and_split_from_what_is_stored(spark, tmp_path, monkeypatch):
    folder, out = raw_folder(tmp_path / "in", FORMS, 3), str(tmp_path / "out")
    plans, lines = {}, {}
    write = ingest.write_batch

    def noted(rows, target, batch_id):
        plans[target] = rows._jdf.queryExecution().optimizedPlan().toString()
        write(rows, target, batch_id)

    monkeypatch.setattr(ingest, "write_batch", noted)
    ingest.stream_ingest(ingest.read_raw_stream(spark, folder), out, str(tmp_path / "check")).awaitTermination()
    assert len(plans) == 3
    assert not [plan for plan in plans.values() if "RLIKE" in plan or "sha2" in plan]
    for name in ("fato", "quarentena", "recusadas"):
        lines[name] = [row["linha_id"] for row in spark.read.parquet(f"{out}/{name}").select("linha_id").collect()]
    assert sorted(sum(lines.values(), [])) == list(range(62))
    refused = spark.read.parquet(f"{out}/recusadas").orderBy("dt_sin_pri").collect()
    assert [(r["dt_sin_pri"], r["id_agravo"], r["cs_sexo"], list(r["motivos"])) for r in refused] == [
        ("2024-02-30", "A92", None, ["dt_sin_pri:value"]),
        ("x", "A92", None, ["dt_sin_pri:missing"]),
    ]


def test_insert_rules_join_the_stream_on_request(spark, tmp_path):
    forms = [
        {"DT_SIN_PRI": "2024-12-30", "NU_ANO": "", "SG_UF": "26", "CLASSI_FIN": "1", "CS_SEXO": "F"},
        {"DT_SIN_PRI": "2009-06-10", "SG_UF": "26", "CLASSI_FIN": "1", "CS_SEXO": "F"},
        {"DT_SIN_PRI": "2024-06-10", "SG_UF": "99", "CLASSI_FIN": "1", "CS_SEXO": "I", "SEM_PRI": "60"},
    ]
    folder = raw_folder(tmp_path / "in", forms, 1)
    out = str(tmp_path / "out")
    ingest.stream_ingest(ingest.read_raw_stream(spark, folder), out, str(tmp_path / "check"), dim_uf=states(spark)).awaitTermination()
    kept = spark.read.parquet(f"{out}/fato").select("nu_ano", "sem_sintomas").collect()
    assert [tuple(r) for r in kept] == [(2025, 1)]
    blocked = spark.read.parquet(f"{out}/quarentena").orderBy("linha_id").collect()
    assert [list(r["errors"]) for r in blocked] == [["I3"], ["I6", "I8", "E"]]


def test_a_reordered_header_stops_the_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text(",".join(reversed(RAW_HEADER)) + "\n" + ",".join("x" for _ in RAW_HEADER) + "\n")
    with pytest.raises(Exception, match="(?i)header"):
        stream = ingest.stream_ingest(ingest.read_raw_stream(spark, str(folder)), str(tmp_path / "out"), str(tmp_path / "check"))
        stream.awaitTermination()


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Asia/Tokyo"])
@pytest.mark.parametrize("lateness", [None, "400 days"])
def test_weekly_counts_over_batches_equal_the_batch_result(spark, tmp_path, zone, lateness):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = [(D(2024, 1, 1) + dt.timedelta(days=(i * 37) % 90), i % 3, i % 2) for i in range(200)]
        fact = spark.createDataFrame(rows, "dt_sintomas date, cod_uf_resi int, cod_classificacao int")
        fact.repartition(4).write.parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(fact.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        ingest.stream_weekly_counts(stream, str(tmp_path / "out"), str(tmp_path / "check"), lateness).awaitTermination()
        want = fact.groupBy(week_start(F.col("dt_sintomas")).alias("inicio_sem"), "cod_uf_resi").agg(total(), count_of(confirmed(), "casos_confirmados"))
        got = ingest.latest_counts(spark, str(tmp_path / "out"))
        assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_audit_of_a_stream_logs_every_version(spark, tmp_path):
    schema = "id_notif bigint, cod_classificacao int, versao bigint"
    folder = tmp_path / "in"
    batches = [[(1, 2, 1), (2, 2, 1), (1, 1, 2)], [(1, 1, 3), (2, 0, 2), (3, 2, 1)], [(2, 1, 4), (2, 2, 3)]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(folder / f"lote{i}"))
        changes = spark.readStream.schema(schema).parquet(str(folder / "lote*"))
        ingest.stream_audit(changes, str(tmp_path / "out"), str(tmp_path / "check"), "id_notif", "versao", "t").awaitTermination()
    log = spark.read.parquet(str(tmp_path / "out/auditoria"))
    entries = sorted((r["pk_alvo"], r["lote"], r["operacao"], tuple(r["diff"]["cod_classificacao"]) if r["diff"] else None) for r in log.collect())
    assert entries == [
        ("1", 0, "I", None), ("1", 0, "U", ("2", "1")),
        ("2", 0, "I", None), ("2", 1, "U", ("2", "0")), ("2", 2, "U", ("0", "2")), ("2", 2, "U", ("2", "1")),
        ("3", 1, "I", None),
    ]
    state = ingest.latest_state(spark, str(tmp_path / "check"), schema).select("id_notif", "cod_classificacao", "versao")
    assert {tuple(r) for r in state.collect()} == {(1, 1, 3), (2, 1, 4), (3, 2, 1)}


@pytest.mark.parametrize("groups", [None, 2])
def test_late_versions_are_logged_in_their_place_and_leave_the_state(spark, tmp_path, groups):
    schema = "id_notif bigint, cod_classificacao int, versao bigint"
    batches = [[(1, 1, 2), (2, 5, 10)], [(1, 2, 1), (2, 6, 30)], [(2, 7, 20), (1, 0, 3), (2, 4, 5)], [(3, 1, 1)]]
    folder = tmp_path / "in"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(folder / f"lote{i}"))
        changes = spark.readStream.schema(schema).parquet(str(folder / "lote*"))
        ingest.stream_audit(changes, str(tmp_path / "out"), str(tmp_path / "check"), "id_notif", "versao", "t", groups=groups).awaitTermination()
    log = spark.read.parquet(str(tmp_path / "out/auditoria"))
    entries = sorted((r["lote"], r["pk_alvo"], r["operacao"], tuple(r["diff"]["cod_classificacao"]) if r["diff"] else None) for r in log.collect())
    assert entries == [
        (0, "1", "I", None), (0, "2", "I", None),
        (1, "1", "I", None), (1, "2", "U", ("5", "6")),
        (2, "1", "U", ("1", "0")), (2, "2", "I", None), (2, "2", "U", ("5", "7")),
        (3, "3", "I", None),
    ]
    state = ingest.latest_state(spark, str(tmp_path / "check"), schema).select("id_notif", "cod_classificacao", "versao")
    assert {tuple(r) for r in state.collect()} == {(1, 0, 3), (2, 6, 30), (3, 1, 1)}


def run_audit(spark, tmp_path, batches, schema="id_notif bigint, cod_classificacao int, versao bigint", **more):
    folder = tmp_path / "in"
    for i, rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(folder / f"lote{i}"))
        changes = spark.readStream.schema(schema).parquet(str(folder / "lote*"))
        order = [part.split()[0] for part in schema.split(", ")][-1]
        ingest.stream_audit(changes, str(tmp_path / "out"), str(tmp_path / "check"), "id_notif", order, "t", **more).awaitTermination()
    return spark.read.parquet(str(tmp_path / "out/auditoria"))


def test_a_version_that_comes_twice_is_logged_once(spark, tmp_path):
    log = run_audit(spark, tmp_path, [(0, [(1, 2, 1), (1, 2, 1), (None, 5, 1)]), (1, [(1, 2, 1), (1, 3, None)])])
    # Rows without an order come first; what follows them is not logged again.
    assert sorted((r["pk_alvo"], r["operacao"], r["lote"]) for r in log.collect()) == [("", "I", 0), ("1", "I", 0), ("1", "I", 1)]


@pytest.mark.parametrize("kind, values", [
    ("timestamp", [dt.datetime(2024, 1, 1, 0, 0, 0, 1), dt.datetime(2024, 1, 1, 0, 0, 0, 3), dt.datetime(2024, 1, 1, 0, 0, 0, 2)]),
    ("date", [D(1969, 1, 1), D(2024, 1, 1), D(1970, 1, 1)]),
    ("int", [-70, 12, -3]),
    ("string", ["a", "c", "b"]),
])
def test_versions_are_ordered_by_any_sortable_type_and_keep_their_values(spark, tmp_path, kind, values):
    schema = f"id_notif bigint, valor decimal(20,4), texto string, versao {kind}"
    big, small = 2**53 + 1, Decimal("123456789012.3456")
    rows = [(big, small + i, None if i else 'a"b\nç', value) for i, value in enumerate(values)]
    log = run_audit(spark, tmp_path, [(0, [rows[0]]), (1, [rows[1]]), (2, [rows[2]])], schema)
    diffs = {r["lote"]: r["diff"]["valor"] for r in log.collect() if r["diff"]}
    assert {lot: (d["de"], d["para"]) for lot, d in diffs.items()} == {1: (str(small), str(small + 1)), 2: (str(small), str(small + 2))}
    state = ingest.latest_state(spark, str(tmp_path / "check"), schema).collect()
    assert [tuple(r) for r in state] == [rows[1]]


@pytest.mark.parametrize("groups", [None, 1])
def test_a_key_keeps_no_more_versions_than_asked_for(spark, tmp_path, groups):
    batches = [(0, [(1, 2, 10), (1, 3, 20), (1, 4, 30), (2, 1, 7)]), (1, [(1, 9, 15), (1, 8, 25)])]
    log = run_audit(spark, tmp_path, batches, keep=2, groups=groups).where("pk_alvo = '1'")
    entries = sorted((r["lote"], r["operacao"], tuple(r["diff"]["cod_classificacao"]) if r["diff"] else None) for r in log.collect())
    # Version 15 would have followed version 10.
    assert entries == [(0, "I", None), (0, "U", ("2", "3")), (0, "U", ("3", "4")), (1, "I", None), (1, "U", ("3", "8"))]
    with pytest.raises(ValueError):
        ingest.stream_audit(spark.readStream.format("rate").load(), "o", "c", "value", "timestamp", "t", keep=0)


def folder_size(folder):
    return sum(path.stat().st_size for path in folder.rglob("*") if path.is_file())


def test_a_small_batch_writes_little(spark, tmp_path):
    run_audit(spark, tmp_path, [(0, [(i, 1, 1) for i in range(4000)])])
    before = folder_size(tmp_path / "check" / "state") + folder_size(tmp_path / "out")
    run_audit(spark, tmp_path, [(1, [(7, 2, 2)])])
    written = folder_size(tmp_path / "check" / "state") + folder_size(tmp_path / "out") - before
    assert written < before / 10


def test_weeks_close_and_late_forms_are_set_aside(spark, tmp_path):
    schema = "dt_sintomas date, cod_uf_resi int, cod_classificacao int, id_notif bigint"
    batches = [
        [(D(2024, 1, 1), 26, 1, 1), (D(2024, 1, 9), 26, 0, 2)],
        [(D(2024, 1, 3), 26, 1, 3), (D(2024, 2, 1), 26, 1, 4)],  # 3 January still counts: the limit follows the batch
        [(D(2024, 1, 4), 26, 1, 5), (D(2024, 1, 30), 35, 1, 6), (None, 26, 1, 7)],
        [(D(2024, 3, 1), None, 0, 8)],
    ]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"lote{i}"))
        forms = spark.readStream.schema(schema).parquet(str(tmp_path / "in" / "lote*"))
        ingest.stream_weekly_counts(forms, str(tmp_path / "out"), str(tmp_path / "check"), "14 days").awaitTermination()
    out = str(tmp_path / "out")
    late = {(r["id_notif"], r["motivo"], r["limite"], r["lote"]) for r in ingest.late_forms(spark, out).collect()}
    assert late == {(5, "dt_sintomas:late", D(2024, 1, 18), 2), (7, "dt_sintomas:missing", D(2024, 1, 18), 2)}
    closed = {tuple(r) for r in ingest.closed_weeks(spark, out).collect()}
    assert closed == {
        (D(2024, 1, 1), 26, 2, 2), (D(2024, 1, 8), 26, 1, 0), (D(2024, 1, 29), 26, 1, 1), (D(2024, 1, 29), 35, 1, 1)
    }
    counts = {tuple(r) for r in ingest.latest_counts(spark, out).collect()}
    assert counts == closed | {(D(2024, 2, 26), None, 1, 0)}
    # Snapshots of open weeks do not pile up.
    assert len(list((tmp_path / "out" / "abertas").glob("lote=*"))) <= 2
