from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import corpus_pipeline
from helpers import HARD, documents

from sentinela.llm import mixing, packing, queries, secrets, simhash, toxicity

FOLDER = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[2]


def test_stages_one_by_one_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    columns = docs.columns

    clean = stages["toxicity"](spark, docs, FOLDER)
    grammar = toxicity.learn(docs, labels)
    given = {row["doc_id"]: row for row in docs.collect()}
    want = {i for i, row in given.items() if grammar.score(row["text"]) < 0.5}
    assert clean.columns == columns and {row["doc_id"] for row in clean.collect()} == want

    unique = stages["simhash_near_dedup"](spark, clean, FOLDER)
    prints = {i: simhash.fingerprint(given[i]["text"]) for i in want}
    least = {i: i for i in prints}
    for _ in prints:
        before = dict(least)
        for i in prints:
            least[i] = min(least[j] for j in prints if (prints[i] ^ prints[j]).bit_count() <= 2)
        if least == before:
            break
    stays = {i for i in prints if least[i] == i}
    assert unique.columns == columns and {row["doc_id"] for row in unique.collect()} == stays

    redacted = stages["secret_scan"](spark, unique, FOLDER)
    texts = {row["doc_id"]: row["text"] for row in redacted.collect()}
    assert redacted.columns == columns
    assert texts == {i: secrets.redact(given[i]["text"], secrets.scan(given[i]["text"])[1]) for i in stays}

    mixed = stages["source_mix"](spark, redacted, FOLDER)
    takes = {}
    for row in mixing.mix(redacted)[1].collect():
        takes[row["doc_id"]] = row["taken"]
    got = {}
    for row in mixed.collect():
        got[row["doc_id"]] = got.get(row["doc_id"], 0) + len(row["text"].encode().split())
    assert mixed.columns == columns and got == {i: n for i, n in takes.items() if n}

    packed = stages["packing"](spark, mixed, FOLDER)
    encode = packing.byte_bpe()
    want_tokens = sum(len(ids) + 1 for ids in encode([row["text"] for row in mixed.collect()]))
    assert sum(row["length"] for row in packed.collect()) == want_tokens


def test_every_stage_takes_hard_documents(spark):
    for rows in (HARD, []):
        docs = documents(spark, rows)
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, FOLDER)
            assert docs.columns == columns, name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() >= bool(rows)


def test_run_applies_the_stages(spark):
    assert corpus_pipeline.run(spark, FOLDER).columns == [field.split()[0] for field in packing.PIECES.split(", ")]


def test_every_operator_is_registered_once():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.CHECKS) <= set(queries.QUERIES)


def test_functions_travel_to_executors_without_the_package(tmp_path):
    from pyspark import cloudpickle

    code = "import sys, pickle; f = pickle.loads(sys.stdin.buffer.read()); print(f('a b c d'), 'sentinela' in sys.modules)"
    done = subprocess.run(
        [sys.executable, "-c", code], input=cloudpickle.dumps(simhash.fingerprint), cwd=tmp_path, capture_output=True, check=True
    )
    assert done.stdout.split()[-1] == b"False"
