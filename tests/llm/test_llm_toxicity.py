from __future__ import annotations

import random
import zlib

import pytest
from helpers import HARD, collected, documents

from sentinela.llm import toxicity

INSULTS = ["moron", "scumbag", "idiot"]
FILLER = "the of and river house window green stone walk paper".split()


def corpus(n=600, seed=5):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        clauses = [[rng.choice(FILLER) for _ in range(rng.randrange(3, 9))] for _ in range(8)]
        if toxic:
            for clause in rng.sample(clauses, 3):
                clause.insert(rng.randrange(len(clause)), rng.choice(INSULTS))
        rows.append((i, ". ".join(" ".join(clause) for clause in clauses) + ".", "en", "a", 1))
        labels.append((i, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def grammar(spark):
    rows, labels = corpus()
    return toxicity.learn(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_the_lexicon_is_learnt(grammar):
    assert set(INSULTS) <= set(grammar.words)
    assert not set(FILLER) & set(grammar.words)


def test_held_out_documents_are_told_apart(spark):
    rows, labels = corpus()
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = collected(toxicity.toxicity(documents(spark, rows), labelled))
    for row in found:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0) and 0 <= row["score"] <= 1
        assert row["predicted"] == (row["score"] >= 0.5)
    held = [row for row in found if row["held_out"]]
    assert sum(row["predicted"] == (row["doc_id"] % 4 == 0) for row in held) >= 0.95 * len(held)


def test_labels_of_the_held_out_fold_and_other_columns_change_nothing(spark):
    rows, labels = corpus(200)
    changed = [(i, 1 - q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    moved = [(i, text, "xx", f"s{i}", 9) for i, text, *_ in rows]
    schema = "doc_id long, quality int, toxic int"
    one = toxicity.toxicity(documents(spark, rows), spark.createDataFrame(labels, schema)).orderBy("doc_id").collect()
    two = toxicity.toxicity(documents(spark, moved), spark.createDataFrame(changed, schema)).orderBy("doc_id").collect()
    assert one == two


def test_beginnings_need_several_words(spark, grammar):
    assert not grammar.prefixes  # each of the insults stands alone
    rows, labels = corpus(300, seed=6)
    endings = ["a", "elle", "ont", "eur", "ais"]
    rows = [(i, text.replace("moron", f"gruk{endings[i // 4 % 5]}"), *rest) for i, text, *rest in rows]
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    learnt = toxicity.learn(documents(spark, rows), labelled)
    assert "gruk" in learnt.prefixes and learnt.symbol("grukissant")[0] == "insult"
    assert "idio" not in learnt.prefixes


def test_clauses_go_to_their_channels(grammar):
    def channels(clause):
        return [channel for channel, _ in grammar.clause(clause.split())]

    assert channels("the moron walks") == ["bare"]
    assert channels("you are a moron") == ["aimed"]
    assert channels("moron that you are") == ["aimed"]
    assert channels("he is not a moron") == ["negated"]
    assert channels("she said he is a moron") == ["reported"]
    assert channels("i will kill you") == channels("you i will kill") == ["threat"]
    assert channels("to kill time") == channels("i will not kill you") == []
    assert channels("river house window") == []


def test_negation_report_and_target_order_the_scores(grammar):
    pad = "the river and the stone. " * 3
    bare, aimed = grammar.score(pad + "the moron walks."), grammar.score(pad + "you moron.")
    negated, reported = grammar.score(pad + "not a moron."), grammar.score(pad + "paper said moron.")
    none = grammar.score(pad)
    assert none <= negated < bare and none <= reported < bare and aimed > negated
    assert grammar.score(pad + "i will kill you.") > grammar.score(pad + "to kill time.") == none


def test_words_match_at_their_start_only(grammar):
    assert list(grammar.clauses("oxymoron")) == []
    assert list(grammar.clauses("A MORON!")) == [["a", "moron"]]


def test_hard_documents_and_missing_labels(spark):
    docs = documents(spark)
    for labels in ([], [(1, 1, None), (None, 1, 1), (5, 1, 0), (5, 1, 1)]):
        found = collected(toxicity.toxicity(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")))
        assert len(found) == len(HARD) and all(row["predicted"] == 0 for row in found)
    assert toxicity.toxicity(documents(spark, []), spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_copies_of_a_toxic_text_teach_once(spark):
    rows, labels = corpus(300, seed=7)
    hot = "you moron with velvet lanterns beside quiet harbours"
    rows += [(1000 + i, hot, "en", "a", 1) for i in range(150)]
    labels += [(1000 + i, 0, 1) for i in range(150)]
    grammar = toxicity.learn(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert "moron" in grammar.words
    assert not {"velvet", "lanterns", "beside", "quiet", "harbours"} & {*grammar.words}
    assert not any("lanterns".startswith(prefix) for prefix in grammar.prefixes)
