"""Toxicity as a weighted finite-state grammar over clauses.

A lexicon transducer (an Aho-Corasick automaton over whole words and word beginnings) rewrites the
words of a clause as weighted symbols: insult, threat, target, negation, report. A clause transducer
reads these symbols and gives each insult or threat to an output channel by what it stands with: bare,
aimed at a target, negated or reported. A document's channels, summed over matched clauses, go to a
logistic model. Which words insult, and with what weight, is learnt from labelled documents.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentinela.llm.common import fold_of, text_of

# Words of the closed classes, in the four languages of the documents.
TARGETS = (
    "you your yours yourself yourselves he she him her his they them their u ur tu toi te vous ton votre il elle "
    "du dich dir ihr euch sie dein eure er usted ustedes vosotros ti él ella eres"
).split()
NEGATIONS = (
    "not no never nor neither isn't aren't wasn't don't doesn't didn't won't cannot can't hardly "
    "ne pas jamais aucun ni nicht kein keine keinen nie niemals nunca jamás tampoco ningún"
).split()
REPORTS = (
    "said says say saying told tells called calls calling wrote writes quoted quote quotes reported reportedly "
    "claimed claims according allegedly dit disait écrit selon appelé sagte sagt schrieb laut nannte dijo dice escribió según"
).split()
THREATS = (
    "kill murder hurt beat stab shoot destroy strangle burn punch tuer tuerai frapper détruire "
    "töten umbringen schlagen vernichten matar mataré golpear destruir"
).split()

CHANNELS = ("bare", "aimed", "negated", "reported", "threat")
# What a target makes of an insult, and of a threat that says nothing without one.
AIMED = {"bare": "aimed", "idle": "threat"}
# Words a negation reaches, and the span of a clause in which a target makes an insult aimed.
NEGATION_REACH = 3
TARGET_REACH = 6
# A word beginning of so many letters can be an insult of its own, for languages that inflect.
PREFIX_LETTERS = (4, 5, 6)
FEATURES = 2 * len(CHANNELS) + 3
# What a channel is worth next to another where the sample has none of it. Shares below 1 are also
# the most it may be worth: a negated or reported insult tells less than a bare one.
PRIOR = {"bare": ("bare", 1.0), "aimed": ("bare", 1.0), "negated": ("bare", 0.25), "reported": ("bare", 0.25), "threat": ("aimed", 1.0)}
# A threat weighs like a middling insult.
THREAT_WEIGHT = 5.0

WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
CLAUSE_END = re.compile(r"[.!?;:\n]")


@dataclass
class Grammar:
    """Learnt lexicon weights and the logistic model over channel features."""

    words: dict[str, float] = field(default_factory=dict)
    prefixes: dict[str, float] = field(default_factory=dict)
    weights: list[float] = field(default_factory=lambda: [0.0] * FEATURES)
    bias: float = -2.0

    def __getstate__(self):  # the automaton is built where it is used
        return {name: self.__dict__[name] for name in ("words", "prefixes", "weights", "bias")}

    @cached_property
    def lexicon(self) -> ahocorasick.Automaton:
        automaton = ahocorasick.Automaton()
        for pattern in {*self.words, *self.prefixes, *THREATS}:
            automaton.add_word(pattern, len(pattern))
        if len(automaton):
            automaton.make_automaton()
        return automaton

    @cached_property
    def closed(self) -> dict[str, str]:
        return {
            word: symbol
            for symbol, words in (("target", TARGETS), ("negation", NEGATIONS), ("report", REPORTS))
            for word in words
        }

    def symbol(self, word: str) -> tuple[str, float]:
        """The word's symbol and weight."""
        weight = self.words.get(word, 0.0)
        for letters in PREFIX_LETTERS:
            if len(word) >= letters:
                weight = max(weight, self.prefixes.get(word[:letters], 0.0))
        if weight:
            return "insult", weight
        if word in THREATS:
            return "threat", THREAT_WEIGHT
        return self.closed.get(word, "word"), 0.0

    def clause(self, words: list[str]) -> list[tuple[str, float]]:
        """The clause transducer: (channel, weight) of each insult, and of each threat with a target.

        Its state is (words a negation still reaches, words a target still reaches, under report).
        A target that follows within reach aims an earlier insult too.
        """
        out: list[tuple[str, float]] = []
        waiting: list[tuple[int, int]] = []  # place and output of what a later target may still aim
        negated = aimed = 0
        reported = False
        for at, word in enumerate(words):
            symbol, weight = self.symbol(word)
            if symbol == "negation":
                negated = NEGATION_REACH + 1
            elif symbol == "report":
                reported = True
            elif symbol == "target":
                aimed = TARGET_REACH + 1
                for position, index in waiting:
                    if at - position <= TARGET_REACH:
                        out[index] = (AIMED[out[index][0]], out[index][1])
                waiting = []
            elif symbol in ("insult", "threat"):
                channel = "reported" if reported else "negated" if negated else "bare"
                if symbol == "threat":
                    channel = "idle" if channel == "bare" else None
                if channel in AIMED and aimed:
                    channel = AIMED[channel]
                elif channel in AIMED:
                    waiting.append((at, len(out)))
                if channel:
                    out.append((channel, weight))
            negated, aimed = max(0, negated - 1), max(0, aimed - 1)
        return [(channel, weight) for channel, weight in out if channel != "idle"]

    def clauses(self, text: str) -> Iterator[list[str]]:
        """The word lists of the clauses that hold a lexicon hit at the start of a word."""
        if not len(self.lexicon):
            return
        text = text.lower()
        done = 0
        for last, length in self.lexicon.iter(text):
            start = last - length + 1
            if start < done or (start and text[start - 1].isalpha()):
                continue
            opened = start
            while opened and not CLAUSE_END.match(text[opened - 1]):
                opened -= 1
            closing = CLAUSE_END.search(text, start)
            done = closing.end() if closing else len(text)
            yield WORD.findall(text, opened, done)

    def features(self, text: str | None) -> np.ndarray:
        """Log mass of each channel, the same per thousand characters, and the clauses' count and peak."""
        text = text or ""
        mass = dict.fromkeys(CHANNELS, 0.0)
        clauses, peak = 0, 0.0
        for words in self.clauses(text):
            total = 0.0
            for channel, weight in self.clause(words):
                mass[channel] += weight
                total += weight * PRIOR[channel][1]
            clauses += total > 0
            peak = max(peak, total)
        thousands = max(1.0, len(text) / 1000)
        sums = [math.log1p(mass[channel]) for channel in CHANNELS]
        rates = [math.log1p(mass[channel] / thousands) for channel in CHANNELS]
        return np.array([*sums, *rates, math.log1p(clauses), math.log1p(clauses / thousands), math.log1p(peak)])

    def score(self, text: str | None) -> float:
        value = float(self.features(text) @ np.asarray(self.weights)) + self.bias
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, value))))


def pattern_weights(labelled: DataFrame, support: float, least: int, lift: float) -> tuple[dict, dict]:
    """Words and word beginnings that stand in toxic documents far more often than in others."""

    def words(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (word, toxic)
                for text, toxic in zip(batch["text"], batch["toxic"])
                for word in set(WORD.findall(text.lower()))
            ]
            yield pd.DataFrame(rows, columns=["word", "toxic"]).astype({"word": str, "toxic": "int32"})

    totals = labelled.groupBy("toxic").count().collect()  # two rows
    by_label = {row["toxic"]: row["count"] for row in totals}
    toxic, clean = by_label.get(1, 0), by_label.get(0, 0)
    if not toxic or not clean:
        return {}, {}
    counts = labelled.mapInPandas(words, "word string, toxic int")
    counts = counts.groupBy("word").agg(F.sum("toxic").alias("hits"), F.sum(1 - F.col("toxic")).alias("misses"))
    beginnings = F.array(*[F.when(F.length("word") >= n, F.substring("word", 1, n)) for n in PREFIX_LETTERS])
    patterns = counts.select(F.col("word").alias("pattern"), F.lit(False).alias("prefix"), "hits", "misses").union(
        counts.select(F.explode(F.array_compact(beginnings)).alias("pattern"), F.lit(True), "hits", "misses")
    )
    weight = F.log((F.col("hits") + 0.1) / toxic / ((F.col("misses") + 0.5) / clean))
    enough = max(least, support * toxic)
    found = (
        patterns.groupBy("pattern", "prefix")
        .agg(F.sum("hits").alias("hits"), F.sum("misses").alias("misses"), F.max("hits").alias("largest"))
        .withColumn("weight", weight)
        .where((F.col("hits") >= enough) & (F.col("weight") >= math.log(lift)))
        # A beginning says more than its words only if several of them bear it out.
        .where(~F.col("prefix") | (2 * F.col("largest") <= F.col("hits")))
        .collect()  # at most words per document / support rows, whatever the number of documents
    )
    known = {*TARGETS, *NEGATIONS, *REPORTS}
    lists = {False: {}, True: {}}
    for row in found:
        if row["pattern"] not in known:
            lists[row["prefix"]][row["pattern"]] = row["weight"]
    return lists[False], lists[True]


def fit_logistic(features: np.ndarray, toxic: np.ndarray, decay: float = 1.0) -> tuple[list[float], float]:
    """Ridge logistic regression by Newton steps; the bias is not penalised."""
    rows = np.hstack([features, np.ones((len(features), 1))])
    weights = np.zeros(rows.shape[1])
    penalty = np.full(rows.shape[1], decay)
    penalty[-1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        gradient = rows.T @ (p - toxic) + penalty * weights
        curve = (rows * (p * (1 - p))[:, None]).T @ rows + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights[:-1].tolist(), float(weights[-1])


def learn(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 5,
    sample: int = 20_000,
    support: float = 0.02,
    least: int = 3,
    lift: float = 6.0,
) -> Grammar:
    """A grammar from the labelled documents outside fold 0.

    ``sample`` bounds the labelled documents used, those with the smallest hash of the id. A
    pattern needs ``support`` of the toxic ones (at least ``least``) and ``lift`` times the rate.
    Copies of a text count once, as toxic if one of them is. Only text and label are read. Without labels of both kinds every score is that of the bias.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .where(fold_of("doc_id", folds) != 0)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    # At most `sample` rows of 12 bytes.
    labelled = texts.join(F.broadcast(chosen), "doc_id").groupBy("text").agg(F.max("toxic").alias("toxic")).persist()
    try:
        words, prefixes = pattern_weights(labelled, support, least, lift)
        grammar = Grammar(words, prefixes)

        def described(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = [grammar.features(text).tolist() for text in batch["text"]]
                yield pd.DataFrame({"features": rows, "toxic": batch["toxic"]})

        seen = labelled.mapInPandas(described, "features array<double>, toxic int").toPandas()  # `sample` rows
    finally:
        labelled.unpersist()
    if seen["toxic"].nunique() == 2:
        seen = seen.sort_values("features", ignore_index=True, key=lambda column: column.map(tuple))
        grammar.weights, grammar.bias = fit_logistic(np.stack(seen["features"]), seen["toxic"].to_numpy(float))
        seen_channels = np.stack(seen["features"])[:, : len(CHANNELS)].any(axis=0)
        for offset in (0, len(CHANNELS)):
            for place, channel in enumerate(CHANNELS):
                like, share = PRIOR[channel]
                expected = share * max(0.0, grammar.weights[offset + CHANNELS.index(like)])
                if not seen_channels[place]:
                    grammar.weights[offset + place] = expected
                elif share < 1:
                    grammar.weights[offset + place] = min(grammar.weights[offset + place], expected)
    return grammar


def score_of(text: Column, grammar: Grammar) -> Column:
    """The toxicity score of whole texts, where they are; a null text is empty."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([grammar.score(text) for text in batch], dtype=float)

    return score(text)


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, **learning) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` for every document.

    Nulls: a null text is empty and scores like any text without a match; a null doc_id is kept;
    labels with null parts are not used, contradicting ones count as toxic. Long texts are read
    whole. Repeated rows come out each, an empty table gives no rows, other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    grammar = learn(rows, labels, folds, **learning)
    rows = rows.withColumn("score", score_of(F.col("text"), grammar))
    return rows.select(
        "doc_id",
        (fold_of("doc_id", folds) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
