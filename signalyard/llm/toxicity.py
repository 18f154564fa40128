"""Toxicity scores from a weighted finite-state pattern grammar.

Transducers for reported speech, negation, insults, threats and targets, composed
into one table (``transducers``), read each clause of a text as a sequence of word
classes and label its insults and threats by context: plain, aimed at a target,
negated, reported.  Insults are the words and stems of a lexicon that is learned
from labelled rows; a label's weight in the score is learned too, from the matches
of other rows, and stays near its prior where no row has one.  So a lone word and
the same word aimed at somebody, denied or quoted weigh differently, and a text's
score is a logistic function of what its clauses match."""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from signalyard.llm.common import cut, text_or_empty
from signalyard.llm.transducers import CLASSES, INSULT, LABELS, LONGEST_GAP, NEGATION, OTHER, REPORT, TARGET, THREAT, Table, grammar

#: At most about this many labelled rows are learned from (by doc_id hash), and
#: this many lexicon entries kept (the most telling first).
TRAIN_ROWS = 20_000
LEXICON_ENTRIES = 5_000
#: What a lexicon entry needs: evidence (likelihood ratio statistic) and log odds.
EVIDENCE, ODDS = 24.0, 3.0
#: A document with this score or more is toxic.
THRESHOLD = 0.3

# The closed word classes of the grammar, in the tables' languages.
TARGETS = frozenset("you your yours he she him her they them those these du dich dir ihr euch sie tu toi te vous "
                    "ils elles tú ti usted ustedes él ella ellos ellas".split())
NEGATIONS = frozenset("not never no isn't aren't wasn't don't doesn't didn't cannot can't nicht nie kein keine "
                      "ne pas jamais nunca jamás tampoco".split())
REPORTS = frozenset("said says say wrote writes called calls quoted reported claimed sagte sagt schrieb nannte "
                    "dit disait écrit appelle dijo dice escribió llamó".split())
THREATS = frozenset("kill hurt destroy burn beat stab shoot murder crush töten schlagen umbringen verletzen tuer "
                    "frapper détruire brûler matar golpear destruir quemar".split())

_STEMS = range(3, 9)
#: A text's numbers: the mass of its matches by label (a lexicon word's weight, 1
#: for a threat), the largest clause, matches per hundred words, different matched
#: words.
N_FEATURES = len(LABELS) + 3
#: What the labels weigh before rows are seen, by kind and context, and the others.
PRIOR = [1.0, 1.5, 0.3, 0.2, 0.4, 1.5, 0.1, 0.2, 0.0, 0.0, 0.0]
#: The composed grammar; the same in every process.
TABLE = Table(grammar())
_CLASS = {c: i for i, c in enumerate(CLASSES)}
_END = tuple(".!?;:,")


def word_of(token: str) -> str:
    return token.strip(_EDGE).lower()


_EDGE = string.punctuation + "“”„«»¡¿…"


def lexical_features(word: str) -> list[str]:
    """The word itself and its stems (its first characters)."""
    return [word + "$", *(word[:n] for n in _STEMS if len(word) > n)]


@dataclass
class Grammar:
    """``lexicon``: weights of words (ending in $) and stems.  ``coef``, ``bias``:
    of the logistic over match features.  ``max_known`` bounds the remembered
    tokens."""

    lexicon: dict[str, float]
    coef: list[float] = field(default_factory=lambda: [0.0] * N_FEATURES)
    bias: float = -3.0
    max_known: int = 200_000

    def __post_init__(self):
        self._known: dict[str, tuple] = {}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_known"}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._known = {}

    def symbol(self, token: str) -> tuple:
        """(class number, weight, whether a clause ends) of a word, or () for a
        word of no class within a clause."""
        word = word_of(token)
        weight = max((self.lexicon.get(f, 0.0) for f in lexical_features(word)), default=0.0) if word else 0.0
        kind = (INSULT if weight else THREAT if word in THREATS else TARGET if word in TARGETS
                else NEGATION if word in NEGATIONS else REPORT if word in REPORTS else OTHER)
        end = token.endswith(_END)
        return (_CLASS[kind], weight or float(kind == THREAT), end) if end or kind != OTHER else ()

    def features(self, text: str) -> np.ndarray | None:
        """The text's match features, or None if no clause matches."""
        known, words = self._known, text.split()
        symbols = list(map(known.get, words))
        if None in symbols:
            for i, s in enumerate(symbols):
                if s is None:
                    symbols[i] = s = self.symbol(words[i])
                    if len(known) < self.max_known:
                        known[words[i]] = s
        marked = [(i, s) for i, s in enumerate(symbols) if s]
        if not any(s[1] for _, s in marked):
            return None
        out = np.zeros(N_FEATURES)
        clause: list[tuple[int, tuple]] = []
        for i, s in marked:
            clause.append((i, s))
            if s[2]:
                self._clause(clause, out)
                clause = []
        self._clause(clause, out)
        out[-2] = 100 * out[:-3].sum() / len(words)
        out[-1] = len({word_of(words[i]) for i, s in marked if s[1]})
        return np.log1p(out)

    @staticmethod
    def _clause(clause: list[tuple[int, tuple]], out: np.ndarray) -> None:
        """Reads one clause - its words that have a class, with their places - and
        adds the mass of its matches by label."""
        masses = [s[1] for _, s in clause if s[1]]
        if not masses:
            return
        read, before = [], clause[0][0] - 1
        for i, s in clause:
            read += [_CLASS[OTHER]] * min(i - before - 1, LONGEST_GAP)
            read.append(s[0])
            before = i
        for label, mass in zip(TABLE.labels(read), masses, strict=True):
            out[label] += mass
        out[-3] = max(out[-3], sum(masses))

    def score(self, text: str) -> float:
        x = self.features(text)
        z = self.bias if x is None else self.bias + float(x @ np.array(self.coef))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


# -- learning ----------------------------------------------------------------

def fold(doc_id: Column) -> Column:
    """crc32 of the doc_id as text, modulo 4 (a null id is the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, text, toxic of labelled documents outside the held-out fold, at
    most about ``rows`` of them, chosen by a hash of doc_id.  Of several labels
    of a document the largest holds; null labels are none."""
    known = (labels.filter("toxic is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max("toxic").alias("toxic")).filter(fold(F.col("doc_id")) != 2))
    known = cut(known)
    share = min(1.0, rows / max(1, known.count()))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1_000_000)) < share * 1_000_000)
    # The chosen ids are at most about ``rows``, so they are sent to every task.
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).join(
        F.broadcast(chosen), "doc_id")


def _telling(rows: DataFrame, words: dict[str, float] | None, entries: int) -> dict[str, float]:
    """Log odds of the features that more toxic documents hold than chance
    allows: words if ``words`` is None; else stems, counted where ``words`` do
    not explain the document already."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            tallies, n = (Counter(), Counter()), [0, 0]
            for text, label in zip(frame["text"], frame["toxic"]):
                own = {w + "$" for w in map(word_of, set(text.split())) if w}
                if words is not None:
                    if label and not own.isdisjoint(words):
                        continue
                    own = {f for w in own.difference(words) for f in lexical_features(w[:-1])[1:]}
                tallies[label].update(own)
                n[label] += 1
            keys = [k for t in tallies for k in t]
            # one row without a feature counts the documents
            yield pd.DataFrame({"feature": [None, *keys], "t": [n[1], *([0] * len(tallies[0])), *tallies[1].values()],
                                "c": [n[0], *tallies[0].values(), *([0] * len(tallies[1]))]})

    counted = cut(rows.mapInPandas(count, "feature string, t long, c long")
                  .groupBy("feature").agg(F.sum("t").alias("t"), F.sum("c").alias("c")))
    total = counted.filter("feature is null").first()
    if not total or not total.t or not total.c:
        return {}
    t, c, n_t, n_c = F.col("t"), F.col("c"), float(total.t), float(total.c)
    evidence = 2 * t * F.log(t * (n_t + n_c) / ((t + c) * n_t))
    odds = F.log((t + 0.5) / (n_t - t + 0.5)) - F.log((c + 0.5) / (n_c - c + 0.5))
    best = (counted.filter("feature is not null and t > 0").withColumn("evidence", evidence).withColumn("odds", odds)
            .filter((F.col("evidence") >= EVIDENCE) & (F.col("odds") >= ODDS))
            .orderBy(F.desc("evidence"), "feature").limit(entries))
    return {r.feature: min(6.0, r.odds) for r in best.select("feature", "odds").collect()}


def learn_lexicon(rows: DataFrame, entries: int = LEXICON_ENTRIES) -> dict[str, float]:
    """Weights of the words, and of stems that explain what the words do not,
    from rows (text, toxic)."""
    rows = rows.select("text", (F.col("toxic") > 0).cast("int").alias("toxic"))
    words = _telling(rows, None, entries)
    return words | _telling(rows, words, entries)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 50, prior: list[float] | None = None) -> tuple[list[float], float]:
    """Logistic regression by Newton steps; weights are shrunk to ``prior`` (0
    without one), so one that no row speaks for has that value; the bias is not."""
    a = np.hstack([x, np.ones((len(x), 1))])
    middle = np.append(prior or np.zeros(x.shape[1]), 0.0)
    w = np.zeros(a.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty), a.T @ (p - y) + penalty * (w - middle))
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1].tolist(), float(w[-1])


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Grammar:
    """A grammar whose lexicon is learned from two thirds of the training rows
    and whose weights by context from the rest.  Without labels of both kinds
    nothing scores as toxic."""
    chosen = cut(training_rows(docs, labels, rows).withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3))))
    grammar = Grammar(learn_lexicon(chosen.filter("half < 2")))
    if not grammar.lexicon:
        return grammar

    def matches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            x = [grammar.features(t) for t in frame["text"]]
            yield pd.DataFrame({"x": [[0.0] * N_FEATURES if f is None else f.tolist() for f in x], "y": frame["toxic"]})

    # N_FEATURES numbers for each of at most about ``rows`` / 3 documents.
    sample = chosen.filter("half = 2").select("text", (F.col("toxic") > 0).cast("double").alias("toxic")).mapInPandas(
        matches, "x array<double>, y double").toPandas()
    if sample["y"].nunique() == 2:
        grammar.coef, grammar.bias = fit(np.array(sample["x"].tolist()), sample["y"].to_numpy(), prior=PRIOR)
    return grammar


# -- scoring -----------------------------------------------------------------

def score(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """``docs`` with a column toxicity, replaced if there is one.  A null text
    is empty; it scores as a text without a match.  No shuffle."""

    @F.pandas_udf("double")
    def scored(text: pd.Series) -> pd.Series:
        return pd.Series([grammar.score(t or "") for t in text], dtype="float64")

    return docs.withColumn("toxicity", scored("text"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``: the grammar
    learned from the rows outside the held-out fold, applied to all.  An empty
    table gives no rows; repeated rows score alike; other columns are not read."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return score(docs, train(docs, labels)).select(
        "doc_id", (fold(F.col("doc_id")) == 2).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"))
