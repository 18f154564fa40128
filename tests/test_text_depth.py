"""Trigram language profiles and valences with scope, against plain Python."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from signalyard.functions import lexicons as LX
from signalyard.operators import trigrams as TG
from signalyard.operators import valence as VL

from .conftest import SF_ORACLE


def grams(text):
    words = re.sub(r"[\W\d_]+", " ", (text or "").lower()).split()
    return [f" {w} "[i:i + 3] for w in words for i in range(len(w))]


def test_trigram_scores_equal_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["der", "die", "und", "Übung", "the", "of", "and", "thing", "le", "été", "çà", "x"]) + rng.choice(["", ",", "1"])
                         for _ in range(rng.randrange(0, 30))), rng.choice(["de", "en", "fr", None])) for i in range(80)]
    rows += [(100, None, "de"), (101, "", "en"), (102, "123 !?", "fr"), (103, "zzz qqq", "en"), (104, "日本語 テキスト", None), (104, "the of", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("log_p", F.lit("clash"))
    counts = {}
    for _, t, lang in rows:
        if lang:
            counts.setdefault(lang, Counter()).update(grams(t))
    for most in (20, 5000):
        every = Counter()
        for c in counts.values():
            every.update(c)
        top = [t for t, _ in sorted(every.items(), key=lambda kv: (-kv[1], kv[0].encode()))[:most]]
        profile = TG.learn(df, most=most)
        want = {(t, lang): math.log((c[t] + 1) / (sum(c.values()) + len(top))) for t in top for lang, c in counts.items()}
        got = {(r["trigram"], r["lang"]): r["log_p"] for r in profile.collect()}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)
        of = {}
        for i, t, _ in rows:
            of.setdefault(i, []).extend(g for g in grams(t) if g in set(top))
        scored = {r["doc_id"]: (r["n_trigrams"], r["language"]) for r in TG.score(df, profile, "doc_id").collect()}
        assert scored.keys() == of.keys()
        for i, gs in of.items():
            sums = {lang: sum(want[(g, lang)] for g in gs) for lang in counts}
            best = max(sums.values())
            assert scored[i][0] == len(gs)
            assert (scored[i][1] is None) == (not gs) and (not gs or sums[scored[i][1]] == pytest.approx(best, abs=1e-9))


def test_without_labelled_rows_no_language_is_named(spark):
    df = spark.createDataFrame([(1, "the", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in TG.score(df, TG.learn(df), "doc_id").collect()] == [(1, 0, None)]
    assert TG.score(df.limit(0), TG.learn(df), "doc_id").count() == 0


def test_held_out_accuracy(spark):
    """Held-out documents, whole and cut to short texts (under 20 words)."""
    d = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "text", "lang")
    held = F.col("doc_id") % 4 == 1
    profile = TG.learn(d.filter(~held))
    short = d.filter(held).withColumn("text", F.array_join(F.slice(TG.words("text"), 1, 19), " "))
    for rows, least in ((d.filter(held), 0.97), (short, 0.9)):
        r = TG.score(rows, profile, "doc_id").join(rows.select("doc_id", "lang"), "doc_id")
        assert r.agg(F.avg((F.col("language") == F.col("lang")).cast("int"))).first()[0] >= least


def shares(text):
    """The rules of valence.py, token by token."""
    negated = boosts = words = hits = 0
    factor = after = 1.0
    p = n = pos = neg = neu = 0.0
    for t in re.findall(r"[a-z]+(?:'[a-z]+)*|[.!?]|[,;:()]", (text or "").lower().replace("’", "'")):
        if t in ".!?,;:()":
            negated, boosts, factor = 0, 0, 1.0
            if t in ".!?":
                pos, neg, p, n, after = pos + p, neg + n, 0.0, 0.0, 1.0
            continue
        f = factor if boosts > 0 else 1.0
        was_negated = negated > 0
        words += 1
        factor = factor if boosts > 1 else 1.0
        negated, boosts = max(negated - 1, 0), max(boosts - 1, 0)
        if t in LX.NEGATIONS or t.endswith("n't"):
            negated, neu = VL.NEGATION_WORDS_AFTER, neu + 1
        elif t in LX.INTENSIFIERS or t in LX.DAMPENERS:
            boosts, factor, neu = VL.BOOST_WORDS_AFTER, f * (VL.RAISE if t in LX.INTENSIFIERS else VL.DAMP), neu + 1
        elif t in LX.CONTRASTS:
            negated, boosts, factor, p, n, after, neu = 0, 0, 1.0, p * VL.BEFORE_CONTRAST, n * VL.BEFORE_CONTRAST, VL.AFTER_CONTRAST, neu + 1
        elif t in LX.VALENCES:
            v = LX.VALENCES[t] * f * after * (VL.FLIP if was_negated else 1.0)
            hits += 1
            p, n = (p + v + 1, n) if v > 0 else (p, n + 1 - v)
        else:
            neu += 1
    pos, neg = pos + p, neg + n
    total = pos + neg + neu
    s = [x / total if total else 0.0 for x in (neg, neu, pos)]
    return words, hits, s, ["neg", "neu", "pos"][s.index(max(s))]


def test_valences_equal_the_rules(spark):
    rng = random.Random(4)
    bag = list(LX.VALENCES)[:12] + list(LX.VALENCES)[-8:] + LX.NEGATIONS[:3] + LX.INTENSIFIERS[:2] + LX.DAMPENERS[:2] + LX.CONTRASTS + \
        ["market", "the", "don't", "isn’t", ".", "!", ",", ";", "GREAT", "é", "x9y", "'"]
    texts = [" ".join(rng.choice(bag) for _ in range(rng.randrange(25))) for _ in range(500)]
    texts += [None, "", "...", "not", "very", "good " * 30_000 + "not bad", "n't good"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, data string")
    got = {r["i"]: r for r in VL.with_valence(df).collect()}
    for i, t in enumerate(texts):
        words, hits, s, label = shares(t)
        r = got[i]
        assert (r["n_words"], r["n_valued"]) == (words, hits), t
        assert [r["neg"], r["neu"], r["pos"]] == pytest.approx(s, abs=1e-12) and r["sentiment"] == label, t
        assert not words or sum(s) == pytest.approx(1.0)


def test_scope_changes_labels(spark):
    cases = [("profit", "pos"), ("not profit", "neg"), ("no crisis", "pos"), ("never great", "neg"), ("not, great", "pos"), ("loss but great growth", "pos"),
             ("great growth but loss, crash", "neg"), ("extremely bad", "neg"), ("isn't bad", "pos"), ("the market", "neu"), ("", "neg")]
    df = spark.createDataFrame(cases, "data string, want string")
    assert [(r["data"], r["sentiment"]) for r in VL.with_valence(df).collect()] == cases
