"""Text is scanned once, no row is made for a trigram, and whole texts are not shuffled."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from signalyard.functions.text import clean_text
from signalyard.llm import bagminhash as bm
from signalyard.operators import trigrams as TG
from signalyard.operators.text_scoring import tokens
from signalyard.plans import catalog, frames
from signalyard.session import materialise
from tests.conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().toString()


def test_trigrams_are_counted_without_a_row_each(spark):
    df = spark.createDataFrame([(1, "The cat, the \U00020000\U00020001 é", "en"), (None, "le chat", "fr"), (1, "x", "en"), (2, None, None)],
                               "doc_id long, text string, lang string")
    scored = TG.score(df, TG.learn(df), "doc_id")
    assert "Generate" not in plan(scored) and "explode" not in plan(scored)
    assert {r["doc_id"]: r["n_trigrams"] for r in scored.collect()} == {1: 13, None: 6, 2: 0}


def test_trigrams_of_slices_are_those_of_the_texts(monkeypatch):
    rng = random.Random(3)
    texts = ["", *(" ".join("".join(rng.choices("abé\U00020000", k=rng.randrange(1, 6))) for _ in range(rng.randrange(6))) for _ in range(40)), ""]
    monkeypatch.setattr(TG, "_SLICE_CHARS", 7)
    got = []
    for batch, some in TG._slices([pa.RecordBatch.from_pydict({"spaced": texts})]):
        grams, of = TG._trigrams(some)
        assert batch.num_rows == len(some) and (TG._read(TG._write(grams)) == grams).all()
        got += [[g for g, o in zip(TG._write(grams), of) if o == i] for i in range(len(some))]
    assert got == [[f" {w} "[i:i + 3] for w in t.split() for i in range(len(w))] for t in texts]


def test_cleaning_below_a_function_of_tokens_scans_a_text_once(spark):
    df = spark.createDataFrame([("a@b.com <b>x</b> www.y.z 12345678901",)], "t string").select(tokens(clean_text("t", "intended")).alias("w"))
    optimised = df._jdf.queryExecution().optimizedPlan().toString()
    assert optimised.count("<[^>]+>") == 1
    assert df.first()["w"] == ["x"]


def test_ranges_are_the_characters_that_the_negated_classes_named(spark):
    every = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x11000), 0x20000, 0x10FFFF]]
    df = spark.createDataFrame([(c,) for c in every], "c string")
    for mode, kept, old in (("intended", "\t\n\x0b\x0c\r ", r"[^a-zA-Z0-9\s]"), ("literal", "\\", r"[^a-zA-Z0-9\\s]")):
        from signalyard.functions import text as TX
        new = (TX.CLEAN_PATTERNS_INTENDED if mode == "intended" else TX.CLEAN_PATTERNS_LITERAL)[-1][0]
        assert new != old
        assert df.filter(F.regexp_replace("c", F.lit(new), F.lit("")) != F.regexp_replace("c", F.lit(old), F.lit(""))).isEmpty()


def test_white_space_runs_become_one_blank(spark):
    df = spark.createDataFrame([("a b  c \n d\n\ne\t f  g  ",)], "t string")
    assert df.select(clean_text("t", "intended")).first()[0] == "a b c d e f g"


def test_guesses_are_made_once_for_codes_and_output(spark):
    assert "regexp_replace" not in plan(catalog.label_encode_missing(spark, SF_SMALL))


def test_articles_are_scored_once_for_both_frames(spark, monkeypatch):
    real, calls = frames.scored_news, []
    monkeypatch.setattr(frames, "scored_news", lambda *a, **k: calls.append(1) or real(*a, **k))
    catalog.predict_history(spark, SF_SMALL)
    assert len(calls) == 1


def test_texts_of_wanted_rows_are_found_without_a_shuffle(spark):
    rng = random.Random(5)
    n = 40_000
    rows = spark.range(n, numPartitions=3).select(F.monotonically_increasing_id().alias("row"), F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    docs = materialise(rows, "numbered")
    picked = sorted({r["row"] for r in docs.select("row").collect() if rng.random() < 0.4})
    wanted = materialise(spark.createDataFrame([(int(r),) for r in np.repeat(picked, 2)], "row long"), "wanted")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
    try:
        bags = bm._bags(docs, wanted)
        physical = bags._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin" in physical and "SortMergeJoin" not in physical
        assert sorted(r["row"] for r in bags.select("row").collect()) == picked
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
