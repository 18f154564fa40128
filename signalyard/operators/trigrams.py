"""TXT2 by character trigrams: language profiles learned from labelled texts.

A text's words (letters of any script, lower case) are padded with a space on each
side and cut into trigrams.  A profile is, for each language, the smoothed log
probability of each of a bounded number of trigrams (those most frequent over all
languages); a text's language is the one under which the trigrams it shares with
the profile are likeliest.

Spark makes the words; tasks then cut a slice of texts at a time into trigrams with
numpy, three code points as one number.  Learning counts the trigrams of all
labelled rows (slices and partial counts make them few before the shuffle, which
carries distinct trigrams per task).  Scoring looks them up in the profile, at most
``MAX_TRIGRAMS`` rows that go with the task, and gives a row of sums per text, so a
very long text or a language that holds a third of all rows is no large group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise

#: Trigrams of a profile.
MAX_TRIGRAMS = 5000
#: Languages a profile may have.
MAX_LANGUAGES = 200
#: Characters whose trigrams are cut at a time (a longer text is cut alone).
_SLICE_CHARS = 1_000_000
#: Bits of a code point.
_BITS = np.uint64(21)


def spaced(text: str | Column) -> Column:
    """A text's runs of letters, in lower case, with one blank between two."""
    c = F.col(text) if isinstance(text, str) else text
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}]+", " "))


def words(text: str | Column) -> Column:
    """Words of a text: runs of letters, in lower case."""
    return F.filter(F.split(spaced(text), " "), lambda w: w != "")


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The batches in slices of a bounded number of characters, and their texts."""
    for batch in batches:
        texts, start, n = batch.column("spaced").to_pylist(), 0, 0
        for i, text in enumerate(texts):
            n += len(text)
            if n >= _SLICE_CHARS or i == len(texts) - 1:
                yield batch.slice(start, i + 1 - start), texts[start:i + 1]
                start, n = i + 1, 0


def _trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(trigram, number of its text) of the spaced ``texts``, with repeats: one
    around each letter."""
    c = np.frombuffer(f" {' '.join(texts)} ".encode("utf-32-le"), "<u4").astype(np.uint64)
    of = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])[:-1]
    letter = c[1:-1] != ord(" ")
    return ((c[:-2] << (_BITS + _BITS)) | (c[1:-1] << _BITS) | c[2:])[letter], of[letter]


def _write(grams: np.ndarray) -> list[str]:
    low = (np.uint64(1) << _BITS) - np.uint64(1)
    text = np.stack([grams >> (_BITS + _BITS), (grams >> _BITS) & low, grams & low], 1).astype("<u4").tobytes().decode("utf-32-le")
    return [text[i:i + 3] for i in range(0, len(text), 3)]


def _read(grams: list[str]) -> np.ndarray:
    c = np.frombuffer("".join(grams).encode("utf-32-le"), "<u4").astype(np.uint64).reshape(-1, 3)
    return (c[:, 0] << (_BITS + _BITS)) | (c[:, 1] << _BITS) | c[:, 2]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, trigram, n of each slice of rows (lang, spaced)."""
    for batch, texts in _slices(batches):
        langs = np.array(batch.column("lang").to_pylist(), object)
        grams, of = _trigrams(texts)
        for lang in set(langs):
            found, n = np.unique(grams[(langs == lang)[of]], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(_write(found), pa.string()), pa.array(n, pa.int64())],
                                             names=["lang", "trigram", "n"])


def learn(rows: DataFrame, text: str = "text", lang: str = "lang", most: int = MAX_TRIGRAMS) -> DataFrame:
    """The profile of labelled ``rows``: (trigram, lang, log_p), a row for every
    language and trigram, with add-one smoothing.  Rows without a language are
    left out; of equally frequent trigrams the first in order are taken."""
    labelled = rows.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), spaced(text).alias("spaced"))
    counts = materialise(labelled.mapInArrow(_count, "lang string, trigram string, n long")
                         .groupBy("lang", "trigram").agg(F.sum("n").alias("count")), "trigram-counts")
    totals = counts.groupBy("lang").agg(F.sum("count").alias("total"))  # a row a language
    top = counts.groupBy("trigram").agg(F.sum("count").alias("n")).orderBy(F.col("n").desc(), "trigram").limit(most).select("trigram")
    top = materialise(top, "trigram-top")
    size = top.count()
    known = sorted((r["lang"], r["total"]) for r in _few(totals))
    if not known:
        return rows.sparkSession.createDataFrame([], "trigram string, lang string, log_p double")
    # every language beside every trigram
    each = F.explode(F.array(*[F.struct(F.lit(code).alias("lang"), F.lit(total).alias("total")) for code, total in known])).alias("l")
    p = top.select("trigram", each).select("trigram", "l.lang", "l.total").join(counts, ["lang", "trigram"], "left")
    return materialise(p.select("trigram", "lang", F.log((F.coalesce("count", F.lit(0)) + 1) / (F.col("total") + F.lit(size))).alias("log_p")), "trigram-profile")


def _few(per_language: DataFrame) -> list:
    rows = per_language.limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages; is that the language column?")
    return rows


def as_columns(profile: DataFrame, languages: list[str]) -> DataFrame:
    """The profile with a column ``p_<i>`` for each language."""
    of = [F.max(F.when(F.col("lang") == code, F.col("log_p"))).alias(f"p_{i}") for i, code in enumerate(languages)]
    return materialise(profile.groupBy("trigram").agg(*of), "trigram-columns")


def score(rows: DataFrame, profile: DataFrame, key: str, text: str = "text", out: str = "language") -> DataFrame:
    """``key``, ``n_trigrams`` (those of the text that the profile has) and the
    likeliest language, the first in order on a tie; null without a known trigram.
    ``key`` tells the rows apart: rows of one key are one text."""
    languages = sorted(r["lang"] for r in _few(profile.select("lang").distinct()))
    sums = [f"p_{i}" for i in range(len(languages))]
    if not languages:
        return rows.select(key).distinct().select(key, F.lit(0).cast("long").alias("n_trigrams"), F.lit(None).cast("string").alias(out))
    table = sorted(as_columns(profile, languages).collect(), key=lambda r: r["trigram"])  # at most MAX_TRIGRAMS rows
    known = _read([r["trigram"] for r in table])  # in order of code points, as the strings are
    log_p = np.array([[r[p] for p in sums] for r in table], float)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _slices(batches):
            grams, of = _trigrams(texts)
            at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
            held = known[at] == grams
            at, of = at[held], of[held]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(np.bincount(of, minlength=len(texts)), pa.int64()),
                 *[pa.array(np.bincount(of, log_p[at, i], len(texts)), pa.float64()) for i in range(len(sums))]], names=["key", "n", *sums])

    schema = T.StructType([T.StructField("key", rows.schema[key].dataType), T.StructField("n", T.LongType()), *[T.StructField(p, T.DoubleType()) for p in sums]])
    scored = rows.select(F.col(key).alias("key"), spaced(text).alias("spaced")).mapInArrow(run, schema)
    scored = scored.groupBy("key").agg(F.sum("n").alias("n_trigrams"), *[F.sum(p).alias(p) for p in sums])
    best = F.greatest(*sums) if len(sums) > 1 else F.col(sums[0])
    label = F.lit(None).cast("string")
    for code, p in reversed(list(zip(languages, sums))):
        label = F.when(F.col(p) == best, F.lit(code)).otherwise(label)
    return scored.select(F.col("key").alias(key), "n_trigrams", F.when(F.col("n_trigrams") > 0, label).alias(out))
