"""TXT1 sentiment label and TXT2 language guess.

Both score one document per row, in one pass over its whole text, with
built-in expressions: tokens = ``split`` of the cleaned text, hits =
``size(filter(listed, t -> t IN words))`` among the tokens that any list has
(one pass over all tokens).  Catalyst rewrites the literal
``IN`` list into a hash-set lookup, so the cost is linear in text length;
there is no explode, no join and no shuffle, so a 20,000-word document
or a source holding a third of all documents splits across tasks like
any other rows.  The word lists are fixed values in
``functions.lexicons``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lexicons import LANGUAGE_ORDER, LANGUAGE_PROFILES, NEGATIVE_WORDS, POSITIVE_WORDS
from ..functions.text import clean_text
from .aggregates import argmax_label


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokens(cleaned) -> Column:
    """Whitespace tokens of already-cleaned text, empties dropped."""
    return F.filter(F.split(_c(cleaned), " "), lambda t: t != "")


def hits(toks: Column, words: list[str]) -> Column:
    return F.size(F.filter(toks, lambda t: t.isin(words)))


def listed(toks: Column, lists: list[list[str]]) -> Column:
    """The tokens that are in one of the word lists: one pass over the text's
    tokens, so that the hits of each list are counted among these few."""
    return F.filter(toks, lambda t: t.isin(sorted({w for words in lists for w in words})))


def sentiment_scores(df: DataFrame, text_col: str = "data", cleaned: bool = False,
                     tokens_col: str | None = None) -> DataFrame:
    """TXT1: adds ``n_tokens, pos_hits, neg_hits, neg, neu, pos`` (shares)
    and ``sentiment`` (AGG9 argmax; an empty text scores 0/0/0 and
    resolves to 'neg' by the tie rule, like the reference library).
    ``tokens_col`` reuses tokens already computed on the row."""
    if tokens_col:
        d, tok = df, F.col(tokens_col)
    else:
        txt = _c(text_col) if cleaned else clean_text(text_col, "intended")
        d, tok = df.withColumn("_tok", tokens(txt)), F.col("_tok")
    d = d.withColumn("n_tokens", F.size(tok)).withColumn("_listed", listed(tok, [POSITIVE_WORDS, NEGATIVE_WORDS])) \
        .withColumn("pos_hits", hits(F.col("_listed"), POSITIVE_WORDS)) \
        .withColumn("neg_hits", hits(F.col("_listed"), NEGATIVE_WORDS)).drop("_listed")
    if not tokens_col:
        d = d.drop("_tok")
    n = F.col("n_tokens").cast("double")
    share = lambda x: F.when(n > 0, x / n).otherwise(F.lit(0.0))
    d = d.withColumn("neg", share(F.col("neg_hits"))) \
        .withColumn("pos", share(F.col("pos_hits"))) \
        .withColumn("neu", F.when(n > 0, (n - F.col("pos_hits") - F.col("neg_hits")) / n)
                    .otherwise(F.lit(0.0)))
    return d.withColumn("sentiment", argmax_label("neg", "neu", "pos"))


def with_language(df: DataFrame, text_col: str = "data", out: str = "language",
                  cleaned: bool = False, tokens_col: str | None = None) -> DataFrame:
    """TXT2: profile hits per language, argmax, ties to the first code;
    no hit at all (blank or junk text) -> null.  Tokens are materialised
    once per row (``_tok``, or ``tokens_col``) and shared by the four
    profile counts."""
    if tokens_col:
        d, tok = df, F.col(tokens_col)
    else:
        txt = _c(text_col) if cleaned else clean_text(text_col, "intended")
        d, tok = df.withColumn("_tok", tokens(txt)), F.col("_tok")
    d = d.withColumn("_listed", listed(tok, [LANGUAGE_PROFILES[c] for c in LANGUAGE_ORDER]))
    d = d.withColumn("_ls", F.array(*[hits(F.col("_listed"), LANGUAGE_PROFILES[c]) for c in LANGUAGE_ORDER])).drop("_listed")
    best = F.array_max("_ls")
    label = F.when(best <= 0, F.lit(None).cast("string"))
    for i, code in enumerate(LANGUAGE_ORDER):
        label = label.when(F.col("_ls")[i] == best, F.lit(code))
    d = d.withColumn(out, label).drop("_ls")
    return d if tokens_col else d.drop("_tok")


def with_text_scores(df: DataFrame, text_col: str = "data") -> DataFrame:
    """STR1 (intended) and one tokenisation, shared by TXT1 and TXT2; adds
    ``sentiment`` (neg/neu/pos) and ``language`` (code or null)."""
    d = df.withColumn("_stok", tokens(clean_text(text_col, "intended")))
    d = sentiment_scores(d, tokens_col="_stok")
    d = with_language(d, out="language", tokens_col="_stok")
    return d.drop("_stok", "n_tokens", "pos_hits", "neg_hits", "neg", "neu", "pos")
