"""TXT1 with scope: valences of words under negation, intensity and contrast.

One fold over a text's tokens, of built-in expressions on the row.  Tokens are
words (with inner apostrophes) and the marks that end a clause or a sentence.

* A word of the lexicon has a signed weight.  It is multiplied by ``FLIP`` if a
  negation stands among the ``NEGATION_WORDS_AFTER`` words before it, and by each
  intensifier's or dampener's factor among the ``BOOST_WORDS_AFTER`` words before
  it; the end of a clause ends both.
* A contrast word ("but") halves what its sentence has said before it and raises
  what follows by half.
* The label contract is that of the reference's analyser: the shares of positive,
  negative and neutral words add up to 1, a valenced word counting its weight and
  one more, a word without valence one; the label is the largest share, of equal
  ones the first of neg, neu, pos; a text without words has shares 0 and is neg."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lexicons import CONTRASTS, DAMPENERS, INTENSIFIERS, NEGATIONS, VALENCES
from .aggregates import argmax_label

# --- fixed values: windows, in words, and factors
NEGATION_WORDS_AFTER, BOOST_WORDS_AFTER = 3, 2
FLIP, RAISE, DAMP = -0.75, 1.25, 0.75
BEFORE_CONTRAST, AFTER_CONTRAST = 0.5, 1.5

TOKEN_RE = r"[a-z]+(?:'[a-z]+)*|[.!?]|[,;:()]"
_STATE = "struct<negated: int, boosts: int, factor: double, after: double, p: double, n: double, pos: double, neg: double, neu: bigint, words: bigint, hits: bigint>"
_ZERO = ('{"negated": 0, "boosts": 0, "factor": 1.0, "after": 1.0, "p": 0.0, "n": 0.0, "pos": 0.0, "neg": 0.0, "neu": 0, "words": 0, "hits": 0}')


def tokens(text: str | Column) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    plain = F.translate(F.lower(F.coalesce(c, F.lit(""))), "’", "'")
    return F.regexp_extract_all(plain, F.lit(TOKEN_RE), 0)


def _weight(word: Column) -> Column:
    """Weight of a word, 0 for one that the lexicon has not."""
    out = F.lit(0.0)
    for weight in sorted({w for w in VALENCES.values()}):
        out = F.when(word.isin([x for x, w in VALENCES.items() if w == weight]), F.lit(float(weight))).otherwise(out)
    return out


def _step(s: Column, t: Column) -> Column:
    fields = ["negated", "boosts", "factor", "after", "p", "n", "pos", "neg", "neu", "words", "hits"]

    def state(**new) -> Column:
        return F.struct(*[new.get(f, s[f]).alias(f) for f in fields]).cast(_STATE)

    clause = {"negated": F.lit(0), "boosts": F.lit(0), "factor": F.lit(1.0)}
    # a sentence's sums are added once it is over, as a contrast may change them
    sentence = state(**clause, after=F.lit(1.0), pos=s["pos"] + s["p"], neg=s["neg"] + s["n"], p=F.lit(0.0), n=F.lit(0.0))
    factor = F.when(s["boosts"] > 0, s["factor"]).otherwise(F.lit(1.0))
    aged = {"negated": F.greatest(s["negated"] - 1, F.lit(0)), "boosts": F.greatest(s["boosts"] - 1, F.lit(0)),
            "factor": F.when(s["boosts"] > 1, s["factor"]).otherwise(F.lit(1.0)), "words": s["words"] + 1}
    plain = {**aged, "neu": s["neu"] + 1}
    negation = state(**{**plain, "negated": F.lit(NEGATION_WORDS_AFTER)})
    boost = lambda by: state(**{**plain, "boosts": F.lit(BOOST_WORDS_AFTER), "factor": factor * F.lit(by)})
    contrast = state(**{**plain, **clause, "p": s["p"] * BEFORE_CONTRAST, "n": s["n"] * BEFORE_CONTRAST, "after": F.lit(AFTER_CONTRAST)})
    v = _weight(t) * factor * s["after"] * F.when(s["negated"] > 0, F.lit(FLIP)).otherwise(F.lit(1.0))
    valued = state(**{**aged, "hits": s["hits"] + 1, "p": s["p"] + F.when(v > 0, v + 1).otherwise(F.lit(0.0)),
                      "n": s["n"] + F.when(v < 0, 1 - v).otherwise(F.lit(0.0))})
    return F.when(t.isin([".", "!", "?"]), sentence).when(t.isin([",", ";", ":", "(", ")"]), state(**clause)) \
        .when(t.isin(NEGATIONS) | t.endswith("n't"), negation).when(t.isin(INTENSIFIERS), boost(RAISE)).when(t.isin(DAMPENERS), boost(DAMP)) \
        .when(t.isin(CONTRASTS), contrast).when(t.isin(list(VALENCES)), valued).otherwise(state(**plain))


def with_valence(df: DataFrame, text: str = "data") -> DataFrame:
    """``df`` with ``n_words``, ``n_valued``, the shares ``neg``, ``neu``, ``pos``
    and the label ``sentiment``; a null text has no words."""
    zero = F.from_json(F.lit(_ZERO), _STATE)
    d = df.withColumn("_v", F.aggregate(tokens(text), zero, _step))
    pos, neg, neu = F.col("_v.pos") + F.col("_v.p"), F.col("_v.neg") + F.col("_v.n"), F.col("_v.neu").cast("double")
    all_ = pos + neg + neu
    share = lambda x: F.when(all_ > 0, x / all_).otherwise(F.lit(0.0))
    d = d.withColumns({"n_words": F.col("_v.words"), "n_valued": F.col("_v.hits"), "neg": share(neg), "neu": share(neu), "pos": share(pos)}).drop("_v")
    return d.withColumn("sentiment", argmax_label("neg", "neu", "pos"))
