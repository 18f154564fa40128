"""String column functions: STR1-STR5, STR7, PRJ16-PRJ19.

All are compositions of built-in expressions (``regexp_replace``,
``lower``, ``forall`` ...), so they run inside whole-stage codegen with no
Python on the executors.  Each regular expression is applied to the whole
text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: clean_text patterns, in the reference's order --------
# "literal": the reference's pattern texts as it wrote them (a raw string
# with doubled backslashes, so patterns 2-5 look for a literal backslash
# and pattern 6 keeps backslash and 's' but deletes all whitespace).
# "intended": the same patterns with single backslashes.
CLEAN_PATTERNS_LITERAL = [
    (r"<[^>]+>", ""),
    (r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}\b", ""),
    (r"http[s]?://\\S+|www\\.\\S+", ""),
    (r"\\b\\d{10,}\\b", ""),
    (r"\\s+", " "),
    # all but [a-zA-Z0-9\\s], the backslash and 's' as they are: a list of ranges is
    # matched several times faster than a negated class
    (r"[\x00-/:-@\[\]-`{-\x{10ffff}]+", ""),
]
# White space of any script, as the reference's patterns match it; one range test
# tells most characters from the rare ones.
_SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}[\x{1680}-\x{3000}&&[\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]"
CLEAN_PATTERNS_INTENDED = [
    (r"<[^>]+>", ""),
    (r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b", ""),
    (r"http[s]?://\S+|www\.\S+", ""),
    (r"(?=\d)\b\d{10,}\b", ""),
    (rf"(?! )[{_SPACE}]+| [{_SPACE}]+", " "),  # a blank alone stays as it is
    (r"[\x00-\x08\x0e-\x1f!-/:-@\[-`{-\x{10ffff}]+", ""),  # all but [a-zA-Z0-9\s], likewise
]
# Index of the whitespace-collapse step, after which the text is stripped.
_STRIP_AFTER = 4

# --- fixed values: news filtering -----------------------------------------
REMOVED_URL = "https://removed.com"
NEWSAPI_TOO_FAR = "You are trying to request results too far in the past."
WORLDNEWSAPI_TOO_FAR = "On the free and starter plan, you cannot look back further than 1"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _once(c: Column, then) -> Column:
    """``then(c)``, for which ``c`` is evaluated once however often it is used:
    below a higher-order function Spark evaluates each use anew."""
    return F.transform(F.array(c), lambda v: then(v))[0]


def clean_text(c, mode: str = "literal") -> Column:
    """STR1: strip tags, e-mails, URLs, long numbers; collapse whitespace,
    strip, drop non-alphanumerics, lower-case.  Null -> ''.

    Patterns that cannot match are skipped by a substring test first (an
    exact shortcut: ``contains`` is a byte search, the regex a scan): the
    e-mail pattern needs '@', the URL pattern 'http' or 'www.', and every
    literal-mode pattern 2-5 needs a backslash."""
    patterns = CLEAN_PATTERNS_LITERAL if mode == "literal" else CLEAN_PATTERNS_INTENDED
    out = F.regexp_replace(_c(c).cast("string"), F.lit(patterns[0][0]), F.lit(patterns[0][1]))
    if mode == "literal":
        def escaped(v):
            mid = v
            for pat, rep in patterns[1:_STRIP_AFTER + 1]:
                mid = F.regexp_replace(mid, F.lit(pat), F.lit(rep))
            return F.when(F.contains(v, F.lit("\\")), mid).otherwise(v)
        out = _once(out, escaped)
    else:
        (p1, r1), (p2, r2), (p3, r3), (p4, r4) = patterns[1:_STRIP_AFTER + 1]
        out = _once(out, lambda v: F.when(F.contains(v, F.lit("@")), F.regexp_replace(v, F.lit(p1), F.lit(r1))).otherwise(v))
        url = lambda v: F.contains(v, F.lit("http")) | F.contains(v, F.lit("www."))
        out = _once(out, lambda v: F.when(url(v), F.regexp_replace(v, F.lit(p2), F.lit(r2))).otherwise(v))
        out = F.regexp_replace(F.regexp_replace(out, F.lit(p3), F.lit(r3)), F.lit(p4), F.lit(r4))
    out = F.trim(out)
    for pat, rep in patterns[_STRIP_AFTER + 1:]:
        out = F.regexp_replace(out, F.lit(pat), F.lit(rep))
    return F.coalesce(F.lower(out), F.lit(""))


def contains_all(c, keywords: list[str], mode: str = "literal") -> Column:
    """PRJ16/STR2: the lower-cased body contains every keyword.  Literal
    mode does not lower the keywords (so a capitalised keyword never
    matches, as in the reference); intended mode lowers both."""
    body = F.lower(_c(c))
    kws = [k.lower() if mode == "intended" else k for k in keywords]
    if not kws:
        return F.lit(True)
    arr = F.array(*[F.lit(k) for k in kws])
    return F.forall(arr, lambda k: F.contains(body, k))


def feed_kind(source) -> Column:
    """STR5: second '_' token of the source name ('news', 'stock', ...)."""
    return F.split_part(_c(source), F.lit("_"), F.lit(2))


def strip_backslashes(c) -> Column:
    """SRC5/STR7: delete every backslash (envelope repair before parsing)."""
    return F.translate(_c(c), "\\", "")


def prefix_equals(c, prefix: str) -> Column:
    """STR4: first len(prefix) characters equal ``prefix``."""
    return F.substring(_c(c), 1, len(prefix)) == F.lit(prefix)


def too_far_in_past(status, message, api: str = "newsapi") -> Column:
    """PRJ19: error-response predicate; absent status -> False."""
    if api == "newsapi":
        hit = (_c(status) == "error") & prefix_equals(message, NEWSAPI_TOO_FAR)
    else:
        hit = (_c(status) == "failure") & prefix_equals(message, WORLDNEWSAPI_TOO_FAR)
    return F.coalesce(hit, F.lit(False))


def keep_article(url, text) -> Column:
    """PRJ17: drop removed articles and articles without text."""
    return (F.coalesce(_c(url) != F.lit(REMOVED_URL), F.lit(True))) & _c(text).isNotNull()


def api_news_rows(df, url_col: str = "url", text_col: str = "text", date_col: str = "publish_date"):
    """PRJ17 + PRJ18: the articles to keep, in the lake item shape (``data``,
    ``date``)."""
    return df.filter(keep_article(url_col, text_col)).select(F.col(text_col).alias("data"), F.col(date_col).alias("date"))
