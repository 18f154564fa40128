"""STR6: paragraph text of an HTML page, as built-in expressions.

The reference took ``get_text()`` of every ``<p>`` with an HTML parser.
Here a page is handled by regular expressions over the whole document:
drop ``<script>``/``<style>`` bodies first (pages carry ``</p>`` inside
scripts), take each ``<p ...>`` up to the next ``</p>``, strip inner tags,
decode the common entities, drop blank paragraphs, join with newlines;
a page without any paragraph text gives the fixed placeholder."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values --------------------------------------------------------
NO_CONTENT = "No content found"
SCRIPT_RE = r"(?is)<script(?:\s[^>]*)?>.*?</script\s*>"
STYLE_RE = r"(?is)<style(?:\s[^>]*)?>.*?</style\s*>"
PARAGRAPH_RE = r"(?is)<p(?:\s[^>]*)?>(.*?)</p>"
TAG_RE = r"<[^>]+>"
# Entities decoded, '&amp;' last so '&amp;lt;' stays '&lt;'.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
            ("&nbsp;", " "), ("&amp;", "&")]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _decode(x: Column) -> Column:
    for ent, ch in ENTITIES:
        x = F.replace(x, F.lit(ent), F.lit(ch))
    return x


def paragraphs(html) -> Column:
    """Array of non-blank paragraph texts of the page."""
    body = F.regexp_replace(F.regexp_replace(_c(html), SCRIPT_RE, ""), STYLE_RE, "")
    raw = F.regexp_extract_all(body, F.lit(PARAGRAPH_RE), 1)
    texts = F.transform(raw, lambda p: _decode(F.regexp_replace(p, TAG_RE, "")))
    return F.filter(texts, lambda t: t.rlike(r"\S"))


def paragraph_text(html) -> Column:
    """Newline-joined paragraph text, or the placeholder when none."""
    p = paragraphs(html)
    return F.when(F.size(p) > 0, F.array_join(p, "\n")).otherwise(F.lit(NO_CONTENT))
