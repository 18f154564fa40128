"""STR6: paragraph text of an HTML page by a stack machine over its tag stream.

A page is split into tokens - comments, declarations, whole raw-text elements,
tags, text - by one regular expression, and a fold (``aggregate``) carries a stack
of open elements over them, all built-in expressions on the row.  The rules:

* A start tag opens an element; void elements and ``<x/>`` open none.  Paragraphs
  may nest: a ``<p>`` within an open one is another paragraph, and its text is
  that of both.
* An end tag closes the innermost open element of its name and all that were
  opened after it (unclosed ones end with it); without one it means nothing.
* What is open at the page's end is closed there.
* ``script`` and ``style`` hold raw text up to their own end tag, or the page's
  end; it is no text.  Nor are comments and declarations.  A ``>`` in a quoted
  attribute does not end a tag; a ``<`` that begins none of these is text.
* Character references in text are decoded: decimal and hexadecimal ones (those of
  the Windows-1252 range as that, invalid ones as U+FFFD) and all named ones, the
  ``;`` of which may be missing for the old names.

Paragraphs come in the order of their start tags; blank ones are left out."""

from __future__ import annotations

import html.entities

from pyspark.sql import Column
from pyspark.sql import functions as F

from .html import NO_CONTENT

# --- fixed values: elements without content, and with raw text
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link", "menuitem", "meta", "param", "source", "track", "wbr",
        "basefont", "bgsound", "command", "frame", "image", "isindex", "nextid", "spacer"]
RAW = ["script", "style"]

_ATTRIBUTES = r"""(?:"[^"]*+"|'[^']*+'|[^'">]++|["'])*?"""
#: Raw elements and comments up to their end or the page's.
TOKEN_RE = ("(?i)<!--(?s:.*?)(?:-->|\\z)|<[!?](?:[^>]*+)(?:>|\\z)|"
            + "|".join(f"<{r}(?=[\\s/>]){_ATTRIBUTES}>(?s:.*?)(?:</{r}(?=[\\s/>])[^>]*+>|\\z)" for r in RAW)
            + f"|</?[a-z][^\\s/>]*+{_ATTRIBUTES}>|[^<]++|<")
_REFERENCE_RE = r"&(?:#[xX][0-9a-fA-F]++|#[0-9]++|[A-Za-z][A-Za-z0-9]*+);?|[^&]++|&"
#: White space as get_text().strip() has it.
_NOT_BLANK_RE = r"[^\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_STATE = ("struct<stack: array<string>, open: array<struct<at: int, depth: int, text: string>>, n: int, "
          "done: array<struct<at: int, depth: int, text: string>>>")


def _names() -> Column:
    """Text of each named reference, by its name (with ``;`` or, for the old ones,
    without): a constant that is made once a query."""
    pairs = "\x02".join(f"{name}\x01{text}" for name, text in html.entities.html5.items())
    return F.str_to_map(F.lit(pairs), F.lit("\x02"), F.lit("\x01"))


def _code_point(number: Column) -> Column:
    """Text of a code point (a long)."""
    windows = {i: bytes([i]).decode("cp1252", "replace") for i in range(0x80, 0xa0)}
    table = F.create_map(*[F.lit(x) for kv in windows.items() for x in kv])
    bad = (number > 0x10ffff) | number.between(0xd800, 0xdfff) | (number == 0)
    plain = F.decode(F.unhex(F.lpad(F.hex(F.when(bad, F.lit(0xfffd)).otherwise(number)), 8, "0")), "UTF-32")
    return F.when(number.between(0x80, 0x9f), F.element_at(table, number.cast("int"))).otherwise(plain)


def decoded(text: Column) -> Column:
    """``text`` with its character references decoded."""
    def one(r: Column) -> Column:
        digits = F.rtrim(r, F.lit(";"))
        # more digits than a code point has are invalid anyway
        hexadecimal = F.conv(F.right(F.concat(F.lit("0"), F.substring(digits, 4, 1 << 30)), F.lit(15)), 16, 10).cast("long")
        decimal = F.right(F.concat(F.lit("0"), F.substring(digits, 3, 1 << 30)), F.lit(18)).cast("long")
        leading = F.length(F.ltrim(F.regexp_replace(digits, "^&#[xX]?", ""), F.lit("0")))
        number = F.when(leading > 10, F.lit(0x110000)).when(F.substring(r, 3, 1).isin("x", "X"), hexadecimal).otherwise(decimal)
        named = F.coalesce(F.try_element_at(_names(), F.substring(r, 2, 1 << 30)), r)
        return F.when(~r.startswith("&"), r).when(r.startswith("&#"), _code_point(number)).otherwise(named)

    parts = F.transform(F.regexp_extract_all(text, F.lit(_REFERENCE_RE), 0), one)
    return F.when(text.contains("&"), F.array_join(parts, "")).otherwise(text)


def _step(s: Column, token: Column) -> Column:
    def state(stack=None, open_=None, n=None, done=None) -> Column:
        return F.struct((s["stack"] if stack is None else stack).alias("stack"), (s["open"] if open_ is None else open_).alias("open"),
                        (s["n"] if n is None else n).alias("n"), (s["done"] if done is None else done).alias("done")).cast(_STATE)

    # --- text: to every open paragraph
    text = state(open_=F.transform(s["open"], lambda p: F.struct(p["at"].alias("at"), p["depth"].alias("depth"), F.concat(p["text"], decoded(token)).alias("text"))))
    # --- start tag
    name = F.lower(F.regexp_extract(token, r"^</?([^\s/>]++)", 1))
    stack = F.concat(s["stack"], F.array(name))
    begun = F.struct(s["n"].alias("at"), F.size(stack).alias("depth"), F.lit("").alias("text"))
    start = F.when(name == "p", state(stack, F.concat(s["open"], F.array(begun)), s["n"] + 1)).otherwise(state(stack))
    # --- end tag: everything from the innermost element of the name on
    kept = F.size(s["stack"]) - F.array_position(F.reverse(s["stack"]), name).cast("int")
    cut = F.when(kept > 0, F.slice(s["stack"], F.lit(1), F.greatest(kept, F.lit(1)))).otherwise(F.array().cast("array<string>"))
    end = state(cut, F.filter(s["open"], lambda p: p["depth"] <= kept), done=F.concat(s["done"], F.filter(s["open"], lambda p: p["depth"] > kept)))
    closes = token.startswith("</")
    is_tag = token.rlike("(?i)^</?[a-z]")
    opens_none = name.isin(VOID + RAW) | token.endswith("/>")
    return F.when(~is_tag, F.when((F.size(s["open"]) > 0) & ~(token.startswith("<!") | token.startswith("<?")), text).otherwise(s)) \
        .when(closes, F.when(F.array_contains(s["stack"], name), end).otherwise(s)) \
        .when(opens_none, s).otherwise(start)


def paragraphs(page) -> Column:
    """Array of the non-blank paragraph texts of a page (null: none)."""
    c = F.coalesce(F.col(page) if isinstance(page, str) else page, F.lit(""))
    nothing = F.from_json(F.lit('{"stack": [], "open": [], "n": 0, "done": []}'), _STATE)
    found = F.aggregate(F.regexp_extract_all(c, F.lit(TOKEN_RE), 0), nothing, _step,
                        lambda s: F.array_sort(F.concat(s["done"], s["open"])))
    return F.filter(F.transform(found, lambda p: p["text"]), lambda t: t.rlike(_NOT_BLANK_RE))


def paragraph_text(page) -> Column:
    """Newline-joined paragraph text, or the placeholder without any."""
    texts = paragraphs(page)
    return F.when(F.size(texts) > 0, F.array_join(texts, "\n")).otherwise(F.lit(NO_CONTENT))
