"""Paragraphs by the tag-stream machine, against a scanner of the same rules that
goes character by character, and against the standard library's parser."""

import html
import html.entities
import random
import re
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from signalyard.functions import tagstream as TS


def scan(page):
    """Tokens by hand: (kind, name or text)."""
    i, n = 0, len(page)
    while i < n:
        if page.startswith("<!--", i):
            j = page.find("-->", i + 4)
            i = n if j < 0 else j + 3
            continue
        if page.startswith(("<!", "<?"), i):
            j = page.find(">", i + 2)
            i = n if j < 0 else j + 1
            continue
        m = re.compile(r"</?[A-Za-z][^\s/>]*").match(page, i)
        if m:
            j, quote = m.end(), None
            while j < n and (quote or page[j] != ">"):
                if quote:
                    if page[j] == quote:
                        quote = None
                elif page[j] in "\"'" and page.find(page[j], j + 1) >= 0:
                    quote = page[j]
                j += 1
            if j < n:
                name = m[0].lstrip("</").lower()
                close, empty = m[0].startswith("</"), page[j - 1] == "/"
                i = j + 1
                if not close and name in ("script", "style"):
                    e = re.compile(f"</{name}(?=[\\s/>])[^>]*>", re.I).search(page, i)
                    i = e.end() if e else n
                    continue
                yield ("end" if close else "void" if empty else "start"), name
                continue
        j = page.find("<", i + 1)
        j = n if j < 0 else j
        yield "text", page[i:j]
        i = j


def reference(m):
    body = m[0][1:]
    if body.startswith("#"):
        digits = body.rstrip(";")[1:]
        n = int(digits[1:], 16) if digits[0] in "xX" else int(digits)
        if 0x80 <= n <= 0x9f:
            return bytes([n]).decode("cp1252", "replace")
        return "�" if n == 0 or n > 0x10ffff or 0xd800 <= n <= 0xdfff else chr(n)
    return html.entities.html5.get(body, m[0])


def expected(page):
    stack, paras = [], []  # open: index into paras or None
    for kind, x in scan(page or ""):
        if kind == "text":
            t = re.sub(r"&(?:#[xX][0-9a-fA-F]+|#[0-9]+|[A-Za-z][A-Za-z0-9]*);?", reference, x)
            for _, k in stack:
                if k is not None:
                    paras[k] += t
        elif kind == "start" and x not in TS.VOID + TS.RAW:
            if x == "p":
                paras.append("")
            stack.append((x, len(paras) - 1 if x == "p" else None))
        elif kind == "end" and any(name == x for name, _ in stack):
            while stack.pop()[0] != x:
                pass
    return [p for p in paras if p.strip()]


def got(spark, pages):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i long, page string").select("i", TS.paragraphs("page").alias("t"))
    return [r.t for r in df.orderBy("i").collect()]


PAGES = [
    None, "", "no tags", "<p>one</p>", "<P class=x>One</P><p>two", "<p>a<p>b</p>c</p>d", "<div><p>open<div>in</div></div>out<p>next</p>",
    "<p>a</div>b</p>c", "<ul><li><p>x<li><p>y</ul><p>z", "<p>a<br>b<img src='>'>c<br/>d<hr>e</p>", "<p/>no<p>yes</p>",
    "<p>a<!-- <p>no</p> -->b</p><!-- unclosed <p>gone</p>", "<p>a<script>if (a</p>) '<p>'</script>b</p>", "<p>s<style>p{}</STYLE >t</p>",
    "<script>never closed <p>x</p>", "<scripty><p>x</p></scripty>", "<p title=\"a>b\" data='</p>'>q</p>", "<p title=\"unclosed>text</p>",
    "<p>1 < 2 && 3 > 2 <3 </ p> <>x</p>", "<p>&amp;lt; &lt;b&gt; &#65;&#x42;&#X43; &eacute;&eacute &nosuch; &nbsp;|&copy &#150;&#0;&#xD800;&#x110000;&#99999999999999999999; &#xfffffffffffffff41;&</p>",
    "<p>&nbsp;</p><p> \t\n </p><p> x</p>", "<!DOCTYPE html><?xml x?><html><body><p>\U0001f600 &#128512;</p></body></html><p>after</p>",
    "<p>unclosed tag <b", "<p", "<", "&", "<p>&", "<p><b>bold <i>both</b> still</i> end</p>", "<pre><p>in pre</pre>out</p>", "<p\n>nl</p\n>x", "<p>" * 40 + "deep",
]


def test_pages_by_hand(spark):
    assert got(spark, PAGES) == [expected(p) for p in PAGES]


def test_random_pages(spark):
    rng = random.Random(11)
    bits = ["<p>", "</p>", "<P >", "<p a='>'>", "<div>", "</div>", "<b>", "</b>", "<br>", "<br/>", "<!-- x -->", "<!--", "-->", "<script>", "</script>", "<style>",
            "</style>", "text", " ", "&amp;", "&#x41;", "&lt", "<", ">", "\"", "'", "</", "<!x>", "<li>", "</ul>", "<ul>", "é\n", "&bogus;", "<p/>", "/"]
    pages = ["".join(rng.choice(bits) for _ in range(rng.randrange(40))) for _ in range(1500)]
    for page, a, b in zip(pages, got(spark, pages), [expected(p) for p in pages]):
        assert a == b, page


class Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack, self.paras = [], []

    def handle_starttag(self, tag, attrs):
        if tag not in TS.VOID:
            if tag == "p":
                self.paras.append("")
            self.stack.append((tag, len(self.paras) - 1 if tag == "p" else None))

    def handle_startendtag(self, tag, attrs):
        pass

    def handle_endtag(self, tag):
        if any(t == tag for t, _ in self.stack):
            while self.stack.pop()[0] != tag:
                pass

    def handle_data(self, data):
        if not any(t in TS.RAW for t, _ in self.stack):
            for _, k in self.stack:
                if k is not None:
                    self.paras[k] += data


def test_the_standard_parser_agrees_on_nested_and_unclosed_elements(spark):
    rng = random.Random(5)
    bits = ["<p>", "</p>", "<div>", "</div>", "<b>", "</b>", "<br>", "<br/>", "<!-- <p> -->", "<script>a<p>b</script>", "text ", "&amp;", "&#x41;", "&eacute;", "<ul><li>", "</ul>"]
    pages = ["".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(400)]
    for page, a in zip(pages, got(spark, pages)):
        r = Reader()
        r.feed(page)
        r.close()
        assert a == [p for p in r.paras if p.strip()], page


def test_a_page_of_many_paragraphs_and_a_long_one(spark):
    many = "".join(f"<p>paragraph {i}" + ("</p>" if i % 3 else "</p><div>") for i in range(3000))
    long_ = "<p>" + "word &amp; " * 50_000 + "</p>"
    a, b = got(spark, [many, long_])
    assert a == [f"paragraph {i}" for i in range(3000)] and b == ["word & " * 50_000]
    df = spark.createDataFrame([(None,), ("<p> </p>",), ("<p>a</p><p>b",)], "page string")
    assert [r[0] for r in df.select(TS.paragraph_text(F.col("page"))).collect()] == ["No content found", "No content found", "a\nb"]
