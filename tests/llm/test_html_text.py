"""HTML text: layout cases, all words against a plain parser, odd rows."""

import re
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from meterflow.llm.html_text import extracted, rendered
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("page, text", [
    ("", ""), ("a  b\n c", "a b c"), ("<p>a<p>b", "a\n\nb"), ("<div>a</div><div>b</div>c", "a\nb\nc"),
    ("a<br>b<br><br>c", "a\nb\n\nc"), ("x<b>y</b> <i>z</i>", "xy z"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e", "- a\n- b\n  - c\n- d\n\ne"),
    ("<ol start=3><li>a</li><li>b</li></ol>", "3. a\n4. b"),
    ("<ul><li><p>a</p><p>b</p></ul>", "- a\n\n  b"),
    ("<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>", "a    bb\nccc  d"),
    ("<table><caption>T</caption><tr><th>a</th><th>b</th></tr><tr><td colspan=2>wide</td></tr></table>", "T\na  b\nwide"),
    ("<table><tr><td>a<br>b<td>c<table><tr><td>x<td>y</table></table>z", "a  c\nb\n   x  y\n\nz"),
    ("<table><tr><td>a<p>b</table>", "a\n\nb".replace("\n\n", "\n")),
    ("<head><title>t</title></head><body>b", "b"), ("<script>if (a<b) '</p>'</script>x<style>p{}</style>", "x"),
    ("<div hidden>a<p>b</div>c<span style='display: none'>d</span>", "c"),
    ("<div style='visibility:hidden'>a<b style='visibility:visible'>b</b></div>", "b"),
    ("<pre>a  b\n  c</pre>d", "a  b\n  c\n\nd"), ("&lt;p&gt; &amp;&nbsp;x &#233;", "<p> &\xa0x é"),
    ("a < b and <c", "a < b and <c"), ("<!-- <p>no --> yes", "yes"), ("a<a title='>'>b</a>", "ab"), ("<!doctype html>x", "x"),
    ("</p>a</div></li></td>b", "ab"), ("<dl><dt>t<dd>d<dt>u</dl>", "t\nd\nu"), ("<select><option>a<option>b</select>", "a\nb"),
    ("<td>a</td><li>b", "a\n- b"), ("<p hidden>a</p>b", "b"), ("<textarea>a\n <b></textarea>", "a\n <b>"), ("<a b=\"c>d", "d"),
])
def test_layout(page, text):
    assert rendered(page) == text


class Words(HTMLParser):
    """Every word outside of script and style, without layout."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.off, self.words = 0, []

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("script", "style", "title", "head")

    def handle_endtag(self, tag):
        self.off -= tag in ("script", "style", "title", "head")

    def handle_data(self, data):
        if not self.off:
            self.words += re.findall(r"\w+", data)


TAGS = ["p", "div", "ul", "ol", "li", "table", "tr", "td", "b", "i", "span", "h2", "blockquote", "dl", "dd", "section", "a"]


@given(st.lists(st.one_of(st.sampled_from([f"<{t}>" for t in TAGS] + [f"</{t}>" for t in TAGS] + ["<br>", "<hr>", " "]),
                          st.integers(0, 999).map(lambda k: f"w{k} ")), max_size=40))
@settings(max_examples=500, deadline=None)
def test_no_word_is_lost(parts):
    """Whatever the nesting; the order may differ where text stands between a table's rows."""
    page = "".join(parts)
    plain = Words()
    plain.feed(page)
    got = [w for w in re.findall(r"\w+", rendered(page)) if w.startswith("w")]
    assert sorted(got) == sorted(w for w in plain.words if w.startswith("w"))


@pytest.mark.parametrize("page, text", [
    ("<a href=foo title=Bob's>visible text</a> <p>it's here</p>end", "visible text\n\nit's here\n\nend"),
    ("<a b' c>x</a> y's", "x y's"), ("<a href=a=\"b>x</a> \"y\"", "x \"y\""), ("<a b = '>' c=\">\">x", "x"),
    ("<b title=it's hidden>x</b>y", "y"), ("<br/>a<a href=/b/>c", "ac"),
])
def test_stray_quotes_open_no_value(page, text):
    assert rendered(page) == text


def test_deep_and_long_pages():
    assert rendered("<div>" * 50_000 + "x") == "x"
    assert rendered("<b>" * 20_000 + "x" + "</b>" * 20_000) == "x"
    assert rendered("<p>word</p>" * 20_000).count("word") == 20_000
    assert rendered("<a <a " * 20_000).startswith("<a <a")


def test_odd_rows(spark):
    pages = spark.createDataFrame([(1, None, "t"), (None, "<p>a", "t"), (2, "", "t"), (3, "<b>x", "t"), (3, "<b>x", "t")], "page_id long, html string, text string")
    assert sorted(map(tuple, extracted(pages).collect()), key=str) == sorted([(1, None), (None, "a"), (2, ""), (3, "x"), (3, "x")], key=str)
    assert extracted(pages.limit(0)).collect() == []


def test_query_on_pages(spark):
    from meterflow.llm.queries import QUERIES
    source = {r.page_id: r.html for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    got = QUERIES["op9_html_text"](spark, SF_SMALL).collect()
    assert sorted(r.page_id for r in got) == sorted(source)
    for r in got:
        plain = Words()
        plain.feed(source[r.page_id])
        assert re.findall(r"\w+", r.text) == plain.words
