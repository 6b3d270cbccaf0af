"""HTML rendering: markup cases, and the visible words of the test pages against the standard parser."""

import re
import tracemalloc
from html.parser import HTMLParser

import duckdb
import pytest

from statloom.llm.html_text import extract
from statloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"

CASES = {
    "table cells are aligned": ("<table><tr><th>Name<th>Qty<tr><td>apple pie<td>3<tr><td>x<td>12</table>after", "Name       Qty\napple pie  3\nx          12\n\nafter"),
    "spans": ("<table><tr><td rowspan=2>A<td>B<tr><td>C</table>", "A  B\n   C"),
    "nested lists": ("<ul><li>a<li>b<ul><li>c<li>d</ul><li>e</ul>", "- a\n- b\n  - c\n  - d\n- e"),
    "numbers": ("<ol start=3><li>x<li value=9>y<li>z</ol>", "3. x\n9. y\n10. z"),
    "implied ends": ("<p>a<p>b<div>c</div>d<br><br>e", "a\n\nb\n\nc\nd\n\ne"),
    "pre": ("<pre> x\n   y\n\n z</pre>k", " x\n   y\n\n z\n\nk"),
    "hidden": ("a<script>x<b></script>b<p hidden>no<p style='display:none'>n<p>yes &amp; &lt;", "ab\n\nyes & <"),
    "in front of the table": ("<table>foo<tr><td>A</table>", "foo\n\nA"),
    "not a tag": ("x < y <3 <", "x < y <3 <"),
    "cut off": ("<p>text <a href='x", "text"),
    "details": ("<details><summary>S</summary>hid</details><details open><summary>T</summary>vis</details>", "S\nT\nvis"),
    "definitions": ("<dl><dt>t<dd>d<dt>u<dd>e</dl>", "t\n  d\nu\n  e"),
    "head": ("<title>no</title><style>p{}</style>yes", "yes"),
    "stray ends": ("</div>a</b></p>b", "a\n\nb"),
}


@pytest.mark.parametrize("name", CASES)
def test_markup(name):
    page, want = CASES[name]
    assert extract(page) == want


def test_deep_nesting():
    assert extract("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"


class Visible(HTMLParser):
    def __init__(self):
        super().__init__()
        self.out, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("head", "script", "style")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("head", "script", "style") and self.hidden > 0

    def handle_data(self, data):
        if not self.hidden:
            self.out.append(data)


def test_pages_show_all_visible_text(spark):
    got = {r.page_id: r.text for r in QUERIES["op3_html_extraction"][0](spark, SF).collect()}
    for page, html in duckdb.sql(f"SELECT page_id, html FROM '{SF}/pages.parquet'").fetchall():
        parser = Visible()
        parser.feed(html)
        parser.close()
        assert re.sub(r"\s+", "", re.sub(r"(?m)^\s*- ", "", got[page])) == re.sub(r"\s+", "", "".join(parser.out))


def test_memory_of_a_long_page():
    """A text of some MB in one run: the tokeniser keeps nothing per character."""
    tracemalloc.start()
    text = extract("<p title='" + "a " * (1 << 20) + "'>" + "some text < here " * (1 << 18))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(text) == len("some text < here ") * (1 << 18) - 1
    assert peak < 100e6  # the page has 7 million characters
