"""Layout-aware HTML text."""

import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from starloom.llm import html_text, queries
from starloom.llm.html_text import render

CASES = {
    "one <b>two</b>three": "one twothree",
    "<p>a<p>b": "a\n\nb",
    "<div>a</div><div>b</div>c": "a\nb\nc",
    "a<br>b<br><br>c": "a\nb\n\nc",
    "  a \n <i> b</i>  c": "a b c",
    "<ul><li>a<li>b</ul>": "  - a\n  - b",
    "<ol start=3><li>a<li>b<ul><li>c</ul><li>d</ol>e": "  3. a\n  4. b\n       - c\n  5. d\n\ne",
    "<pre>x\n  y\n</pre>z": "x\n  y\n\nz",
    "<table><tr><td>a<td>bb<tr><td>ccc<td>d</table>": "a    bb\nccc  d",
    "<table><tr><th colspan=2>head<tr><td>a<td>b<br>c</table>": "head\na  b\n   c",
    "<table><tbody><tr><td><table><tr><td>in<td>ner</table><td>out</table>": "in  ner  out",
    "<p hidden>a</p><p style='DISPLAY : none'>b</p><script>'<p>c'</script><style>d</style><!-- e -->f": "f",
    "<head><title>t</title></head><body>x</body>": "x",
    "<details>no<summary>yes</summary>no</details><dialog>no</dialog>": "yes",
    "&lt;p&gt; &amp; &eacute;&nbsp;x": "<p> & é\xa0x",
    "<dl><dt>t<dd>d<dt>u</dl>": "t\n  d\nu",
    "a<hr>b": "a\n\n---\n\nb",
    "<td>x</td></table></p>y": "x\n\ny",
    "<textarea>a <b> c</textarea>": "a <b> c",
    "<p title='>'>a</p><P>b</P >": "a\n\nb",
    "a<!-- never ends": "a",
    "a <b unclosed": "a",
    "1 < 2 <3": "1 < 2 <3",
    "<select><option>a<option>b</select>": "a\nb",
    "": "",
    " \n ": "",
    "<html><head><title>t</title><body><p>Hello": "Hello",
    "<head> <meta charset=x><style>s</style> <template>t</template><p>a</p></head>b": "a\n\nb",
    "<head><title>t</title>&#32; x<link><div>y</div>": "x\ny",
    "<head><head><noscript><link><body>x": "x",
    "<div>a<svg/>b</div>c": "ab\nc",
    "<p>a<svg d='x=1/'/>b<math/>c<svg><title/></svg>d": "abcd",
    "a<svg width=1/>b</svg>c<svg / >d</svg>e": "ace",
    "<head><svg/>a": "a",
    "<table><tr><td rowspan=2>A<td>B<tr><td>C</table>": "A  B\n   C",
    "<table><tr><td>a<td rowspan=3>b<td>c<tr><td>d<td>e<tr><td>f<td>g<tr><td>h<td>i<td>j</table>": "a  b  c\nd     e\nf     g\nh  i  j",
    "<table><tr><td colspan=2 rowspan=2>ab<td>c<tr><td>d<tr><td>e<td>f<td>g</table>": "ab    c\n      d\ne  f  g",
    "<table><tr><td rowspan=0>A<td>B<tr><td>C<tr><td>D</table>": "A  B\n   C\n   D",
    "<div style='visibility:hidden'>a<b style='visibility: visible'>b<i>c</i></b>d</div>e": "bc\ne",
    "<p style='visibility:hidden'>a<span style='visibility:hidden'>b</span></p>c": "c",
    "<ul style='visibility:hidden'><li>a<li style='visibility:visible'>b</ul>": "  - b",
    "<div style='display:none'><b style='visibility:visible;display:block'>a</b></div>b": "b",
    "<p style='content-visibility:hiddenx;color:red'>a</p>": "a",
    "<p style='x-display:none; font-family: \"display\"'>a</p>": "a",
    "<p style='display:block;DISPLAY : NONE !important'>a</p>b": "b",
    "<p style='/* display:none */ color:red'>a</p>": "a",
    "<p style='display:none;display:block'>a</p>": "a",
    "<p data-note='display:none hidden visibility:hidden'>a</p>": "a",
}


@pytest.mark.parametrize("source", CASES)
def test_cases(source):
    assert render(source) == CASES[source]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("<p> <div> </div> <table> <tr> <td> </td> </table> <ul> <li> </ul> <b> </b> <pre> </pre> <a x=' < > \" <!-- --> <details> </summary> <p hidden> x y".split(" ")), max_size=40))
def test_any_soup_ends_and_keeps_marked_text(parts):
    text = render("".join(parts))
    assert isinstance(text, str) and "\n\n\n\n" not in text.replace(" ", "") or "<pre>" in parts


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.text("abc ", max_size=6), min_size=1, max_size=4), min_size=1, max_size=5))
def test_cells_of_a_column_start_at_the_same_place(rows):
    marked = [[f"{r}_{c}{cell}" for c, cell in enumerate(row)] for r, row in enumerate(rows)]
    source = "<table>" + "".join("<tr>" + "".join(f"<td>{c}" for c in row) for row in marked) + "</table>"
    places = {}
    for line in render(source).split("\n"):
        for found in re.finditer(r"\d_(\d)", line):
            places.setdefault(found[1], set()).add(found.start())
    assert all(len(p) == 1 for p in places.values()) and len(places) == max(map(len, rows))


def test_deep_and_long_pages():
    assert render("<div>" * 30_000 + "x") == "x"
    assert len(render("<p>word " * 50_000).split()) == 50_000
    assert render('<a href="' * 5000) == ""


def test_query_and_columns(spark, odd_columns):
    folder = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = {r.page_id: r.text for r in queries.op10_html_text(spark, folder).collect()}
    assert got == {i: render(h) for i, h in pages.items()}
    df = odd_columns(spark.createDataFrame([(1, "<p>a"), (2, None), (1, "<p>a")], "page_id long, html string"))
    rows = df.select("page_id", html_text.visible_text(F.col("html")).alias("t")).collect()
    assert sorted(map(tuple, rows), key=repr) == [(1, "a"), (1, "a"), (2, None)]
    assert df.where("false").select(html_text.visible_text(F.col("html"))).count() == 0
