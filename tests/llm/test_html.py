"""Op 4: layout of small pages, written out by hand."""

import time

import pytest

from panelspark.llm import op4_html as op


@pytest.mark.parametrize("html,text", [
    ("<p>a<p>b", "a\n\nb"), ("<div>a</div><div>b</div>", "a\nb"), ("a<br>b", "a\nb"), ("  a \n b  <i> c</i>d", "a b cd"),
    ("<ul><li>x<li>y<ul><li>z</ul></ul>t", "- x\n- y\n  - z\n\nt"), ("<ol start=3><li>x<li value=9>y<li>z</ol>", "3. x\n9. y\n10. z"),
    ("<table><tr><td>a<td>bbb<tr><td>cccc<td>d</table>", "a     bbb\ncccc  d"), ("<table><tr><th colspan=2>head<tr><td>1</td><td>2</td></table>", "head\n1  2"),
    ("<table><tr><td>a<br>b<td>c</table>", "a  c\nb"), ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a  b\n   c"),
    ("<table><caption>t</caption><tr><td>日本<td>x<tr><td>abc<td>y</table>", "t\n日本  x\nabc   y"), ("<table><td>x</table>", "x"),
    ("<table><tr><td>x<table><tr><td>in</table></td><td>y</table>", "x   y\n\nin"),
    ("<head><title>t</title><style>x</style></head><body>q<script>var a='</p>';</script>r", "qr"), ("<title>t</title>seen", "seen"),
    ("<p>a <b>b</p> c</b> d", "a b\n\nc d"), ("<p hidden>x</p>y<span style='color:red; display : none'>z</span>", "y"),
    ("<div style='visibility:hidden'>x</div>y", "y"), ("<pre>\n a\n  b</pre>", " a\n  b"), ("a&amp;b &copy; &lt;x&gt;", "a&b © <x>"),
    ("<!-- c --><p>x<!-- <p>y -->z", "xz"), ("<details><summary>s</summary>hid</details>v", "s\nv"), ("<details open><summary>s</summary>vis</details>", "s\nvis"),
    ("<dl><dt>t<dd>d<dt>u</dl>", "t\n  d\nu"), ("<select><option>a</select>b", "b"), ("<h1>A</h1>b", "A\n\nb"), ("<blockquote>q</blockquote>r", "  q\n\nr"),
    ("", ""), ("<td>x</td>y", "x\ny"), ("</div></p>z", "z"), ("<p>unclosed <b", "unclosed <b"), ("a < b > c", "a < b > c"), ("<a title='x>y'>t</a>", "t"), ("a<noscript>n</noscript>b", "ab")])
def test_layout(html, text):
    assert op.render(html) == text


@pytest.mark.parametrize("html,text", [
    ("<table><tr><td colspan=4>Menu</td></tr></table>", "Menu"), ("<table><tr><td>a</td><tr><td>b<td colspan=3>cd</table>", "a\nb  cd"),
    ("<table><tr><td colspan=4>Menu</td><td>x</table>", "Menu  x"), ("<table><tr><td>abcd<tr><td colspan=2>abcdef<td>y</table>", "abcd\nabcdef   y"),
    ("<table><tr><td colspan=3><td colspan=2></table>z", "z"), ("<table><tr><td colspan=1000>a<td colspan=1000>b</table>", "a  b")])
def test_short_spanning_cells(html, text):
    assert op.render(html) == text


@pytest.mark.parametrize("html,text", [
    ("<p>If <math><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>2</mn></mfrac></math> then", "If x= 1 2 then"),
    ("<math><semantics><mi>y</mi><annotation encoding='application/x-tex'>\\y</annotation></semantics></math>z", "yz"),
    ("<svg><title>t</title><desc>d</desc><defs><text>n</text></defs><g>stray<text x=1>Jan<tspan>uary</tspan></text><rect/><text>May</text></g></svg>end", "January May end"),
    ("<svg><title/><path d='M0'/></svg>after", "after"), ("<svg><foreignObject><div>in</div></foreignObject></svg>", "in"), ("<svg><path d='x'><p>out", "out"),
    ("<svg/>a<math/>b", "ab"), ("<textarea>\na &amp; <b>\n  c</textarea>d", "a & <b>\n  cd"), ("<textarea></textarea>d", "d"), ("<canvas>f</canvas><object>f</object>g", "g"),
    ("<div hidden><svg><text>x</text></svg><textarea>y</textarea></div>z", "z"), ("<map><p>m</p></map>n", "m\n\nn")])
def test_formulas_labels_and_fields(html, text):
    assert op.render(html) == text


@pytest.mark.parametrize("html,text", [
    ('<div style="visibility:hidden">x<span style="visibility:visible">y</span></div>', "y"), ("<p style='visibility:collapse'>a<b style='visibility: visible !important'>b</b>c</p>d", "b\n\nd"),
    ("<div style='display:none'>x<span style='visibility:visible'>y</span></div>z", "z"), ("<div style='display:/**/none'>x</div>y", "y"), ("<div style='/* display:none */'>x</div>y", "x\ny"),
    ("<div style='white-space:pre'>a\n  b</div>", "a\n  b"), ("<pre style='white-space:normal'>a\n  b</pre>", "a b"), ("<div style='white-space: pre-line'>a\n  b</div>", "a b"),
    ("<ol reversed start=3><li>x<li>y<li>z</ol>", "3. x\n2. y\n1. z"), ("<ul><li style='visibility:hidden'>x<li>y</ul>", "- y"),
    ("<table><tr><td style='visibility:hidden'>abc<td>d<tr><td>x<td>y</table>", "   d\nx  y")])
def test_inherited_styles(html, text):
    assert op.render(html).rstrip() == text


def test_nesting_and_junk_take_linear_time():
    began = time.time()
    assert op.render("<div>" * 100_000 + "x") == "x"
    assert op.render("<table><tr><td>" * 3000 + "x") == "x"
    for junk in ("<", "<a ", "<!--", '<a "', "</p", "<p>", "&", "<li>"):
        op.render(junk * 50_000)
    assert time.time() - began < 60


def test_rows(spark):
    rows = [(1, "u", "<p>a"), (1, "u", "<p>a"), (2, None, None), (None, "u", ""), (4, "u", "<li>" + "word " * 200_000)]
    df = spark.createDataFrame([(*r, "mine", "kept") for r in rows], "page_id long, url string, html string, Visible_Text string, __row string")
    out = op.extract(df)
    assert out.columns == ["page_id", "url", "html", "__row", "visible_text"]
    assert sorted((r.page_id or 0, r.visible_text[:4]) for r in out.collect()) == [(0, ""), (1, "a"), (1, "a"), (2, ""), (4, "- wo")]
    assert op.extract(df.limit(0)).count() == 0


def test_query_returns_every_page(spark):
    from panelspark.llm.queries import QUERIES, table
    d = "/root/testdata/sf0.001"
    got = {r.page_id: r.visible_text for r in QUERIES["op4_html_layout"](spark, d).collect()}
    rows = table(spark, d, "pages").collect()
    assert got == {r.page_id: op.render(r.html or "") for r in rows}
    assert all("track(" not in t and "margin:0" not in t for t in got.values())
