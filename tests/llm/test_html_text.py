"""Pages whose layout was worked out by hand."""

from __future__ import annotations

import time

import pytest

from wavebook.llm.html_text import extract_text, visible_text
from wavebook.llm.queries import op5_layout_text

CASES = {
    "blocks": ("<p>one<p>two <b>bold</b>\n text</p>tail", "one\n\ntwo bold text\n\ntail"),
    "lines": ("<div>a<div>b</div>c</div><div>d</div>", "a\nb\nc\nd"),
    "break": ("a<br>b<br><br>c", "a\nb\n\nc"),
    "space": ("<span> a </span><span>b</span> <i>c</i>\n\n d", "a b c d"),
    "list": ("<ul><li>a<li>b<ol start=4><li>x<li>y</ol><li>c</ul>", "- a\n- b\n  4. x\n  5. y\n- c"),
    "table": (
        "<table><tr><th>name<th>n<tr><td>apples<td>3<tr><td>fig<td>12</table>",
        "name    n\napples  3\nfig     12",
    ),
    "caption": ("x<table><caption>cap</caption><tr><td>1</table>y", "x\n\ncap\n\n1\n\ny"),
    "span": ("<table><tr><td colspan=2>a long title here<tr><td>a<td>b</table>", "a long title here\na  b"),
    "nested table": ("<table><tr><td><table><tr><td>i<td>j</table><td>k</table>", "i  j  k"),
    "hidden": (
        "<title>t</title><p hidden>a</p><p style='color:red;display : none'>b</p>"
        "<div style=visibility:hidden>c</div><script>x<p></script><style>s</style><template>u</template>"
        "<noscript>v</noscript><input type=hidden value=q><dialog>w</dialog><p>seen",
        "seen",
    ),
    "all visible": ("<nav>menu</nav><aside>ad</aside><footer>&copy; f</footer>", "menu\nad\n© f"),
    "entities": ("&lt;b&gt; &amp; &#233;&nbsp;x &bogus; a &lt b", "<b> & é\xa0x &bogus; a < b"),
    "pre": ("<pre> a\n  b</pre>c", " a\n  b\n\nc"),
    "alt and buttons": ("<img alt='a cat'><input type=submit value=Go><button>Push</button>", "a catGoPush"),
    "implied": ("<dl><dt>t<dd>d<dt>u</dl><select><option>o<option>p</select>", "t\nd\nu\n\no\np"),
    "broken": ("a < b <c d='>' e>f</q></p><!-- x --><!-- y", "a < b f"),
    "head text": ("<head><meta charset=x><title>t</title>text", "text"),
    "empty": ("", ""),
    "nothing shown": ("<!doctype html><html><head></head><body> \n </body></html>", ""),
}


DRAWN = {
    "formula": (
        "so <math><semantics><mrow><mi>x</mi><mo>=</mo><mfrac><mn>1</mn><mn>22</mn></mfrac></mrow>"
        "<annotation encoding=tex>x=\\frac</annotation><annotation-xml><mi>q</mi></annotation-xml></semantics>"
        "<mphantom><mi>z</mi></mphantom></math> holds",
        "so x= 1 22 holds",
    ),
    "drawing": (
        "a<svg viewBox='0 0 1 1'><title>t</title><desc>d</desc><defs><text>u</text></defs><defs/><style/>"
        "<metadata>m</metadata>stray<g><path d=m/0 /><text x=1>Tall <tspan>tower</tspan></text>"
        "<text><![CDATA[R&D]]></text><text display=none>n</text><text visibility='hidden'>n</text></g></svg>b",
        "a Tall tower R&D b",
    ),
    "page in a drawing": ("<svg><foreignObject><p>one<p>two</foreignObject></svg>three", "one\n\ntwo\n\nthree"),
    "left open": ("<svg><g><text>one</text><defs><div>two</div>", "one\ntwo"),
    "bare value": ("<svg><a href=x/><text>in</text></a></svg>out", "in out"),
    "hidden drawing": ("<svg style='display:none'><text>x</text></svg><math hidden><mi>y</mi></math>z", "z"),
    "inputs": (
        "Name<input value=Ann>Town<input type=text value='New York'><input type=Search placeholder=find>"
        "<input type=password value=p><input type=checkbox value=c><input type=radio value=r><input>end",
        "Name Ann Town New York find end",
    ),
}


@pytest.mark.parametrize("name", DRAWN)
def test_drawings_formulas_and_inputs(name):
    page, text = DRAWN[name]
    assert visible_text(page) == text


def test_deep_drawings():
    started = time.time()
    for page in ("<svg><defs>" + "<g>" * 30_000 + "<div>x", "<svg>" * 30_000 + "<text>x", "<svg>" + "<path d='m'/>" * 30_000 + "<text>x"):
        assert visible_text(page) in ("x", "")
    assert time.time() - started < 20


@pytest.mark.parametrize("name", CASES)
def test_layout(name):
    page, text = CASES[name]
    assert visible_text(page) == text


def test_long_and_deep_pages():
    started = time.time()
    for page in ("<div>" * 30_000 + "x", "<b>" * 30_000 + "x", "<" * 100_000, "<table><tr><td>" * 2_000 + "x"):
        assert visible_text(page).strip().endswith(("x", "<"))
    words = "word " * 200_000
    assert visible_text(f"<p>{words}") == words.strip()
    assert time.time() - started < 60


def test_query(spark, tmp_path):
    rows = [(n, "u", page, "t") for n, (page, _) in enumerate(CASES.values())]
    rows += [(None, None, None, None), (0, "u", "<p>other", "t"), (0, "u", "<p>other", "t")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(2)
    frame.write.parquet(f"{tmp_path}/pages.parquet")
    got = [tuple(r) for r in op5_layout_text(spark, str(tmp_path)).collect()]
    wanted = [(n, text) for n, (_, text) in enumerate(CASES.values())] + [(None, None)] + [(0, "other")] * 2
    assert sorted(got, key=str) == sorted(wanted, key=str)
    assert extract_text(frame).columns == ["page_id", "url", "html", "text"]
    assert extract_text(frame.limit(0)).count() == 0
