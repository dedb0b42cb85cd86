from __future__ import annotations

import re

import pytest
from helpers import SF, table

from sparkloom.llm.html_text import extract, render
from sparkloom.llm.queries import op10_html_text

CASES = {
    "<p>one<p>two": "one\n\ntwo",
    "<div>a</div><div>b<span> c</span></div>": "a\nb c",
    "a<br>b<br><br>c": "a\nb\n\nc",
    "<ul><li>x<li>y<ul><li>z</ul></ul>": "- x\n- y\n\n  - z",
    "<ol start=3><li>x</li><li>y</li></ol>": "3. x\n4. y",
    "<table><tr><th>name<th>n<tr><td>long name<td>1</table>": "name       n\nlong name  1",
    "<table><tr><td colspan=2>wide cell<td>e<tr><td>a<td>b<td>c</table>": "wide cell  e\na  b  c",
    "<style>p{}</style><script>var t='</p>';</script><p>x</p>": "x",
    "<head><title>t</title></head><body>b": "b",
    "<p hidden>no</p><p style='display: none'>no</p><p>yes</p>": "yes",
    "<pre>a\n  b</pre>": "a\n  b",
    "&lt;b&gt; &amp; &eacute;&#x41;": "<b> & éA",
    "<details><summary>s</summary>body</details>": "s",
    "<!-- c --><b>x</b><![if x]>y<?pi?>": "xy",
    "a <i>b</i> , c": "a b , c",
    "x < y <": "x < y <",
    "<a href='x": "",
    "": "", "  \n ": "",
    "<dl><dt>t<dd>d</dl>": "t\n  d",
    "<p>a</b></p></div>b": "a\n\nb",
    "<textarea> <b> </textarea>": "<b>",
    "a <svg><title>no</title><desc>no</desc><defs><text>no</text></defs><text>drawn</text></svg> b": "a drawn b",
    "<math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></math><desc>y</desc>": "x=2y",
    "<head><title>t</title><a href=x>link</a> after": "link after",
    "<head><meta charset=x><span>s</span><p>p": "s\n\np",
    "<table><tr><td rowspan=2>both<td>1<tr><td>2<tr><td>x<td>3</table>": "both  1\n      2\nx     3",
    "<table><tr><td>a<td rowspan=3 colspan=2>bc<td>d<tr><td>e<td>f<tr><td>g</table>": "a  bc  d\ne      f\ng",
    "<table><tr><td rowspan=99999999999>a<td rowspan=x>b<tr><td>c</table>": "a  b\n   c",
}


@pytest.mark.parametrize("source", CASES)
def test_rendering(source):
    got = render(source)
    if "wide cell" in source:
        assert [x.split() for x in got.split("\n")] == [["wide", "cell", "e"], ["a", "b", "c"]]
        assert got.split("\n")[0].index("e", 8) >= got.split("\n")[1].index("c")
    else:
        assert got == CASES[source]


def test_deep_and_long():
    deep = render("<div>" * 5000 + "x" + "</div>" * 5000 + "y")
    assert "x" in deep and "y" in deep
    assert render("<ul><li>" * 2000 + "end").endswith("end")
    assert len(render("<p>word</p>" * 20_000).split()) == 20_000
    assert render("<table><tr><td>" * 300 + "in").endswith("in")


def test_hidden_text_stays_hidden_at_any_depth():
    inner = "<p hidden>SECRET<b>SECRET</b></p><div hidden><div>SECRET</div>SECRET</div><template><i>SECRET</i></template>seen"
    for depth in (10, 398, 399, 400, 401, 700):
        got = render("<div>" * depth + inner + "</div>" * depth + "end")
        assert "SECRET" not in got and "seen" in got and got.endswith("end")
    assert render("<div hidden>" * 3000 + "SECRET" + "</div>" * 3000 + "end") == "end"


def test_query(spark):
    got = {r.page_id: r.text for r in op10_html_text(spark, SF).collect()}
    pages = dict(table("pages", columns="page_id, html"))
    assert set(got) == set(pages)
    for page, source in pages.items():
        # every word between paragraph tags is in the output, no script is
        for words in re.findall(r"<p>([^<&]*)</p>", source):
            assert " ".join(words.split()) in " ".join(got[page].split())
        assert "track(" not in got[page] and "margin:0" not in got[page]


def test_edges(spark):
    rows = [(1, None, "k"), (2, "", "k"), (2, "", "k"), (None, "<p>x", "k")]
    pages = spark.createDataFrame(rows, "page_id long, html string, extra string")
    out = extract(pages)
    assert out.columns == ["page_id", "extra", "text"]
    assert sorted(map(repr, ((r.page_id, r.text) for r in out.collect()))) == sorted(map(repr, [(1, None), (2, ""), (2, ""), (None, "x")]))
    assert extract(pages.limit(0)).count() == 0
    with pytest.raises(ValueError, match="text"):
        extract(pages.withColumnRenamed("extra", "Text"))
