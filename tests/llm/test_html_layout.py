from __future__ import annotations

import re
from html.parser import HTMLParser

import pytest

from martline.llm.html_layout import extract, visible_text


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("  \n ", ""), ("plain text", "plain text"),
    ("<p>a<p>b <b>c</p>d", "a\n\nb c\n\nd"),
    ("<ul><li>x<li>y<ol start=3><li>z<li>w</ol><li>q</ul>e", "- x\n- y\n  3. z\n  4. w\n- q\n\ne"),
    ("<ul><li></li><li>a</li></ul>", "- a"), ("<ol><li>a<li value=9>b<li>c</ol>", "1. a\n9. b\n10. c"),
    ("<table><tr><td>a<td>bbb<tr><td>cccc<td>d</table>after", "a     bbb\ncccc  d\n\nafter"),
    ("<table><tr><th colspan=2>Head wide<tbody><tr><td rowspan=2>r<td>1<tr><td>2</table>", "Head wide\nr  1\n   2"),
    ("<table><tr><td>a<br>b<td>c</table>", "a  c\nb"), ("<table><td>x<td>y</table>", "x  y"), ("<td>loose</td> text", "loose text"),
    ("<table><tr><td>c<table><tr><td>in</table><td>d</table>", "c   d\n\nin"),
    ("a<br>b<br><br>c", "a\nb\n\nc"), ("<pre>x\n  y\n\nz</pre>q", "x\n  y\n\nz\n\nq"), ("<h1>T</h1>text<hr>more", "T\n\ntext\n\nmore"),
    ("<div>a<div hidden>no</div><span style='display: none'>no</span> b</div>c", "a b\nc"),
    ("<head><title>t</title><style>s{}</style></head><body>x<template>no</template>", "x"),
    ("<script>var a='</p>'</script>ok<!-- c", "ok"), ("x < y & z &lt; <b", "x < y & z <"), ("ok <scr", "ok"),
    ('<a href="x>y">l</a>', "l"), ("<p>a</table>b</i>", "ab"), ("a <b> b</b> c<b>d</b>", "a b cd"), ("<dl><dt>t<dd>d<dt>u</dl>", "t\n  d\nu"),
    ("<select><option>1<option>2</select>", "1\n2"), ("a&nbsp;&nbsp;b &copy;", "a\xa0\xa0b ©"), ("<img alt=pic> <input value=v><input type=hidden value=no>", "pic v"),
    ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"),
])
def test_layout(page, text):
    assert visible_text(page) == text


@pytest.mark.parametrize("page", ["<b>" * 100_000 + "x", "<div><ul><li>" * 5_000 + "x", "<table><tr><td>" * 2_000 + "x", "<ul>" + "<li>x" * 20_000, "<a '" * 9_000 + ">x", "<b>" * 9_000 + "<div>" * 9_000 + "x"])
def test_deep_and_long_pages(page):
    assert "x" in visible_text(page)


class Plain(HTMLParser):
    def __init__(self):
        super().__init__()
        self.out, self.off = [], 0

    def handle_starttag(self, tag, attrs):
        self.off += tag in ("script", "style", "title")

    def handle_endtag(self, tag):
        self.off -= tag in ("script", "style", "title")

    def handle_data(self, data):
        self.out += [] if self.off else [data]


def test_all_visible_characters_of_the_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = extract(pages.withColumn("extra", pages.url)).select("html", "text", "extra").collect()
    for r in got:
        plain = Plain()
        plain.feed(r["html"])
        plain.close()
        marks = re.sub(r"(?m)^ *(- |\d+\. )", "", r["text"])
        assert "".join("".join(plain.out).split()) == "".join(marks.split())


def test_frame(spark):
    pages = spark.createDataFrame([(1, "<p>a", "old"), (1, "<p>a", "old"), (None, None, None)], "page_id long, html string, text string")
    done = extract(pages)
    assert done.columns == ["page_id", "html", "text"] and sorted(r["text"] for r in done.collect()) == ["", "a", "a"]
    assert extract(pages.limit(0)).collect() == []


@pytest.mark.parametrize(("page", "text"), [
    ("".join(f"<input type={k} value={k}1>" for k in ("number", "tel", "URL", "date", "time", "month", "other")), "number1tel1URL1date1time1month1other1"),
    ("a".join(f"<input type={k} value=no>" for k in ("hidden", "HIDDEN", "password", "checkbox", "radio", "file", "image", "color", "range")), "aaaaaaaa"),
    ("a<svg><title>no</title><defs><text>no</text></defs><style/>" + "<path d='M0'/>" * 600 + "<g><text x=1>b <tspan>c</tspan></text></g>no<text display=none>no</text><text>d</text></svg>e", "a\nb c\nd\ne"),
    (f"<a title='{'<b>no</b> ' * 20_000}'>l</a>", "l"), (f'<p data-x="{">" * 70_000}">t', "t"),
    ("<a '>'" * 50_000 + "x", None), ("<b <!-- c", "<b"),
])
def test_whole_visible_text(page, text):
    assert visible_text(page) == text or (text is None and visible_text(page).endswith("x"))


@pytest.mark.parametrize("cell", ["w" * 100_000, "<br>".join(["w" * 70] * 1000), "<table><tr><td>" + "w " * 2000 + "</table>"])
def test_wide_cells_do_not_blow_up_a_table(cell):
    page = f"<table><tr><td>{cell}<td>x" + "<tr><td>a<td>b" * 1000 + "</table>"
    text = visible_text(page)
    assert len(text) < 2 * len(page) and sorted("".join(re.sub("<[^>]*>", "", page).split())) == sorted("".join(text.split()))


def test_columns_far_to_the_right():
    page = "<table>" + "<tr>" + f"<td>{'w' * 60}" * 50 + "<tr><td colspan=1000><td>z" * 500 + "</table>"
    text = visible_text(page)
    assert len(text) < 2 * len(page) and text.count("z") == 500
