"""The HTML reader against the standard library's parser and on small pages; Markdown of blocks."""

import re
from html.parser import HTMLParser

import pytest

from textloom.functions import soup


class Plain(HTMLParser):
    """All text outside scripts, styles and the head (but for its title), and the starts of some blocks."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.text, self.hidden, self.links, self.starts, self.head = [], 0, [], [], False

    def handle_starttag(self, tag, attrs):
        self.head = (self.head or tag == "head") and tag != "body"
        self.hidden += tag in ("script", "style")
        self.links += [dict(attrs).get("href")] if tag == "a" else []
        self.starts.append(tag)
        self.inside = tag

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style")
        self.inside = None

    def handle_data(self, data):
        if not self.hidden and (not self.head or self.inside == "title"):
            self.text.append(data)


def letters(text):
    return re.sub(r"\s", "", text)


def test_every_page_keeps_its_text(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    rows = soup.page_blocks(pages, "page_id").collect()
    for page in pages.collect():
        own = sorted((r for r in rows if r.page_id == page.page_id), key=lambda r: (r.block, r.run))
        plain = Plain()
        plain.feed(page.html)
        plain.close()
        assert letters("".join(r.text for r in own)) == letters("".join(plain.text))
        assert [r.href for r in own if r.href] == [x for x in plain.links if x]
        assert sum(r.kind == "item" and r.run == 0 for r in own) == plain.starts.count("li")
        assert sum(r.kind == "heading" and r.run == 0 for r in own) == sum(t in soup.HEADINGS for t in plain.starts)
        assert [r.block for r in own if r.run == 0] == list(range(len({r.block for r in own})))


def kinds(page):
    return [(r[1], r[2], r[3], r[8]) for r in soup.blocks(page)]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, []),
        ("", []),
        (" \n ", []),
        ("a < b <p", [("text", 0, 0, "a < b <p")]),
        ("<p>one<p>two", [("para", 0, 0, "one"), ("para", 0, 0, "two")]),
        ("<ul><li>a<li>b<ol><li>c</ol>d</ul>e", [("item", 1, 1, "a"), ("item", 1, 2, "b"), ("ordered", 2, 1, "c"), ("item", 1, 2, "d"), ("text", 0, 0, "e")]),
        ("x<script>if (a</p>b) '<p>'</script>y<!-- <p> -->z<style>q</style>", [("text", 0, 0, "xyz")]),
        ("<script>never closed <p>a", []),
        ("<H2 class='a>b'>T&eacute;&#233;&#xe9;&amp;amp;</H2>", [("heading", 2, 0, "Tééé&amp;")]),
        ("<pre> a\n  b</pre>c", [("pre", 0, 0, " a\n  b"), ("text", 0, 0, "c")]),
        ("a<br>b<br/> c<hr>d", [("text", 0, 0, "a\nb\nc"), ("rule", 0, 0, ""), ("text", 0, 0, "d")]),
        ("</div></p>a</b>b</table>", [("text", 0, 0, "ab")]),
        ("<blockquote><p>a<blockquote>b</blockquote></blockquote>c", [("quote", 1, 0, "a"), ("quote", 2, 0, "b"), ("text", 0, 0, "c")]),
        ("<head><title>A &lt; B</title><meta x>junk</head><body>c", [("title", 0, 0, "A < B"), ("text", 0, 0, "c")]),
    ],
)
def test_small_pages(page, want):
    assert kinds(page) == want


def test_styles_and_cells():
    rows = list(soup.blocks("<table><tr><th>h<th>k<tr><td>1 <b>x<td>2<table><td>in</table>3</div></table>t <i>e<b>f</i>g</b>"))
    assert [(r[1], r[4], r[5], r[6], r[8], r[9], r[10]) for r in rows] == [
        ("head", 0, 0, 0, "h", False, False), ("head", 0, 0, 1, "k", False, False), ("cell", 0, 1, 0, "1 ", False, False), ("cell", 0, 1, 0, "x", True, False), ("cell", 0, 1, 1, "2", False, False),
        ("cell", 1, 0, 0, "in", False, False), ("cell", 0, 1, 1, "3", False, False), ("text", None, None, None, "t ", False, False), ("text", None, None, None, "e", False, True), ("text", None, None, None, "f", True, True), ("text", None, None, None, "g", True, False),
    ]


def test_markdown(spark):
    page = "<title>T</title><h2>A <b>b</b></h2><p>x <i>y</i><br>z <a href='/u'>l*k</a><ul><li>a<ol><li>b</ol></ul><table><tr><th>h<th>k<tr><td>1<td>2</table><blockquote>q<br>r</blockquote><hr><pre>p\n q</pre>"
    df = spark.createDataFrame([(1, page), (2, None), (3, "")], "page_id long, html string")
    got = {r.page_id: r.text for r in soup.page_markdown(soup.page_blocks(df, "page_id"), "page_id").collect()}
    assert got == {1: "---\ntitle: T\n---\n\n## A **b**\n\nx *y*  \nz [l\\*k](/u)\n\n- a\n\n  1. b\n\n| h | k |\n|-|-|\n| 1 | 2 |\n\n> q  \n> r\n\n---\n\n```\np\n q\n```"}
