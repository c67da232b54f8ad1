"""The style tree against plain sums over small pages, and reading in linear time."""

import math
import time

import pytest
from lodestrata.llm import style_tree
from lodestrata.llm.style_tree import Page, main_blocks

PAGES = [
    ("h", f"<body><div class=top>Top line</div><div class=story><p>Story {i}</p>{'<p>More</p>' * (i % 3)}<p class=end>{'Same' if i else 'Other'}</p></div></body>")
    for i in range(9)
]


def brute(pages):
    seqs, texts, there = {}, {}, {}
    for _, source in pages:
        page = Page(source)
        for node, children in page.children.items():
            seqs.setdefault(node, []).append(tuple(children))
        for node, text in {(n, t) for t, n, *_ in page.blocks}:
            texts.setdefault(node, {}).setdefault(text, []).append(page.paths[node])
        for node in page.paths:
            there[node] = there.get(node, 0) + 1
    out = {}
    for node in {n for by in texts.values() for paths in by.values() for p in paths for n in p}:
        presented = seqs.get(node, [])
        pages_of = max(len(presented), there.get(node, 0))
        logs = [math.log(len(paths)) for by in texts.values() for paths in by.values() if node in paths[0]]
        content = 1 - (sum(logs) / len(logs) / math.log(pages_of) if pages_of > 1 else 0)
        counts = [presented.count(x) for x in set(presented)]
        entropy = -sum(c / len(presented) * math.log(c / len(presented)) for c in counts) if presented else 0
        presentation = entropy / math.log(pages_of) if presented and pages_of > 1 else content
        out[node] = (pages_of, pytest.approx((1 - style_tree.GAMMA) * presentation + style_tree.GAMMA * content))
    return out


def test_importance(spark):
    got = style_tree.importance(spark.createDataFrame(PAGES, "host string, html string").repartition(3)).collect()
    assert {r["node"]: (r["pages"], r["importance"]) for r in got} == brute(PAGES)


def test_articles(spark):
    shell = "<nav>Menu</nav><div class=ad>Buy {0}</div><article class='share-prices'><h1>Title {0}</h1><p>Share prices rose {0}</p><p class=fix>Read more here</p>"
    shell += "<div class=related><p>Else {1}</p></div><div id='search-results'>Found {0}</div></article><div class=foot>All rights</div>"
    rows = [(i, f"http://h/{i}", shell.format(i, "same"), 1) for i in range(8)] + [(100, "http://lone/x", shell.format(1, 2), 1)]
    got = {r["page_id"]: r["text"] for r in style_tree.extract(spark.createDataFrame(rows, "page_id int, url string, html string, node int")).collect()}
    assert all(got[i] == f"Title {i}\nShare prices rose {i}\nFound {i}" for i in range(8))
    # what is on one page shows nothing about its template
    assert got[100] == "Title 1\nShare prices rose 1\nRead more here\nFound 1"


def test_an_article_that_returns_stays(spark):
    rows = [(i, "http://h/x", "<article><p>The very same</p></article><p>Below</p>", 1) for i in range(6)]
    got = style_tree.extract(spark.createDataFrame(rows, "page_id int, url string, html string, pages int")).collect()
    assert {r["text"] for r in got} == {"The very same"}


@pytest.mark.parametrize(
    "source",
    ["<a" * 500_000, '<a x=">"' * 120_000, "<b>" * 50_000 + "<p></p>" * 20_000, "<div>" * 200_000, "<p><div>" + "<b>" * 50_000 + "</p>" * 50_000, "<!--" * 250_000]
    + ["<script>" * 120_000, "<a ='" * 200_000, "x<" * 500_000, "&" * 1_000_000, "<p class=a>x" * 80_000],
)
def test_reading_is_linear(source):
    began = time.process_time()
    Page(source)
    assert time.process_time() - began < 5


def test_comments_and_cut_off_tags():
    assert main_blocks(Page("<!-- none")) == [] and main_blocks(Page("a<!--b-->c<p x='>'>d<a hr")) == ["ac", "d"]
    assert main_blocks(Page("1 < 2 <3 > 0<p>&lt;b&gt;&nbsp;x")) == ["1 < 2 <3 > 0", "<b> x"]
