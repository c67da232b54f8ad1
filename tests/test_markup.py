"""Elements of pages against a plain tree, and tolerant reading."""

import random
from html import escape

import duckdb
import pytest
from pyspark.sql import functions as F

from lodestrata.operators.markup import VOID, Pick, element_text, extract_listing
from lodestrata.plans import texts

LISTING = """<!DOCTYPE html><body><style>li{}</style><script>var a = "<li>no</li>";</script>
<ul><li DATA-path='/one' class="doc  first"><a class=link href=/1>One &amp; only</a><br>new</li>
<li class="doc child" data-path="/two"><a href="/2" class="link x">Two</a></li><li class="doc" data-path="/3&gt;">Th<b>ree</b></li></ul></body>"""


def tree(rng, depth=0):
    """A random page as (tag, attributes, children), a text or a comment."""
    if depth > 4 or rng.random() < 0.3:
        return rng.choice(["", "a", " b & c ", "ü<", "&amp;", "\n", "x" * 40])
    tag = rng.choice("div p li a b br script span img".split())
    attrs = {k: rng.choice(["", "one", "one two", 'q"t', "a&b"]) for k in rng.sample(["class", "href", "id"], rng.randint(0, 3))}
    kids = [] if tag in VOID else ["var x = 1 < 2;"] if tag == "script" else [tree(rng, depth + 1) for _ in range(rng.randint(0, 4))]
    return tag, attrs, kids


def markup(node, rng):
    if isinstance(node, str):
        return escape(node, quote=rng.random() < 0.5)
    tag, attrs, kids = node
    head = "".join(f" {k.upper() if rng.random() < 0.3 else k}='{escape(v)}'" for k, v in attrs.items())
    inner = "".join(kids) if tag == "script" else "<!-- <li>gone</li> -->".join(markup(k, rng) for k in kids)
    return f"<{tag}{head}>{inner}" + ("" if tag in VOID else f"</{tag}>")


def text(node):
    if isinstance(node, str):
        return node
    return " " if node[0] == "br" else "" if node[0] == "script" else "".join(map(text, node[2]))


def walk(node, around=()):
    if not isinstance(node, str):
        yield node, around
        for kid in node[2]:
            yield from walk(kid, (*around, node[0]))


def test_random_pages_match_a_plain_tree(spark):
    rng = random.Random(7)
    trees = [("div", {}, [tree(rng) for _ in range(3)]) for _ in range(300)]
    pages = spark.createDataFrame([(i, markup(t, rng)) for i, t in enumerate(trees)], "id long, html string").repartition(3)
    assert dict(pages.select("id", element_text("html")).collect()) == {i: text(t) for i, t in enumerate(trees)}
    picks = {"t": Pick(cls=("one",), but=("two",)), "h": Pick("a", attrs={"href": None}, inside=("div",), take="href", prefix=">")}
    want = []
    for i, t in enumerate(trees):
        named = [(n, around, n[1].get("class", "").split()) for n, around in walk(t)]
        ts = [text(n) for n, _, c in named if "one" in c and "two" not in c]
        hs = [">" + n[1]["href"] for n, around, _ in named if n[0] == "a" and "href" in n[1] and "div" in around]
        want += [(i, pos, *pair) for pos, pair in enumerate(zip(ts, hs, strict=False))]
    assert sorted(map(tuple, extract_listing(pages, "id", "html", picks).collect())) == want and len(want) > 50


def test_attributes_in_any_order_and_items_in_turn(spark):
    pages = spark.createDataFrame([(1, LISTING)], "id int, html string")
    picks = {"title": Pick("li", cls=("doc",), but=("child",)), "path": Pick("li", attrs={"data-path": None}, but=("child",), take="data-path", prefix="https://x")}
    rows = [tuple(r)[1:] for r in extract_listing(pages, "id", "html", picks).orderBy("pos").collect()]
    assert rows == [(0, "One & only new", "https://x/one"), (1, "Three", "https://x/3>")]
    turns = {"even": Pick("li", step=2), "odd": Pick("li", start=1, step=2), "link": Pick("a", attrs={"class": "link"}, take="href")}
    assert [tuple(r)[1:] for r in extract_listing(pages, "id", "html", turns).collect()] == [(0, "One & only new", "Two", "/1")]


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("", ""), (None, None), ("a<p", "a"), ("a</ar", "a"), ("a<b x='>", "a"), ("x<!-- c", "x"), ("x &am", "x &am"), ("x &amp", "x &"), ("a < b > c", "a < b > c"),
        ("<p>a</b>c", "ac"), ("<![if x]>a<![ q>b", "ab"), ("<script>x", ""), ("<template>t</template>u", "u"), ("1<br/>2<BR>3", "1 2 3"), ("a<", "a<"),
    ],
)
def test_torn_pages(spark, html, want):
    assert spark.createDataFrame([(html,)], "html string").select(element_text("html")).first()[0] == want


def test_references_cut_short_are_read_as_in_sql(spark, tmp_path):
    cut = ["&quot", "&quo", "&lt", "&copy", "&middot", "&amp", "&am", "&amplt;", "&ampquot", "&quotA;", "&nosuch;", "&", "&quot;&lt;"]
    html = "<nav>" + "".join(f'<title>a{c}</title><li><a href="/x{c}">b{c}</a></li><div class="ad">c{c}</div><li><a href="/y">d</a></li>' for c in cut)
    pages = spark.createDataFrame([(1, html), (2, None), (3, "&quot")], "page_id long, html string")
    pages.coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS FROM '{tmp_path}/pages.parquet/*.parquet'")
    for name in ("B12_element_text", "A24_extract_listing", "A24_listing_columns"):
        got = sorted(map(tuple, texts.QUERIES[name](spark, str(tmp_path)).collect()), key=str)
        assert got == sorted(db.execute(texts.ORACLES[name]).fetchall(), key=str) and len(got) > 2
    assert pages.select(element_text("html")).collect()[2][0] == '"'  # as HTML has it


def test_open_and_nested_elements_nulls_repeats_and_long_pages(spark):
    pick = {"v": Pick("li")}
    rows = [(1, "<li>a<li>b</li>c"), (2, None), (3, ""), (None, "<li>n"), (1, "<li>again</li>"), (4, "<li>" * 20000 + "z"), (5, "<!--" * 200000), (6, "<li>" + "</b>x" * 100000)]
    pages = spark.createDataFrame(rows, "id int, html string").withColumn("pos", F.lit(9)).withColumn("v", F.lit(None).cast("string"))
    got = [(r.id, r.pos, r.v) for r in extract_listing(pages, "id", "html", pick).filter("id is null or id < 4").collect()]
    assert sorted(got, key=str) == sorted([(1, 0, "abc"), (1, 1, "b"), (None, 0, "n"), (1, 0, "again")], key=str)
    assert extract_listing(pages, "id", "html", pick).groupBy("id").count().filter("id >= 4").orderBy("id").collect() == [(4, 20000), (6, 1)]
    assert extract_listing(pages, "id", "html", {}).count() == 0 and extract_listing(pages.limit(0), "id", "html", pick).count() == 0

