"""The tree decides inside and beside articles too."""

from lodestrata.llm import style_tree


def texts(spark, pages):
    rows = [(i, f"http://h.example/{i}", html) for i, html in enumerate(pages)]
    got = style_tree.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    return {r["page_id"]: r["text"] for r in got.collect()}


def test_template_block_in_article(spark):
    got = texts(spark, [f"<body><article><p>Story {i} told.</p><div class='zz-box'>Read our rules</div></article></body>" for i in range(8)])
    assert got == {i: f"Story {i} told." for i in range(8)}


def test_copied_article_stays(spark):
    got = texts(spark, ["<body><article><h1>One</h1><p>The same story.</p></article></body>"] * 8)
    assert got == dict.fromkeys(range(8), "One\nThe same story.")


def test_text_beside_article(spark):
    got = texts(spark, [f"<body><div class='lead'>Lead {i} here.</div><article><p>Story {i}.</p></article><div class='zz'>Same</div></body>" for i in range(8)])
    assert got == {i: f"Lead {i} here.\nStory {i}." for i in range(8)}


def test_names_of_wrappers(spark):
    one = texts(spark, [f"<body><div class='page no-sidebar'><article><p>Story {i}.</p></article></div></body>" for i in range(4)])
    two = texts(spark, [f"<body><div class='set-aside'><article><p>Story {i}.</p></article></div></body>" for i in range(4)])
    three = texts(spark, [f"<body><div class='long-form'><p>Story {i}.</p></div></body>" for i in range(4)])
    assert one == two == three == {i: f"Story {i}." for i in range(4)}
