"""BM25 search against plain sums over all documents."""

import math
import random
from collections import Counter

from lodestrata.operators import search as R


def plain(docs, question, n):
    counts = {i: Counter(R.words(t or "")) for i, t in docs if i is not None}
    mean = sum(sum(c.values()) for c in counts.values()) / len(counts)
    terms = sorted(set(R.words(question)))
    df = {t: sum(t in c for c in counts.values()) for t in terms}
    scores = []
    for i, c in counts.items():
        s = 0.0
        for t in terms:
            if c[t]:
                idf = math.log(1 + (len(counts) - df[t] + 0.5) / (df[t] + 0.5))
                s += idf * c[t] * 2.2 / (c[t] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean))
        if s:
            scores.append((-round(s, 9), i))
    return [(i, -s) for s, i in sorted(scores)[:n]]


def corpus(n):
    rng = random.Random(8)
    usual = ["the", "of", "Heat", "pump", "été", "x1"]
    docs = [(i, " ".join(rng.choices(usual, [30, 30, 1, 1, 2, 3], k=rng.randint(0, 40)))) for i in range(n)]
    docs += [(n + i, "heat pump heat pump grid") for i in range(30)]  # equal scores
    return [*docs, (n + 50, None), (n + 51, ""), (None, "heat"), (n + 52, "the " * 100_000)]


def test_same_as_plain_and_skips_blocks(spark, monkeypatch):
    monkeypatch.setattr(R, "BLOCK_ROWS", 16)
    docs = corpus(900)
    docs += [(2000 + i, "heat " * (i % 3)) for i in range(400)]
    df = spark.createDataFrame(docs, "id long, text string").repartitionByRange(3, "id")
    index = R.build_index(df, "id", "text")
    assert index.filter("size(ids) > 16").isEmpty()
    for question, n in [("Heat pump?", 5), ("the heat of the PUMP", 40), ("été", 10_000), ("grid heat", 29)]:
        top, blocks = R.search(index, question, n)
        assert [tuple(r) for r in top.collect()] == plain(docs, question, n)
        assert blocks["scored"] <= blocks["blocks"]
        if n == 5:
            assert blocks["scored"] < blocks["blocks"] / 2  # the other blocks' bounds are below the fifth score


def test_nothing_found_and_empty_table(spark):
    df = spark.createDataFrame([(1, "so it is")], "id long, text string")
    assert R.search(R.build_index(df, "id", "text"), "other words", 3)[0].collect() == []
    assert R.search(R.build_index(df, "id", "text"), "?!", 3)[0].collect() == []
    assert R.search(R.build_index(df.limit(0), "id", "text"), "so", 3)[0].collect() == []


def test_works_are_filtered_first(spark):
    rows = [(1, "Heat", "pump", 9), (2, "Heat", None, 9), (3, None, "heat", 9), (4, "Heat", "pump", 4), (5, "cold", "pump", 5)]
    works = spark.createDataFrame(rows, "id long, title string, abstract string, cited_by_count long")
    assert [r["id"] for r in R.search_works(works, "heat pump").collect()] == [1, 5]
