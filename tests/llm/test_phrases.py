"""Collocations against plain counting, and prefix-free parsing on its own."""

import random
import re
from collections import Counter

import duckdb
import pytest

from lodestrata.llm import phrases as P
from lodestrata.llm.queries import op13_collocations

COLUMNS = "doc_id long, text string, lang string, chunk string, f int, n string"


def plain(docs, least, longest, share, top):
    counts = {}
    for text, lang in docs:
        lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        f = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\n-\r]", lower):
            words = [w for w in re.split("[ \t]+", piece) if w]
            for n in range(1, longest + 1):
                f.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = set()
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = {p: c for p, c in f.items() if c >= least and len(p) > 1}
        kept = []
        for p, a in found.items():
            inside = any(len(q) > len(p) and 100 * c >= share * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, c in found.items())
            if not inside:
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n, -score))
    return out


def texts(n, seed):
    rng = random.Random(seed)
    words = ["a", "b", "The", "the", "é", "É", "c\x1cd", "e\xa0f", "x"]
    line = "one very common line of more than nine words stands here"
    out = [(" ".join(rng.choices(words, k=rng.randint(0, 60))) + rng.choice(["", ". ", "\n", "\t;", "  "]) + rng.choice(["", line]), rng.choice(["en", "fr", None, "und"])) for _ in range(n)]
    return [*out, (None, "en"), ("", None), ("...", "de"), (" ".join(rng.choices(words, k=100_000)), "fr")]


@pytest.mark.parametrize(("rarity", "share", "top"), [(2, 100, 2000), (50, 80, 7)])
def test_same_as_plain(spark, rarity, share, top, monkeypatch):
    docs = texts(150, rarity)
    monkeypatch.setattr(P, "BLOCK", 700)
    monkeypatch.setattr(P.frequent_phrases, "__defaults__", (100, 5, rarity, "lang", "text"))
    df = spark.createDataFrame([(i, t, lang, "x", 1, "y") for i, (t, lang) in enumerate(docs)], COLUMNS).repartition(3)
    got = [tuple(r) for r in P.collocations(df, least=20, share=share, top=top).collect()]
    assert len(got) == len(set(got)) and set(got) == plain(docs, 20, 5, share, top)


def test_bitmap_that_lets_all_through(spark, monkeypatch):
    """A map too small for its phrases costs work only."""
    monkeypatch.setattr(P, "BITS", 15)
    monkeypatch.setattr(P, "_in", lambda bitmap, h: h == h)
    docs = texts(60, 9)
    df = spark.createDataFrame([(i, t, lang, "x", 1, "y") for i, (t, lang) in enumerate(docs)], COLUMNS)
    assert {tuple(r) for r in P.collocations(df, least=20).collect()} == plain(docs, 20, 5, 100, 2000)


def test_chunks_own_each_start_once():
    rng = random.Random(1)
    words = [rng.choice([b"a", b"b", b"c"]) for _ in range(3000)]
    ends = [700, 703, 705, 1500, 3000]
    found = list(P.parse(words, ends, 4, 3))
    starts = [i for a, _, own in found for i in range(a, a + own)]
    assert starts == list(range(3000))
    for a, b, own in found:
        end = next(e for e in ends if e > a)
        assert b <= end and (own == b - a or own == b - a - 4)
    # equal passages are cut alike
    twice = words[:700] * 2
    again = [twice[a:b] for a, b, _ in P.parse(twice, [700, 1400], 4, 3)]
    assert again[: len(again) // 2] == again[len(again) // 2 :]


def test_exact_scores_beyond_64_bits(spark):
    a, n, left, right = 3 * 10**11 + 7, 10**15 + 3, 4 * 10**11, 5 * 10**11 + 1
    row = spark.sql(f"select (cast({a} as decimal(19,0)) * cast({n} as decimal(19,0)) * cast(1000 as decimal(4,0))) div (cast({left} as decimal(19,0)) * cast({right} as decimal(19,0)))")
    assert row.first()[0] == 1000 * a * n // (left * right)


def test_empty_table(spark):
    assert P.collocations(spark.createDataFrame([], COLUMNS)).collect() == []


def test_query_is_its_sql(spark):
    db = duckdb.connect()
    db.sql("create view documents as select * from '/root/testdata/sf0.01/documents.parquet'")
    expected = {tuple(r) for r in db.sql(P.ORACLE).fetchall()}
    rows = [tuple(r) for r in op13_collocations(spark, "/root/testdata/sf0.01").collect()]
    assert len(rows) == len(set(rows)) and set(rows) == expected
