"""Keyword matching by expressions and by automata against plain substring tests."""

import random

import pytest
from pyspark.sql import functions as F

from lodestrata.operators.keywords import Matcher, general_terms_filter, keyword_match

DICTIONARY = "mission string, topic string, combo_id long, terms array<string>"


def plain(texts, dictionary):
    """(id, mission, topic) of every text row: any combination all of whose terms it holds."""
    out = []
    for i, text in texts:
        topics = {(m, t) for m, t, _, terms in dictionary if text is not None and None not in terms and all(w in text for w in terms)}
        out += [(i, *t) for t in topics]
    return sorted(out, key=str)


def made(rng, n_terms):
    alphabet = "abcdeü "
    words = ["".join(rng.choice(alphabet) for _ in range(rng.randint(2, 9))) for _ in range(n_terms)]
    rows = [(rng.choice(["X", "Y"]), f"topic {rng.randint(0, 400)}", i, rng.sample(words, rng.randint(1, 3))) for i in range(n_terms // 2)]
    texts = [(i % 150, "".join(rng.choice(alphabet + "XYZ") for _ in range(rng.randint(0, 300)))) for i in range(200)]
    return texts, rows


def test_ten_thousand_terms_give_the_rows_of_substring_tests(spark):
    texts, rows = made(random.Random(3), 26_000)
    assert len({t for r in rows for t in r[3]}) > 10_000
    df = spark.createDataFrame(texts, "id long, text string").repartition(4)
    dictionary = spark.createDataFrame(rows, DICTIONARY)
    want = plain(texts, rows)
    assert len(want) > 1_000
    for chars in (1 << 20, 9_000):  # one automaton, and several with topics of their own
        assert sorted(map(tuple, keyword_match(df, dictionary, chars=chars).collect()), key=str) == want


def test_expressions_and_automata_agree_on_nulls_empty_terms_and_repeats(spark):
    texts = [(1, "heat pump"), (1, "heat pump"), (2, None), (3, ""), (None, "heater"), (4, "pump. heat"), (5, "Heat pump")]
    rows = [("A", "t", 1, ["heat", "pump"]), ("A", "t", 2, ["heat", "heat"]), ("A", "e", 3, ["", "pump"]), ("A", "all", 4, [""]), ("B", "n", 5, ["heat", None]), ("B", "s", 6, [" pump"])]
    df = spark.createDataFrame(texts, "id int, text string").withColumns({"mission": F.lit(1), "topic": F.lit(2), "terms": F.lit(3)})
    dictionary, want = spark.createDataFrame(rows, DICTIONARY), plain(texts, rows)
    for expressions in (64, 0):
        assert sorted(map(tuple, keyword_match(df, dictionary, expressions=expressions).collect()), key=str) == want
    got = [sorted(map(tuple, keyword_match(df, dictionary, True, expressions=e).filter("topic = 't'").collect()), key=str) for e in (64, 0)]
    assert got[0] == got[1] == sorted([(1, "A", "t"), (None, "A", "t"), (4, "A", "t")], key=str)
    assert keyword_match(df, dictionary.limit(0)).count() == 0 and keyword_match(df.limit(0), dictionary, expressions=0).count() == 0


def test_long_text_and_refused_topic(spark):
    assert Matcher([("A", "t", [["ab", "ba"]])]).hits("ab" * 500_000) == [("A", "t")]
    with pytest.raises(ValueError, match="too long"):
        keyword_match(spark.createDataFrame([(1, "x")], "id int, text string"), spark.createDataFrame([("A", "t", 1, ["x" * 200])], DICTIONARY), chars=10)


def test_general_terms_last_topic_with_hits_decides(spark):
    hits = spark.createDataFrame(
        [(1, "A", "x"), (1, "A", "a general terms"), (2, "A", "x"), (2, "A", "b general terms"), (3, "B", "y"), (None, "A", "x")], "id int, mission string, topic string"
    )
    assert sorted(map(tuple, general_terms_filter(hits).collect())) == [(2, "A", "b general terms"), (2, "A", "x"), (3, "B", "y")]
    assert general_terms_filter(hits, "any").filter("id = 1").count() == 2
