"""The duplicate stages keep clean rows without an id, and one row of each group of copies."""

import random

import corpus_pipeline

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def text(seed, n=40):
    rng = random.Random(seed)
    return " ".join(rng.choice("red green blue north south east west river stone cloud field".split()) + str(rng.randrange(99)) for _ in range(n))


def run(spark, stage, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], COLUMNS).repartition(3)
    return sorted(((r["doc_id"], r["text"]) for r in stage(spark, docs, "").collect()), key=str)


ROWS = [(None, text(1)), (None, text(2)), (None, text(2)), (None, text(2)), (7, text(3)), (None, text(3)), (8, text(4)), (8, text(4)), (8, text(3))]


def test_near_dedup(spark):
    want = [(None, text(1)), (None, text(2)), (7, text(3)), (8, text(4))]
    assert run(spark, corpus_pipeline.near_dedup, ROWS) == sorted(want, key=str)


def test_passage_dedup(spark):
    rows = [(None, text(1)), (None, text(2)), (None, text(2)), (7, text(3)), (None, text(3)), (8, text(4))]
    assert run(spark, corpus_pipeline.passage_dedup, rows) == sorted([(None, text(1)), (None, text(2)), (7, text(3)), (8, text(4))], key=str)
    # a passage of a text without an id goes from the other one
    two = [(None, f"{text(5)} A{text(6)}"), (None, f"{text(7)} B{text(6)}")]
    got = run(spark, corpus_pipeline.passage_dedup, two)
    assert len(got) == 2 and sum(text(6)[5:] in t for _, t in got) == 1
