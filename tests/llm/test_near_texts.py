"""Near-copies by exact Jaccard of 5-word shingles, against brute force."""

import random

import corpus_pipeline
import pytest
from lodestrata.llm import near_texts

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def grams(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(texts):
    sets, root = [grams(t) for t in texts], list(range(len(texts)))
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] == sets[j] or (5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) and sets[i] and sets[j]):
                root = [root[j] if r == root[i] else r for r in root]
    return root


def planted():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(900)]
    rows = []
    for _ in range(70):
        base = [rng.choice(words) for _ in range(rng.choice([3, 6, 12, 40, 200, 700]))]
        rows.append(" ".join(base))
        for _ in range(rng.randrange(4)):
            copy = list(base)
            for _ in range(max(1, len(copy) // rng.choice([20, 40, 60, 100]))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(" ".join(copy))
    return [*rows, rows[3], rows[3].upper().replace(" ", "  "), "", None, "  "]


@pytest.mark.parametrize("tile", [1024, 7])
def test_planted_near_copies(spark, monkeypatch, tile):
    monkeypatch.setattr(near_texts, "TILE", tile)
    texts = planted()
    root, least = brute(texts), {}
    assert len(set(root)) < len(set(texts)) - 20
    for i, g in enumerate(root):
        least.setdefault(g, i)
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], COLUMNS).repartition(3)
    kept = [r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()]
    assert sorted(kept) == sorted(least.values())


def test_no_rows(spark):
    assert corpus_pipeline.near_dedup(spark, spark.createDataFrame([], COLUMNS), "").count() == 0
