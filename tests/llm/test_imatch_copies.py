"""Large groups of copies and near-copies keep their likeness to their edited texts."""

import random

import pytest
from lodestrata.llm import imatch


@pytest.mark.parametrize("changed", [0, 6])
def test_third_of_the_rows(spark, changed):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(3000)]
    base = [f"copy{i}" for i in range(300)]
    rows = []
    for i in range(300):
        text = rng.sample(words, 120)
        if i % 3 == 0:
            text = list(base)
            for _ in range(changed):
                text[rng.randrange(300)] = rng.choice(words)
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r["doc_id"] % 3, r["near_edited"]) for r in imatch.fingerprints(docs).collect()]
    group, others = [x for k, x in got if k == 0], [x for k, x in got if k]
    # its edited texts take in about 120 terms of the next one, which leaves a subset equal with a chance near 0.18
    assert len(group) == 100 and sum(group) / 100 > 0.12 and sum(x > 0 for x in group) >= 75
    assert len(others) == 200 and sum(others) / 200 > 0.12
