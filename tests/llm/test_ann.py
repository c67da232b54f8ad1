"""Cross-polytope search: recall, the share of rows ranked, tiny tables, large components, clashing names."""

import numpy as np
from lodestrata.llm import ann

KINDS = "vec_id long, embedding array<double>, slot int, query_id int, bucket int, vector int, id string"


def table(spark, x, first=0):
    return spark.createDataFrame([(first + i, v.tolist(), 1, 2, 3, 4, "x") for i, v in enumerate(x)], KINDS).repartition(3)


def test_recall_and_share(spark, monkeypatch):
    # few numbers counted at once, and small blocks, give several shares and blocks
    monkeypatch.setattr(ann, "COUNTED", 700)
    monkeypatch.setattr(ann, "BLOCK_BITS", 8)
    x = np.random.default_rng(3).normal(size=(3000, 64))
    got = ann.nearest(table(spark, x)).toPandas()
    hit = 0
    for q in range(0, 3000, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        mine = got[got["query_id"] == q].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 11)) and np.allclose(mine["score"], d[mine["vec_id"]])
        hit += len(set(mine["vec_id"]) & set(np.argsort(d)[:10].tolist()))
    assert hit / 300 >= 0.9
    hits = np.zeros((30, 3000), int)
    for t in range(40):
        own, asked = ann.axes(x, t, 1, 5)[:, 0], ann.axes(x[::100], t, 6, 5)
        hits += (own[None, None, :] == asked[:, :, None]).sum(axis=1)
    assert (hits >= 4).mean() < 0.2


def test_few_rows_are_all_ranked(spark):
    x = np.random.default_rng(4).normal(size=(6, 16))
    x[1] *= 1e300
    got = ann.nearest(table(spark, x)).collect()
    assert sorted(r["vec_id"] for r in got) == [1, 2, 3, 4, 5] and {r["query_id"] for r in got} == {0}
    rows = [(0, [1.0, 0.0], 1, 2, 3, 4, "x"), (1, [1.0, 0.0], 1, 2, 3, 4, "x"), (1, [1.0, 0.0], 1, 2, 3, 4, "x"), (None, [1.0, 0.0], 1, 2, 3, 4, "x")]
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in ann.nearest(spark.createDataFrame(rows, KINDS)).collect()] == [(0, 1, 0.0)]
