"""The decomposition against numpy's, and embeddings made with it."""

import numpy as np
import pytest

from lodestrata.operators import sums
from lodestrata.operators import svd as V
from lodestrata.operators.learning import add_embeddings, fit_encoder


@pytest.mark.parametrize("parts", [1, 5])
def test_subspace_is_numpys(spark, parts, monkeypatch):
    monkeypatch.setattr(sums, "RANGE", 160)
    monkeypatch.setattr(sums, "BRANCHES", 2)
    rng = np.random.default_rng(4)
    a = (rng.random((300, 50)) < 0.2) * rng.random((300, 50)) @ np.diag(np.linspace(3, 0.1, 50))
    a[7] = 0
    rows = [(([int(i) for i in np.flatnonzero(r)], [float(x) for x in r[r != 0]]),) for r in a]
    df = spark.createDataFrame(rows, "row struct<i:array<int>,x:array<double>>").repartition(parts)
    v, values = V.right_vectors(df, 50, 5, passes=12)
    _, s, vt = np.linalg.svd(a)
    assert np.allclose(values, s[:5], rtol=1e-6)
    assert np.allclose(v @ v.T, vt[:5].T @ vt[:5], atol=1e-3)
    assert np.allclose(v.T @ v, np.eye(5), atol=1e-9)


def test_embeddings_and_given_encoder(spark):
    texts = [(i, f"{w} pump {w} again {i % 5}") for i, w in enumerate(["heat", "solar", "wind", "grid"] * 20)]
    df = spark.createDataFrame([*texts, (900, None), (901, ""), (902, "?!")], "id long, text string")
    encoder = fit_encoder(df, 4)
    made = {r["id"]: r for r in add_embeddings(df, encoder).collect()}
    assert 900 not in made and made[0]["embedding_model"] == "svd-tfidf-4"
    norms = {i: np.linalg.norm(r["embedding"]) for i, r in made.items()}
    assert norms[901] in (0, pytest.approx(1)) and norms[5] == pytest.approx(1)
    again = add_embeddings(df, name="mine").filter("id = 3").first()
    assert again["embedding_model"] == "mine" and list(again.asDict()) == ["id", "text", "embedding", "embedding_model"]


def test_rank_below_size_and_empty(spark):
    df = spark.createDataFrame([(([1], [2.0]),), (([1], [1.0]),), (([], []),)], "row struct<i:array<int>,x:array<double>>")
    v, values = V.right_vectors(df, 8, 4)
    assert v.shape == (8, 1) and values[0] == pytest.approx(5**0.5) and v[1, 0] == pytest.approx(1)
    assert V.right_vectors(df.limit(0), 8, 4)[0].shape[1] == 0
