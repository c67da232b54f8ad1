"""The sketch against the kernel, and the grid against a plain fit."""

import numpy as np
import pytest

from lodestrata.operators import kernel as K


def test_inner_products_are_kernel_values():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((60, 20))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for gamma, coef0 in [(1.0, 1e-6), (0.7, 0.5)]:
        exact = (gamma * x @ x.T + coef0) ** 3
        errors = []
        for seed in range(5):
            f = K.PolySketch(20, gamma, coef0, size=4096, seed=seed).maker()(x)
            errors.append(np.abs(f @ f.T - exact).mean())
        # stated error: 3 / sqrt(size) of the largest kernel value
        assert np.mean(errors) < 3 / np.sqrt(4096) * exact.max()


@pytest.fixture(scope="module")
def cubic(spark):
    """Labels by the sign of a product of three entries: no linear machine beats chance."""
    rng = np.random.default_rng(6)
    x = rng.standard_normal((400, 4))
    y = (x[:, 0] * x[:, 1] * x[:, 2] > 0).astype(int)
    rows = [(i, [float(v) for v in p], int(t)) for i, (p, t) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "id long, embedding array<double>, relevant int").repartition(3), x, y


def test_grid_beats_the_majority_and_predicts(spark, cubic):
    df, x, y = cubic
    model, scores = K.fit_grid(df.unionByName(spark.createDataFrame([(900, None, 1)], df.schema)), passes=30)
    assert len(scores) == 9 and {s[2] for s in scores} == {5} and len({s[:2] for s in scores}) == 9
    majority = max(y.mean(), 1 - y.mean())
    assert min(s[3] for s in scores) > majority + 0.2
    with_null = df.limit(50).unionByName(spark.createDataFrame([(900, None, 1)], df.schema))
    got = model.predict(with_null).collect()
    assert sum(r["predictions"] == r["relevant"] for r in got if r["id"] != 900) > 45
    assert [r["predictions"] for r in got if r["id"] == 900] == [None] and got[0]["prediction_model"] == model.name


def test_same_objective_as_a_plain_fit(cubic):
    df, x, y = cubic
    model, _ = K.fit_grid(df, cs=(1.2,), coef0s=(1e-6,), folds=2, size=256, passes=60)
    f = np.hstack([model.sketch.maker()(x), np.ones((len(x), 1))])
    s = np.where(y > 0, 1.0, -1.0)

    def objective(w):
        short = np.maximum(0, 1 - s * (f @ w))
        return 0.5 * (w[:-1] ** 2).sum() + 1.2 * (short**2).sum()

    w = np.zeros(257)
    for _ in range(60):  # Newton's method
        active = s * (f @ w) < 1
        h = 2.4 * f[active].T @ f[active] + np.diag([1.0] * 256 + [1e-9])
        w = np.linalg.solve(h, 2.4 * f[active].T @ s[active])
    assert objective(model.weights) < objective(w) * 1.02


def test_no_rows(cubic):
    with pytest.raises(ValueError, match="no rows"):
        K.fit_grid(cubic[0].limit(0))


def test_sketches_of_a_grid_share_their_tables():
    x = np.random.default_rng(2).normal(size=(9, 6))
    sketches = [K.PolySketch(6, 0.3, c, size=64) for c in (1e-7, 0.5, 2.0)]
    for s, made in zip(sketches, K._together(sketches)(x), strict=True):
        assert np.allclose(made, s.maker()(x), rtol=1e-10, atol=1e-12)
    with pytest.raises(ValueError, match="coef0"):
        K._together([*sketches, K.PolySketch(6, 0.4, 1.0, size=64)])
