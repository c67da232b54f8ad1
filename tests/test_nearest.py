"""Pivot search against all distances."""

import random

import numpy as np
import pytest

from lodestrata.operators import nearest as N


def table(spark, points):
    return spark.createDataFrame([(i, [float(x) for x in p]) for i, p in points], "id long, v array<double>")


def plain(left, right, k):
    out = set()
    for i, p in left:
        d = sorted((float(np.sqrt(((np.array(p) - np.array(q)) ** 2).sum())), j) for j, q in right)[:k]
        out |= {(i, j) for _, j in d}
    return out


@pytest.mark.parametrize("k", [1, 5])
def test_same_as_plain(spark, monkeypatch, k):
    for name, value in {"PIVOTS": 7, "SLICES": 3, "BLOCK": 20, "ASKED": 50}.items():
        monkeypatch.setattr(N, name, value)
    rng = random.Random(k)
    centres = [[rng.uniform(0, 40) for _ in range(3)] for _ in range(6)]
    points = [(i, [c + rng.gauss(0, 1) for c in rng.choice(centres)]) for i in range(300)]
    points += [(300 + i, points[0][1]) for i in range(40)]  # equal vectors: ties by id
    left, right = points[::2], points[1::2]
    got = N.nearest(table(spark, left), table(spark, right), k).collect()
    assert len(got) == k * len(left) and {(r["id"], r["n_id"]) for r in got} == plain(left, right, k)
    asking, searched = N.routes(table(spark, left), table(spark, right), k)
    pairs = asking.join(searched.drop("v"), ["cell", "slice"]).count()
    assert pairs < 0.5 * len(left) * len(right)  # most pairs are never measured


def test_few_or_no_rows(spark):
    two = table(spark, [(1, [0.0, 1.0]), (2, [1.0, 1.0])])
    assert N.nearest(two, two, 5).count() == 4
    assert N.nearest(two, two.limit(0), 5).collect() == [] and N.nearest(two.limit(0), two, 5).collect() == []


def test_rows_that_need_every_slice_go_on_in_parts(spark, monkeypatch):
    for name, value in {"PIVOTS": 16, "SLICES": 4, "BLOCK": 16}.items():
        monkeypatch.setattr(N, name, value)
    sizes = []
    kept_batch = N.pa.RecordBatch.from_arrays
    rng = np.random.default_rng(1)
    df = table(spark, [(i, rng.normal(size=24)) for i in range(900)])
    asking, _ = N.routes(df, df, 5)
    parts = asking.coalesce(1).mapInArrow(lambda batches: (kept_batch([N.pa.array([b.num_rows])], ["n"]) for b in batches), "n long")
    sizes = [r["n"] for r in parts.collect()]
    assert sum(sizes) > 20 * 900
    left, right = rng.normal(size=(150, 24)), np.repeat(rng.normal(size=(40, 24)), 3, axis=0)
    row, at, d = N._closest(left, right, 7)
    all_d = N._distances(left, right)
    top = np.argsort(all_d, axis=1, kind="stable")[:, :7]
    assert (at.reshape(150, 7) == top).all() and (d.reshape(150, 7) == np.take_along_axis(all_d, top, 1)).all()
    assert (row == np.repeat(np.arange(150), 7)).all()


def shuffled(spark):
    """Rows that all stages so far have written to shuffles."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


@pytest.mark.parametrize("crowd", [0, 700])
def test_rows_that_no_slice_spares_are_shuffled_a_few_times(spark, monkeypatch, crowd):
    for name, value in {"PIVOTS": 8, "SLICES": 2, "BLOCK": 32, "ASKED": 32}.items():
        monkeypatch.setattr(N, name, value)
    rng = np.random.default_rng(3)
    points = np.vstack([rng.normal(size=(1400 - crowd, 24)), np.repeat(rng.normal(size=(1, 24)), crowd, axis=0)])
    df, before = table(spark, list(enumerate(points))), shuffled(spark)
    got = {(r["id"], r["n_id"]): r["d"] for r in N.nearest(df, df, 4).collect()}
    assert shuffled(spark) - before < 50 * len(points)
    all_d = N._distances(points, points)
    top = np.argsort(all_d, axis=1, kind="stable")[:, :4]
    assert got == {(i, j): all_d[i, j] for i in range(1400) for j in top[i]}


@pytest.mark.parametrize(("held", "share"), [(150, 200), (1 << 21, 150), (150, 1 << 23)])
def test_parts_and_shares_of_bounded_size(spark, monkeypatch, held, share):
    for name, value in {"PIVOTS": 5, "SLICES": 3, "BLOCK": 20, "HELD": held, "SHARE": share}.items():
        monkeypatch.setattr(N, name, value)
    rng = random.Random(9)
    centres = [[rng.uniform(0, 40) for _ in range(3)] for _ in range(6)]
    points = [(i - 90, [c + rng.gauss(0, 1) for c in rng.choice(centres)]) for i in range(260)]
    points += [(300 + i, points[0][1]) for i in range(40)]
    left, right = points[::2], points[1::2]
    parts, shares = N._grid(len(left), len(right), 3, 4)
    assert -(-len(left) // parts) * 3 <= max(held, 3) and -(-len(right) // shares) * 3 <= max(share, 3)
    got = N.nearest(table(spark, left), table(spark, right), 6).collect()
    assert len(got) == 6 * len(left) and {(r["id"], r["n_id"]) for r in got} == plain(left, right, 6)


def test_a_part_meets_rows_in_any_order(monkeypatch):
    for name, value in {"TILE": 16, "PAIRS": 10}.items():
        monkeypatch.setattr(N, name, value)
    rng = np.random.default_rng(5)
    x, y = rng.integers(0, 3, (70, 3)).astype(float), rng.integers(0, 3, (200, 3)).astype(float)  # many ties
    ids, all_d = rng.permutation(200) - 100, N._distances(x, y)
    pivot = y[0]
    part = N._Part(np.arange(70), x, np.full(70, np.inf), 7)
    for at in [*range(0, 12, 3), *range(12, 200, 40)]:
        some = slice(at, at + (3 if at < 12 else 40))
        own = N._distances(y[some], pivot[None])[:, 0]
        part.add(ids[some], y[some], own.min(), own.max(), N._distances(x, pivot[None])[:, 0])
    found = [tuple(r.values()) for b in part.found() for r in b.to_pylist()]
    assert found == [(i, *p[::-1]) for i in range(70) for p in sorted(zip(all_d[i], ids, strict=True))[:7]]
