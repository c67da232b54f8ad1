"""Density clusters against a plain hierarchy over the same graph."""

import math
import random

import pytest

from lodestrata.operators import density as C


def plain(points, k, least, levels):
    """One hierarchy in memory: components by union at each threshold, recursion over their tree."""
    n = len(points)
    near = []
    for i in range(n):
        near.append(sorted((math.dist(points[i], points[j]), j) for j in range(n))[:k])
    core = [x[-1][0] for x in near]
    edges = [(max(d, core[i], core[j]), i, j) for i in range(n) for d, j in near[i] if j != i]
    return core, edges


def tree(points, ends, core, edges, least):
    n = len(points)
    at = lambda w: next(i for i, t in enumerate(ends) if t >= w)
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    steps = []
    for level in range(len(ends)):
        for w, a, b in edges:
            if at(w) <= level and find(a) != find(b):
                parent[find(a)] = find(b)
        parts = {}
        for x in range(n):
            parts.setdefault(find(x), set()).add(x)
        steps.append([frozenset(p) for p in parts.values()])
    density = [1 / max(t, C.CLOSEST) for t in ends] + [0.0]

    def chain(part, level):
        """(stability, bottom level, clusters inside) of the cluster that ``part`` at ``level`` belongs to from there down."""
        own = len(part) * (density[level] - density[level + 1])
        while level:
            inside = [p for p in steps[level - 1] if p <= part and len(p) >= least]
            if len(inside) != 1:
                return own, level, [(p, level - 1) for p in inside]
            part, level = inside[0], level - 1
            own += len(part) * (density[level] - density[level + 1])
        return own, level, []

    def choose(part, level):
        own, bottom, inside = chain(part, level)
        below = [choose(p, q) for p, q in inside]
        total = sum(x[0] for x in below)
        return (own, [(part, bottom)]) if own >= total else (total, [c for x in below for c in x[1]])

    roots = [p for p in steps[-1] if len(p) >= least]
    if len(roots) == 1:
        tops = chain(roots[0], len(ends) - 1)[2]
    else:
        tops = [(p, len(ends) - 1) for p in roots]
    out = {x: (-1, 0.0) for x in range(n)}
    for part, level in tops:
        for members, bottom in choose(part, level)[1]:
            for x in members:
                first = next(q for q, parts in enumerate(steps) if any(x in p and len(p) >= least for p in parts))
                out[x] = (min(members), min(density[first], density[bottom]) / density[bottom])
    return out


def made(seed, copies):
    rng = random.Random(seed)
    points = []
    for centre, spread, n in [((0, 0), 1, 40), ((12, 0), 0.6, 30), ((12, 4), 0.6, 25), ((0, 30), 3, 30)]:
        points += [(centre[0] + rng.gauss(0, spread), centre[1] + rng.gauss(0, spread)) for _ in range(n)]
    points += [(rng.uniform(-60, 60), rng.uniform(-60, 60)) for _ in range(15)]
    return points + [points[50]] * copies


@pytest.mark.parametrize(("seed", "copies", "levels"), [(2, 7, 5)])
def test_same_as_plain(spark, seed, copies, levels):
    points = made(seed, copies)
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id long, v array<double>")
    got = {r["id"]: (r["topic"], r["probability"]) for r in C.density_clusters(df, 5, 8, levels).collect()}
    assert len(got) == len(points)
    _, edges = C.reachability(df, 5)
    distinct, _ = C.reachability(df, 5)
    cuts = edges.selectExpr(f"percentile_approx(w, array({', '.join(str(i / levels) for i in range(1, levels))}), 10000) q", "max(w) m").first()
    ends = sorted({float(x) for x in [*cuts["q"], cuts["m"], distinct.selectExpr("max(core)").first()[0]]})
    core, _ = plain(points, 5, 8, levels)
    assert {r["id"]: r["core"] for r in distinct.collect()} == pytest.approx({i: core[i] for i in {points.index(p) for p in points}})
    # the graph of distinct points; copies join at their core distance
    links = [(r["w"], r["a"], r["b"]) for r in edges.collect()]
    links += [(core[points.index(p)], points.index(p), i) for i, p in enumerate(points) if points.index(p) != i]
    expected = tree(points, ends, core, links, 8)
    assert {i: t for i, (t, _) in got.items()} == {i: t for i, (t, _) in expected.items()}
    for i, (_, p) in got.items():
        assert p == pytest.approx(expected[i][1])
    assert len({t for t, _ in got.values()}) > 3 and any(t == -1 for t, _ in got.values())


def test_chain_merges_in_few_rounds(spark):
    pairs = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(500, 501), (7, 7)], "a long, b long")
    to = {r["node"]: r["to"] for r in C.merged(pairs).collect()}
    assert len(to) == 63 and len({to[i] for i in range(61)}) == 1 and to[500] == to[501] != to[0]
    assert C.merged(pairs.limit(0)) is None


def test_few_points(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0]), (3, [1.0])], "id long, v array<double>")
    assert {(r["id"], r["topic"]) for r in C.density_clusters(df, 5, 5).collect()} == {(1, -1), (2, -1), (3, -1)}
    assert C.density_clusters(df.limit(0)).collect() == []
