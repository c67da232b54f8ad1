"""Exact nearest neighbours with pivots: the triangle inequality skips slices of the searched table.

A few pivots are drawn by hash.  Every searched row lies in its nearest pivot's cell, at a
known distance, and a cell is cut into slices by that distance.  A row r that has k rows within t
needs, of a cell with pivot p, only those whose distance to p differs from r's by at most t.
The bound t comes from the k rows nearest to each pivot, then from what r has found.

Asking rows are dealt into large parts along the cells, searched rows into a few shares of their slices.  A task holds
a part and reads a share of the slices that the part needs as it comes, keeping the k nearest for each row: what is
shuffled is the searched table once a part, the asking one once a share, and k rows for each row and share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import kept

#: The most pivots and slices of a cell, whatever the tables' size; rows that a slice should hold, and a share at least; those of a part that asks at least.
PIVOTS, SLICES, BLOCK, ASKED = 64, 16, 2048, 4096
#: The most numbers in the vectors of a part, which a task holds (16 MB), and of a share, which it sorts and reads; tasks for each core, where the tables are large enough.
HELD, SHARE, TASKS = 1 << 21, 1 << 23, 3
#: Rows that a task measures or sends on at once; of a part, searched rows and pairs with exact distances, measured at once.
ROWS = 64
TILE, CHUNK, PAIRS = 512, 2048, 1 << 16
NEAR = "id long, n_id long, d double"


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 1))


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``x`` and ``y``."""
    return np.sqrt(np.stack([((y - row) ** 2).sum(axis=1) for row in x])) if len(x) else np.zeros((0, len(y)))


def _closest(x: np.ndarray, y: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of ``x``, row of ``y``, distance) of the ``k`` rows of ``y`` nearest to each row of ``x``, nearest first, ties to the first.

    A product of matrices tells, within its rounding, which rows can be among them; their distances are then taken exactly."""
    k, size = min(k, len(y)), (y**2).sum(axis=1)
    found = []
    for first in range(0, len(x), ROWS):
        part = x[first : first + ROWS]
        own = (part**2).sum(axis=1)
        about = own[:, None] + size - 2 * (part @ y.T)
        bound = np.partition(about, k - 1, axis=1)[:, k - 1] + 1e-11 * (own + size.max())
        a, b = np.nonzero(~(about > bound[:, None]))
        d = np.sqrt(((y[b] - part[a]) ** 2).sum(axis=1))
        order = np.lexsort((b, d, a))
        a, b, d = a[order], b[order], d[order]
        top = np.arange(len(a)) - np.searchsorted(a, a) < k
        found.append((a[top] + first, b[top], d[top]))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def _cells(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Each row's nearest pivot and its distances to all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = _distances(_matrix(batch[1]), pivots)
            cell = d.argmin(axis=1) if len(d) else np.zeros(0, np.int64)
            far = pa.ListArray.from_arrays(pa.array(np.arange(len(d) + 1) * len(pivots), pa.int32()), pa.array(d.ravel()))
            columns = [batch[0], batch[1], pa.array(cell, pa.int32()), pa.array(d[np.arange(len(d)), cell]), far]
            yield pa.RecordBatch.from_arrays(columns, ["id", "v", "cell", "at", "far"])

    return rows.mapInArrow(run, "id long, v array<double>, cell int, at double, far array<double>")


def _layout(left: DataFrame, right: DataFrame, k: int) -> tuple[np.ndarray, DataFrame, DataFrame, tuple[np.ndarray, ...], np.ndarray]:
    """Pivots, asking rows (id, v, cell, at, far), searched rows (n_id, v, cell, slice, at), the slices (cell, slice, least and greatest at), and
    for each pivot a distance within which k searched rows lie."""
    n = right.count()
    n_pivots = min(PIVOTS, max(1, -(-n // BLOCK)))
    n_slices = min(SLICES, max(1, -(-n // (n_pivots * BLOCK))))
    drawn = right.orderBy(F.xxhash64("id"), "id").limit(n_pivots).select("v").collect()
    pivots = np.array([r["v"] for r in drawn], np.float64)
    if not len(pivots):
        pivots = np.zeros((1, 1))
    searched = kept(_cells(right, pivots).drop("far"))
    asking = _cells(left, pivots)
    first = Window.partitionBy("cell").orderBy("at")
    near = searched.select("cell", "at").withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k).collect()  # at most k for each pivot
    spread = searched.groupBy("cell").agg(F.percentile_approx("at", [i / n_slices for i in range(1, n_slices)] or [1.0], 1000).alias("cuts")).collect()
    cuts = {r["cell"]: sorted(set(r["cuts"])) for r in spread}
    between = _distances(pivots, pivots)
    reach = np.full(len(pivots), np.inf)
    if len(near) >= k:
        near_cell, near_at = np.array([r["cell"] for r in near]), np.array([r["at"] for r in near])
        reach = np.sort(between[:, near_cell] + near_at, axis=1)[:, k - 1]
    bounds = F.create_map(*[x for c, at in cuts.items() for x in (F.lit(c), F.array(*[F.lit(float(a)) for a in at]))]) if cuts else F.create_map()
    inside = F.size(F.filter(F.element_at(bounds, F.col("cell")), lambda c: c < F.col("at"))) if cuts else F.lit(0)
    sliced = kept(searched.select(F.col("id").alias("n_id"), "v", "cell", inside.alias("slice"), "at"))
    ends = sliced.groupBy("cell", "slice").agg(F.min("at").alias("lo"), F.max("at").alias("hi")).collect()  # at most PIVOTS * SLICES
    cell, piece = np.array([r["cell"] for r in ends], np.int32), np.array([r["slice"] for r in ends], np.int32)
    lo, hi = np.array([r["lo"] for r in ends]), np.array([r["hi"] for r in ends])
    return pivots, asking, sliced, (cell, piece, lo, hi), reach


def _within(at: np.ndarray, cell: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """A distance within which each row has k searched rows."""
    return (at + reach[cell]) * (1 + 1e-12) + 1e-12


def _apart(far: np.ndarray, t: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Whether no row whose distance to the pivot is from ``lo`` to ``hi`` can be within ``t`` of one at distance ``far``."""
    return (lo > far + t) | (hi < far - t)


def routes(left: DataFrame, right: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Asking rows with the slices they need (id, v, cell, slice), and searched rows in their slices (n_id, v, cell, slice)."""
    _, asking, sliced, (cell, piece, lo, hi), reach = _layout(left, right, k)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not len(cell):
                continue
            # a row may need every slice, so a few rows at a time go on
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                t = _within(part["at"].to_numpy(), part["cell"].to_numpy(), reach)[:, None]
                row, which = np.nonzero(~_apart(_matrix(part["far"])[:, cell], t, lo, hi))
                columns = [part["id"].take(pa.array(row)), part["v"].take(pa.array(row)), pa.array(cell[which]), pa.array(piece[which])]
                yield pa.RecordBatch.from_arrays(columns, ["id", "v", "cell", "slice"])

    return asking.mapInArrow(route, "id long, v array<double>, cell int, slice int"), sliced.drop("at")


class _Part:
    """Asking rows and the ``k`` nearest that each has found so far; ``t``: a distance within which it has that many."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, t: np.ndarray, k: int):
        self.ids, self.x, self.t, self.own = ids, x, t, (x**2).sum(axis=1)
        self.have, self.n, self.d = np.zeros(len(x), np.int64), np.zeros((len(x), k), np.int64), np.full((len(x), k), np.inf)

    def add(self, ids: np.ndarray, y: np.ndarray, lo: float, hi: float, far: np.ndarray) -> None:
        """Meet searched rows whose distances to their pivot are from ``lo`` to ``hi``; ``far``: those of the asking rows to it."""
        order = np.argsort(ids, kind="stable")
        ids, y = ids[order], y[order]
        k, size = self.n.shape[1], (y**2).sum(axis=1)
        limit = np.minimum(self.t, self.d[:, -1] * (1 + 1e-12) + 1e-12)
        rows = np.flatnonzero(~_apart(far, limit, lo, hi))
        across = np.vstack([-2 * y.T, np.ones(len(y)), size])
        for first in range(0, len(rows), TILE):
            part = rows[first : first + TILE]
            full = self.have[part] == k
            if not full.all():
                few = part[~full]
                row, at, d = _closest(self.x[few], y, k)
                self._take(few[row], ids[at], d)
            part = part[full]
            if len(part):
                # as in _closest: a product tells which can be among the nearest, their distances are then taken exactly
                own = self.own[part]
                about = np.column_stack([self.x[part], own, np.ones(len(part))]) @ across
                which = np.flatnonzero(~(about > (limit[part] ** 2 + 1e-11 * (own + size.max()))[:, None]))
                for some in np.split(which, range(PAIRS, len(which), PAIRS)):
                    row, at = part[some // len(y)], some % len(y)
                    d, n = np.sqrt(((y[at] - self.x[row]) ** 2).sum(axis=1)), ids[at]
                    last = self.d[row, -1]
                    closer = ~((d > last) | ((d == last) & (n > self.n[row, -1])))
                    self._take(row[closer], n[closer], d[closer])

    def _take(self, row: np.ndarray, n: np.ndarray, d: np.ndarray) -> None:
        """Put finds (by ascending row) among those that the rows have, nearest first, ties by id."""
        if not len(row):
            return
        k, those = self.n.shape[1], np.unique(row)
        old = np.arange(k) < self.have[those][:, None]
        row = np.concatenate([np.repeat(those, self.have[those]), row])
        n, d = np.concatenate([self.n[those][old], n]), np.concatenate([self.d[those][old], d])
        order = np.lexsort((n, d, row))
        row, n, d = row[order], n[order], d[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        top = rank < k
        self.n[row[top], rank[top]], self.d[row[top], rank[top]] = n[top], d[top]
        self.have[those] = np.bincount(np.searchsorted(those, row[top]), minlength=len(those))

    def found(self) -> Iterator[pa.RecordBatch]:
        for first in range(0, len(self.ids), CHUNK):
            part = slice(first, first + CHUNK)
            there = np.arange(self.n.shape[1]) < self.have[part][:, None]
            columns = [np.repeat(self.ids[part], self.have[part]), self.n[part][there], self.d[part][there]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "n_id", "d"])


def _grid(n_left: int, n_right: int, width: int, cores: int) -> tuple[int, int]:
    """Numbers of parts and of shares: none too large for a task, few copies, and enough for the cores where the tables are large enough."""
    parts = max(1, -(-n_left * width // HELD), min(-(-n_left // ASKED), round((TASKS * cores) ** 0.5)))
    return parts, max(1, -(-n_right * width // SHARE), min(-(-n_right // BLOCK), -(-TASKS * cores // parts)))


def nearest(left: DataFrame, right: DataFrame, k: int) -> DataFrame:
    """The ``k`` rows of ``right`` nearest to each row of ``left`` (both: id long, v array of doubles of one length): id, n_id, d.

    Exact; ties go to the smaller n_id; a row is among its own neighbours if both tables hold it; fewer where ``right`` has fewer.
    """
    pivots, asking, searched, (cell, piece, lo, hi), reach = _layout(left, right, k)
    asking = kept(asking.drop("far"))
    counts = [(r["cell"], r["n"]) for r in asking.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).orderBy("cell").collect()]  # at most PIVOTS
    n_left = sum(n for _, n in counts)
    parts, shares = _grid(n_left, searched.count(), pivots.shape[1], left.sparkSession.sparkContext.defaultParallelism)

    def of_cell(values: list[int]) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.col("cell")) if values else F.lit(0)

    # a cell's rows are dealt over a range of their number, and the ranges, one after the other, are cut into parts
    starts, sizes, start = [0] * len(pivots), [1] * len(pivots), 0
    for c, n in counts:
        starts[c], sizes[c], start = start, n, start + n
    place = of_cell(starts) + F.pmod(F.xxhash64("id"), of_cell(sizes))
    asking = asking.withColumn("part", (place / F.lit(max(1, -(-n_left // parts)))).cast("int"))

    def need(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        needed = np.zeros((parts, len(cell)), bool)
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                some = batch.slice(first, ROWS)
                t = _within(some["at"].to_numpy(), some["cell"].to_numpy(), reach)[:, None]
                far = _distances(_matrix(some["v"]), pivots)
                np.logical_or.at(needed, some["part"].to_numpy(), ~_apart(far[:, cell], t, lo, hi))
        part, which = np.nonzero(needed)
        yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(cell[which]), pa.array(piece[which])], ["part", "cell", "slice"])

    needs = asking.mapInArrow(need, "part int, cell int, slice int").distinct()  # at most PIVOTS * SLICES rows a part
    share = F.pmod(F.xxhash64("n_id"), F.lit(shares)).cast("int")
    group = (F.col("part") * shares + F.col("share")).alias("group")
    there = searched.join(F.broadcast(needs), ["cell", "slice"]).withColumn("share", share).select(group, F.lit(1).alias("kind"), "cell", "at", F.col("n_id").alias("id"), "v")
    here = asking.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))).select(group, F.lit(0).alias("kind"), "cell", "at", "id", "v")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, waiting, part, pivot, far = None, [], None, None, None
        for batch in batches:
            g, kind, c = (batch[i].to_numpy() for i in range(3))
            ends = np.flatnonzero((np.diff(g) != 0) | (np.diff(kind) != 0) | (np.diff(c) != 0)) + 1
            for first, end in zip([0, *ends], [*ends, batch.num_rows], strict=True):
                if first == end:
                    continue
                if g[first] != now:
                    if part:
                        yield from part.found()
                    now, waiting, part, pivot = g[first], [], None, None
                for at in range(first, end, CHUNK):
                    rows = batch.slice(at, min(CHUNK, end - at))
                    ids, v, far_own = rows["id"].to_numpy(), _matrix(rows["v"]), rows["at"].to_numpy()
                    if not kind[first]:
                        waiting.append((ids, v, _within(far_own, rows["cell"].to_numpy(), reach)))
                    elif part or waiting:
                        if waiting:
                            part, waiting = _Part(*(np.concatenate(x) for x in zip(*waiting, strict=True)), k), []
                        if pivot != c[first]:
                            pivot, far = c[first], np.sqrt(((part.x - pivots[c[first]]) ** 2).sum(axis=1))
                        part.add(ids, v, far_own.min(), far_own.max(), far)
        if part:
            yield from part.found()

    met = here.unionByName(there).repartitionById(parts * shares, "group").sortWithinPartitions("group", "kind", "cell", "at")
    found = met.mapInArrow(meet, NEAR)
    return found.withColumn("_n", F.row_number().over(Window.partitionBy("id").orderBy("d", "n_id"))).filter(F.col("_n") <= k).drop("_n")
