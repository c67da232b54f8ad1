"""Support vectors with a polynomial kernel, all settings and folds of a grid side by side.

The kernel (gamma x.y + coef0)^degree is a tensor product; its count sketch is the product of the
factors' sketches in the Fourier domain, so inner products of sketches are kernel values, within an error that
falls with the root of the size.  On sketches the machine is linear.  One pass over the rows gives
loss, gradient and held-out hits of every model at once, so 45 fits take the passes of one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import kept
from .sums import add_up

#: Fixed: the grid of the published training script.
C_GRID, COEF0_GRID, DEGREE = (1.1, 1.2, 1.3), (1e-7, 1e-6, 2e-6), 3
#: Rows sketched at once.
ROWS = 256


@dataclass(frozen=True)
class PolySketch:
    """The feature map: rows of ``width`` numbers to ``size`` numbers."""

    width: int
    gamma: float
    coef0: float
    degree: int = DEGREE
    size: int = 1024
    seed: int = 13

    def _tables(self) -> list[np.ndarray]:
        rng, out = np.random.default_rng(self.seed), []
        for _ in range(self.degree):
            table = np.zeros((self.width + 1, self.size))
            table[np.arange(self.width + 1), rng.integers(0, self.size, self.width + 1)] = rng.choice([-1.0, 1.0], self.width + 1)
            out.append(np.fft.rfft(table, axis=1))
        return out

    def maker(self):
        """A function on arrays of rows, with its tables built once."""
        tables = self._tables()

        def make(x: np.ndarray) -> np.ndarray:
            full = np.hstack([np.sqrt(self.gamma) * x, np.full((len(x), 1), np.sqrt(self.coef0))])
            spectrum = full @ tables[0]
            for table in tables[1:]:
                spectrum = spectrum * (full @ table)
            return np.fft.irfft(spectrum, self.size, axis=1)

        return make


def _together(sketches: list[PolySketch]):
    """A function on arrays of rows that makes one array for each sketch; they differ in ``coef0`` alone, so what they share is made once."""
    if len({(s.width, s.gamma, s.degree, s.size, s.seed) for s in sketches}) != 1:
        raise ValueError("sketches must differ in coef0 only")
    one, tables = sketches[0], sketches[0]._tables()

    def make(x: np.ndarray) -> Iterator[np.ndarray]:
        shared = [(np.sqrt(one.gamma) * x) @ table[:-1] for table in tables]
        for s in sketches:
            spectrum = shared[0] + np.sqrt(s.coef0) * tables[0][-1]
            for own, table in zip(shared[1:], tables[1:], strict=True):
                spectrum *= own + np.sqrt(s.coef0) * table[-1]
            yield np.fft.irfft(spectrum, s.size, axis=1)

    return make


def _rows(batch: pa.RecordBatch, at: int) -> np.ndarray:
    column = batch.column(at)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def scale_gamma(rows: DataFrame) -> tuple[int, float]:
    """The vectors' width, and 1 / (width x variance of all their entries); 1 where they don't vary."""
    v = F.col("embedding")
    sums = rows.select(
        F.size(v).alias("n"),
        F.aggregate(v, F.lit(0.0), lambda a, x: a + x).alias("s"),
        F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x).alias("q"),
    ).agg(F.max("n").alias("width"), F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).first()
    if not sums["n"]:
        raise ValueError("there are no rows to fit on")
    variance = sums["q"] / sums["n"] - (sums["s"] / sums["n"]) ** 2
    return sums["width"], 1 / (sums["width"] * variance) if variance > 1e-12 else 1.0


@dataclass
class KernelSvc:
    """A fitted machine: sketch, weights and bias."""

    sketch: PolySketch
    weights: np.ndarray
    c: float

    @property
    def name(self) -> str:
        return f"poly{self.sketch.degree}-svc-c{self.c:g}-coef0{self.sketch.coef0:g}"

    def predict(self, df: DataFrame) -> DataFrame:
        """``df`` with ``predictions`` (0 or 1; null without a vector) and ``prediction_model``."""
        sketch, weights = self.sketch, self.weights

        @F.pandas_udf("int")
        def sides(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            make = sketch.maker()
            for part in parts:
                out = pd.Series([None] * len(part), dtype="Int32")
                known = np.flatnonzero(part.notna().to_numpy())
                for first in range(0, len(known), ROWS):
                    at = known[first : first + ROWS]
                    x = make(np.stack(part.iloc[at].to_numpy()).astype(np.float64))
                    out.iloc[at] = (x @ weights[:-1] + weights[-1] > 0).astype(int)
                yield out

        return df.withColumn("predictions", sides("embedding")).withColumn("prediction_model", F.lit(self.name))


def _pass(rows: DataFrame, sketches: list[PolySketch], w: np.ndarray, folds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Losses, their gradients, and (hits, rows) of the held-out fold, of models (sketch, weights, fold); fold ``folds`` holds out none."""
    shape = w.shape  # sketches x settings of C x (folds + 1) x (size + 1)
    shared = rows.sparkSession.sparkContext.broadcast(w)

    def local(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        weights, make = shared.value, _together(sketches)
        loss, grad, hits = np.zeros(shape[:3]), np.zeros(shape), np.zeros((*shape[:3], 2))
        for batch in batches:
            x, sign, fold = _rows(batch, 0), np.where(batch.column(1).to_numpy() > 0, 1.0, -1.0), batch.column(2).to_numpy()
            for first in range(0, len(x), ROWS):
                part = slice(first, first + ROWS)
                trains = fold[part, None] != np.arange(folds + 1)
                y = sign[part]
                for s, made in enumerate(make(x[part])):
                    f = np.hstack([made, np.ones((len(y), 1))])
                    scores = np.tensordot(f, weights[s], ([1], [2]))  # rows x C x folds
                    short = np.maximum(0, 1 - y[:, None, None] * scores) * trains[:, None, :]
                    loss[s] += (short**2).sum(axis=0)
                    grad[s] += np.tensordot(-2 * short * y[:, None, None], f, ([0], [0]))
                    right = ((scores > 0) == (y > 0)[:, None, None]) & ~trains[:, None, :]
                    hits[s, :, :, 0] += right.sum(axis=0)
                    hits[s, :, :, 1] += (~trains).sum(axis=0)
        return np.concatenate([loss.ravel(), grad.ravel(), hits.ravel()])

    n, m = int(np.prod(shape[:3])), w.size
    total = add_up(rows, local, n + m + 2 * n)
    shared.unpersist()
    return total[:n].reshape(shape[:3]), total[n : n + m].reshape(shape), total[n + m :].reshape(*shape[:3], 2)


def fit_grid(
    df: DataFrame, cs: tuple[float, ...] = C_GRID, coef0s: tuple[float, ...] = COEF0_GRID, folds: int = 5, size: int = 1024, passes: int = 40, seed: int = 13
) -> tuple[KernelSvc, list[tuple[float, float, int, float]]]:
    """Fit every (C, coef0) on every fold and on all rows of ``df`` (embedding, relevant 0 or 1).

    Returns the machine of the best setting, fitted on all rows, and (C, coef0, folds, mean accuracy)
    of each.  Minimises half the squared weights plus C times the squared hinge losses by gradient steps of
    Barzilai and Borwein's length; the weights of least objective are kept.  Folds go by a hash of the
    vector, so copies stay together.  Rows without vector or label are left out; gamma is ``scale``.
    """
    rows = df.filter("embedding is not null and relevant is not null")
    fold = F.pmod(F.xxhash64(F.lit(seed), "embedding"), F.lit(folds)).cast("int")
    rows = kept(rows.select(F.col("embedding").cast("array<double>").alias("embedding"), F.col("relevant").cast("int").alias("relevant"), fold.alias("fold")))
    width, gamma = scale_gamma(rows)
    sketches = [PolySketch(width, gamma, c0, DEGREE, size, seed) for c0 in coef0s]
    c = np.array(cs)[None, :, None]
    ridge = np.ones(size + 1)
    ridge[-1] = 0  # the bias is free
    w = np.zeros((len(coef0s), len(cs), folds + 1, size + 1))
    best = [np.full(w.shape[:3], np.inf), w.copy(), None]
    before = None
    for step in range(passes):
        loss, grad, hits = _pass(rows, sketches, w, folds)
        objective = 0.5 * (w**2 * ridge).sum(axis=3) + c * loss
        slope = w * ridge + c[..., None] * grad
        better = objective < best[0]
        best[0] = np.where(better, objective, best[0])
        best[1][better] = w[better]
        best[2] = hits if best[2] is None else np.where(better[..., None], hits, best[2])
        if before is None:
            length = 1 / np.maximum(np.sqrt((slope**2).sum(axis=3)), 1e-12)
        else:
            dw, dg = w - before[0], slope - before[1]
            inner = (dw * dg).sum(axis=3)
            length = np.where(inner > 1e-300, ((dw**2).sum(axis=3) if step % 2 else inner) / np.maximum(inner if step % 2 else (dg**2).sum(axis=3), 1e-300), 0)
        before = (w, slope)
        w = w - length[..., None] * slope
    hits = best[2][:, :, :folds]
    accuracy = (hits[..., 0] / np.maximum(hits[..., 1], 1)).mean(axis=2)
    scores = [(float(x), float(c0), folds, float(accuracy[i, j])) for i, c0 in enumerate(coef0s) for j, x in enumerate(cs)]
    i, j = np.unravel_index(accuracy.argmax(), accuracy.shape)
    return KernelSvc(sketches[i], best[1][i, j, folds], float(cs[j])), scores
