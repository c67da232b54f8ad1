"""Learned text vectors: a randomised singular value decomposition of the hashed TF-IDF matrix.

The rows stay where they are.  A pass multiplies the matrix with a few random directions
and back (A'A Q): each task sums its own rows' share, shares are summed as a tree by ranges of
features, and the driver sees one matrix of features x directions, whose size is a parameter.  Some
passes turn the directions towards the leading singular vectors; a small eigenproblem ends it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import kept
from .sums import add_up

#: Rows multiplied at once.
ROWS = 64


def sparse(column: str) -> Column:
    """Indices and values of a sparse vector column."""
    v = F.unwrap_udt(column)
    return F.struct(v["indices"].alias("i"), v["values"].alias("x"))


def sparse_rows(column: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indices and values of sparse rows one after the other, and how many each row has."""
    i, x = column.flatten()
    sizes = pc.fill_null(pc.list_value_length(i), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return i.flatten().to_numpy(zero_copy_only=False).astype(np.int64), x.flatten().to_numpy(zero_copy_only=False).astype(np.float64), sizes


def _chunks(batch: pa.RecordBatch, at: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(indices, values, row of each, rows) of a few sparse rows at a time."""
    i, x, sizes = sparse_rows(batch.column(at))
    ends = np.concatenate([[0], np.cumsum(sizes)])
    for first in range(0, batch.num_rows, ROWS):
        part = sizes[first : first + ROWS]
        own = slice(ends[first], ends[first + len(part)])
        yield i[own], x[own], np.repeat(np.arange(len(part)), part), len(part)


def _times(i: np.ndarray, x: np.ndarray, row: np.ndarray, n: int, q: np.ndarray) -> np.ndarray:
    out = np.zeros((n, q.shape[1]))
    if len(i):
        starts = np.flatnonzero(np.diff(row, prepend=-1))
        out[row[starts]] = np.add.reduceat(q[i] * x[:, None], starts)
    return out


def _gram_times(rows: DataFrame, q: np.ndarray) -> np.ndarray:
    """A'A q, summed over tasks as a tree; ``rows`` has one column of sparse rows."""
    shared, (features, width) = rows.sparkSession.sparkContext.broadcast(q), q.shape

    def local(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((features, width))
        for batch in batches:
            for i, x, row, n in _chunks(batch, 0):
                if len(i):
                    # the few rows as a matrix of the slots that they hold
                    slots, at = np.unique(i, return_inverse=True)
                    part = np.zeros((n, len(slots)))
                    part[row, at] = x
                    total[slots] += part.T @ (part @ shared.value[slots])
        return total

    out = add_up(rows, local, features * width).reshape(q.shape)
    shared.unpersist()
    return out


def right_vectors(rows: DataFrame, features: int, k: int, passes: int = 3, spare: int = 10, seed: int = 13) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` leading right singular vectors (features x k) and singular values of a matrix of sparse rows (one column).

    Fewer come back where the matrix has fewer directions; signs are set so that a vector's largest entry is positive.
    """
    width = min(k + spare, features)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((features, width)))[0]
    for _ in range(passes):
        q = np.linalg.qr(_gram_times(rows, q))[0]
    small = q.T @ _gram_times(rows, q)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    order = [j for j in np.argsort(-values, kind="stable")[:k] if values[j] > 1e-12 * max(values.max(), 1e-300)]
    v = q @ turn[:, order]
    if v.shape[1]:
        v *= np.sign(v[np.abs(v).argmax(axis=0), np.arange(v.shape[1])])
    return v, np.sqrt(values[order])


class SvdEncoder:
    """A fitted TF-IDF pipeline and the right singular vectors of its training matrix."""

    def __init__(self, tfidf, vectors: np.ndarray, column: str = "features"):
        self.tfidf, self.vectors, self.column = tfidf, vectors, column
        self.name = f"svd-tfidf-{vectors.shape[1]}"

    @staticmethod
    def fit(tfidf, df: DataFrame, k: int, column: str = "features", **more) -> SvdEncoder:
        rows = kept(tfidf.transform(df).select(sparse(column).alias("row")))
        features = tfidf.stages[1].getNumFeatures()
        return SvdEncoder(tfidf, right_vectors(rows, features, k, **more)[0], column)

    def transform(self, df: DataFrame, out: str = "embedding") -> DataFrame:
        """``df`` with vectors of length one (zero for texts without known words)."""
        shared = df.sparkSession.sparkContext.broadcast(self.vectors)

        @F.pandas_udf("array<double>")
        def project(parts: pd.DataFrame) -> pd.Series:
            v, found = shared.value, []
            for i, x in zip(parts["i"], parts["x"], strict=True):
                y = np.asarray(x) @ v[np.asarray(i, np.int64)] if i is not None and len(i) else np.zeros(v.shape[1])
                norm = np.linalg.norm(y)
                found.append(y / norm if norm > 1e-9 else np.zeros(len(y)))
            return pd.Series(found)

        made = [s.getOutputCol() for s in self.tfidf.stages]
        return self.tfidf.transform(df).withColumn(out, project(sparse(self.column))).drop(*[c for c in made if c not in df.columns])
