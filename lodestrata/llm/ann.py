"""Approximate nearest neighbours by cross-polytope hashing with multiprobe and exact reranking.

A table turns unit vectors by three rounds of random signs and a fast Hadamard
transform and names the nearest signed axis.  Every row's number is filed under (table,
axis); every query probes its nearest axes in each table, and the two meet in a join on (table,
axis).  Rows that a query meets in ``votes`` tables are its candidates.  They are sent to the
blocks that hold the rows' vectors, once each, where exact distances in double precision rank them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _common as common

#: Vectors in a block, as a power of two.
BLOCK_BITS = 11
#: Rows of whose numbers a query's hits are counted at once.
COUNTED = 1 << 20


def hadamard(x: np.ndarray) -> np.ndarray:
    """The (unnormalised) Walsh-Hadamard transform of the rows, whose length is a power of two."""
    n, h = x.shape[1], 1
    x = x.copy()
    while h < n:
        y = x.reshape(len(x), -1, 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), n)
        h *= 2
    return x


def rotate(x: np.ndarray, seed: int, table: int) -> np.ndarray:
    """Pseudo-rotation H D3 H D2 H D1 of the rows, padded with zeros to a power of two."""
    size = 1 << max(0, x.shape[1] - 1).bit_length()
    y = np.zeros((len(x), size))
    y[:, : x.shape[1]] = x
    signs = np.random.default_rng([seed, table]).choice([-1.0, 1.0], (3, size))
    for s in signs:
        y = hadamard(y * s) / np.sqrt(size)
    return y


def axes(x: np.ndarray, table: int, probes: int, seed: int) -> np.ndarray:
    """[row, probe]: the signed axes nearest to the rows in one table, nearest first."""
    x = x / np.abs(x).max(axis=1, keepdims=True)  # the squares of large components must not overflow
    y = rotate(x / np.linalg.norm(x, axis=1, keepdims=True), seed, table)
    both = np.concatenate([y, -y], axis=1)
    return both.argmax(axis=1)[:, None] if probes == 1 else np.argsort(-both, axis=1, kind="stable")[:, :probes]


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1) if len(flat) else np.empty((0, 0))


def filed(rows: DataFrame, key: str, tables: int, probes: int, seed: int) -> DataFrame:
    """(bucket, key): the rows (key, vector) under the ``probes`` nearest axes of each table."""

    def run(batches):
        for batch in batches:
            x = _matrix(batch[1])
            for t in range(tables if len(x) else 0):
                found = axes(x, t, probes, seed).astype(np.int64) + (t << 32)
                yield pa.RecordBatch.from_arrays([pa.array(found.ravel()), pa.array(np.repeat(batch[0].to_numpy(), found.shape[1]))], ["bucket", key])

    return rows.select(key, "vector").mapInArrow(run, f"bucket long, {key} long")


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) as doubles, without vectors that are null, zero, or hold null or non-finite components."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.filter(F.col("vector").isNotNull() & finite & F.exists("vector", lambda c: c != 0))


def nearest(
    vectors: DataFrame,
    every: int = 100,
    k: int = 10,
    tables: int = 40,
    probes: int = 6,
    votes: int = 4,
    seed: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The ``k`` nearest found (smallest Euclidean distance) of every row whose id is divisible by ``every``.

    Returns query_id, rank (from 1), vec_id, score (the distance); ties go to the smaller
    id; the query's own row is no candidate.  Null vectors, zero vectors and vectors with
    null or non-finite components take no part, nor do null ids or vectors of another
    length than most; of rows with one id the first in value order counts.  Equal vectors
    share one entry that keeps their k + 1 smallest ids, which is all that can be
    returned of them.  Where fewer than k + 1 rows have ``votes`` hits, rows with fewer hits are
    candidates, too; where all tables together give fewer, as in a tiny table, all rows are.
    An empty table gives no rows; other columns are ignored.
    """
    rows = usable(vectors, id_col, vector_col).filter(F.col("id").isNotNull())
    rows = rows.groupBy("id").agg(F.min("vector").alias("vector"))
    length = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.filter(F.size("vector") == (length["n"] if length else 0))
    # the k + 1 smallest ids of equal vectors, by a window over each id range's own smallest first
    spread = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(64)))
    first = Window.partitionBy("vector", "salt").orderBy("id")
    some = spread.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k + 1)
    again = Window.partitionBy("vector").orderBy("id")
    some = some.withColumn("n", F.row_number().over(again)).filter(F.col("n") <= k + 1)
    classes = common.cut(some.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("id", F.col("ids")[0]))
    queries = common.cut(rows.filter(F.col("id") % every == 0))

    near = _ranked(classes.select("id", "vector"), queries.select("id", "vector"), k, tables, probes, votes, seed)
    return _expand(near, classes, k)


def _ranked(entries: DataFrame, asked: DataFrame, k: int, tables: int, probes: int, votes: int, seed: int) -> DataFrame:
    """(query_id, id, score): each query's k + 1 nearest of its candidates."""
    # a row's number tells its block and its place there
    entries = common.cut(entries.withColumn("slot", F.monotonically_increasing_id()))
    asked = asked.withColumnRenamed("id", "query_id")
    sizes = entries.groupBy(F.shiftright("slot", 33).alias("task")).agg(F.count(F.lit(1)).alias("n")).collect()  # one row a task
    blocks = np.array([(r["task"] << (33 - BLOCK_BITS)) + b for r in sizes for b in range(-(-r["n"] >> BLOCK_BITS))], np.int64)
    shares = max(1, -(-sum(r["n"] for r in sizes) // COUNTED))

    share = F.pmod(F.xxhash64("slot"), F.lit(shares)).cast("int").alias("share")
    buckets = filed(entries, "slot", tables, 1, seed).groupBy("bucket", share).agg(F.sort_array(F.collect_list("slot")).alias("slots"))
    probed = filed(asked, "query_id", tables, probes, seed)
    met = probed.join(buckets, "bucket").select("query_id", "share", "slots")
    turns = asked.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))

    def vote(hits: pa.Table, query: pa.Table) -> pa.Table:
        found, times = np.unique(hits["slots"].combine_chunks().flatten().to_numpy(), return_counts=True) if len(hits) else (np.empty(0, np.int64),) * 2
        least = votes
        while least > 1 and np.count_nonzero(times >= least) <= k:
            least -= 1
        found = found[times >= least]
        at, starts = np.unique(found >> BLOCK_BITS, return_index=True)
        slots = np.split(found, starts[1:]) if len(found) > k else [None] * len(blocks)
        at = at if len(found) > k else blocks
        n = len(at) if len(query) else 0
        columns = [pa.array(at[:n]), pa.array([query["query_id"][0].as_py()] * n, pa.int64()), query["vector"].take(pa.array([0] * n)), pa.array(slots[:n], pa.list_(pa.int64()))]
        return pa.table(columns, names=["block", "query_id", "vector", "slots"])

    asking = ["query_id", "share"]
    candidates = met.groupBy(*asking).cogroup(turns.groupBy(*asking)).applyInArrow(vote, "block long, query_id long, vector array<double>, slots array<long>")

    def rank(rows: pa.Table, asking: pa.Table) -> pa.Table:
        x, ids = _matrix(rows["vector"]), rows["id"].to_numpy()
        row_of = np.zeros(1 << BLOCK_BITS, np.int64)
        row_of[rows["slot"].to_numpy() & ((1 << BLOCK_BITS) - 1)] = np.arange(len(ids))
        out = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0)]
        for q, v, slots in zip(asking["query_id"].to_pylist(), _matrix(asking["vector"]), asking["slots"], strict=True):
            at = row_of[slots.values.to_numpy() & ((1 << BLOCK_BITS) - 1)] if slots.is_valid else np.arange(len(ids))
            d = x[at] - v
            score = np.sqrt((d * d).sum(axis=1))
            top = _first(score, ids[at], min(k + 1, len(at)))
            for c, part in zip(out, (np.full(len(top), q), ids[at][top], score[top]), strict=True):
                c.append(part)
        return pa.table([np.concatenate(c) for c in out], names=["query_id", "id", "score"])

    placed = entries.withColumn("block", F.shiftright("slot", BLOCK_BITS))
    near = placed.groupBy("block").cogroup(candidates.groupBy("block")).applyInArrow(rank, "query_id long, id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "id")
    return near.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1).drop("n")


def _first(score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    within = np.flatnonzero(score <= np.partition(score, n - 1)[n - 1])
    return within[np.lexsort((ids[within], score[within]))][:n]


def _expand(ranked: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    each = ranked.join(classes.select("id", "ids"), "id").select("query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id <> query_id")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return each.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
