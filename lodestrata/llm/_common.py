"""Helpers that the corpus operators share: the shared folder, table reads, block counts."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts: space and \\x09-\\x0D (what ``bytes.split()`` splits on).
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    ``spark.checkpoint.dir`` names it on a cluster; a temporary folder stands in
    only where the setting is absent (local tests).
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="lodestrata-")
        sc.setCheckpointDir(path)
    return path


def cut(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder as Parquet and read it back.

    A lost executor costs only the tasks that read it, never a recomputation of
    what came before, and a second use doesn't recompute either.  The files stay until the
    folder is cleared.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/lodestrata-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of ``sf_dir``; Python workers started from here on find this package where the driver found it.

    (On a cluster whose machines don't share that folder, ship the package with ``addPyFile``.)
    """
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows, so many at a time: their Python objects, not those of a whole batch, are in memory."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def give_back() -> None:
    """Return what this worker has freed to the system: workers wait for their next task beside the executor, in the same limit."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)


def thrifty(step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same step; its worker gives memory back when the step's last row is out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from step(batches)
        give_back()

    return run


def thrifty_pair(step: Callable[[pa.Table, pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The same step on a pair of groups; its worker gives memory back after each."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return step(left, right)
        finally:
            give_back()

    return run


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id's text modulo ``folds``; a null id falls in fold 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds, F.lit(0))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
