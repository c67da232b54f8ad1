"""A folder for intermediate files that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_MADE: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path below ``spark.checkpoint.dir``; a temporary folder stands in for that on a local master only."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="lodestrata-")
        sc.setCheckpointDir(root)
    _MADE.append(f"{root}/{name}-{uuid.uuid4().hex}")
    return _MADE[-1]


def release(spark: SparkSession) -> int:
    """Delete all such folders that this process named, once what was read from them is done with; how many there were."""
    deleted = 0
    while _MADE:
        path = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        deleted += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return deleted


def kept(df: DataFrame, name: str = "kept") -> DataFrame:
    """``df`` written to such a folder and read back: its lineage ends there, and using it again computes nothing again."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
