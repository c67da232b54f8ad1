"""Incremental enrichment of debate files with Structured Streaming.

A store is a folder of generations; a generation is what a rebuild wrote plus a folder for
each stream batch since, folded together as they come (see ``sources.stores``).  A batch writes
its own rows only; readers merge by key, the newest file's row last, so running it again changes nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keywords import collapse_labels, keyword_match
from ..operators.training import upsert
from ..sources import stores as runs
from ..sources.debates import debates, parse_files
from ..sources.tables import _fs, exists, list_dirs

BINARY = "path string, modificationTime timestamp, length long, content binary"
KEYS = {"debates": "speech_id", "keyword_labels": "id", "ml_labels": "id"}
BASE = "batch=base"


def stream_debates(spark: SparkSession, root: str) -> DataFrame:
    """New debate files as they arrive; the query's checkpoint remembers which were done."""
    return spark.readStream.format("binaryFile").schema(BINARY).option("pathGlobFilter", "*.xml").option("recursiveFileLookup", True).load(root)


def all_files(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.xml").load(root)


def _generation(spark: SparkSession, store: str) -> int:
    """The newest generation whose base was written to the end, folded since or not; 0 (which needs none) if there is no such."""
    found = [int(d.removeprefix("generation=")) for d in (list_dirs(spark, store) if exists(spark, store) else []) if d.startswith("generation=")]

    def whole(folder: str) -> bool:
        return exists(spark, f"{folder}/{BASE}/_SUCCESS") or any(n.startswith("merged=") for n in runs.folders(spark, folder))

    return max((g for g in found if whole(f"{store}/generation={g:06d}")), default=0)


def _key(store: str) -> str:
    return KEYS[store.rstrip("/").rsplit("/", 1)[-1]]


def read_store(spark: SparkSession, store: str) -> DataFrame | None:
    """The store's rows, each key's newest; None if there are none yet."""
    rows = runs.read(spark, f"{store}/generation={_generation(spark, store):06d}", _key(store))
    return None if rows is None else rows.drop("stamp")


def enrich(speeches: DataFrame, dictionary: DataFrame) -> DataFrame:
    texts = speeches.select(F.col("speech_id").alias("id"), F.col("speech").alias("text"), "stamp")
    return collapse_labels(keyword_match(texts, dictionary)).join(texts, "id")


def _tables(files: DataFrame, dictionary: DataFrame, models: Callable[[DataFrame], DataFrame] | None) -> dict[str, DataFrame]:
    """The rows that files bring to each store; of a speech that several files hold the newest counts."""
    # a file's time orders its rows against other files', its place those within it
    stamps = files.select("path", F.col("modificationTime").alias("time"))
    rows = parse_files(files).join(stamps, "path")
    all_rows = debates(rows, keep=("path", "pos", "time")).withColumn("stamp", F.struct("time", "path", "pos")).drop("path", "pos", "time")
    speeches = upsert(all_rows.limit(0), all_rows, "speech_id", "stamp")
    out = {"debates": speeches, "keyword_labels": enrich(speeches, dictionary)}
    if models:
        texts = speeches.select(F.col("speech_id").alias("id"), F.col("speech").alias("text"), "stamp")
        out["ml_labels"] = models(texts)
    return out


def stream_enrich(files: DataFrame, dictionary: DataFrame, stores: str, checkpoint: str, models: Callable[[DataFrame], DataFrame] | None = None):
    """Parse, label and upsert each batch of files; running a batch again leaves the stores' rows the same.

    ``models`` adds prediction columns to (id, text, stamp) rows.  Another checkpoint's batches have folders of their own.
    """
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        for name, new in _tables(df, dictionary, models).items():
            store = f"{stores}/{name}"
            folder = f"{store}/generation={_generation(spark, store):06d}"
            runs.append(new, folder, f"{run}-{number:012d}")
            runs.compact(spark, folder, _key(store))

    return files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def full_rebuild(spark: SparkSession, root: str, dictionary: DataFrame, stores: str, models: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """All files at once, replacing the stores: a new generation, which counts from when it is whole.

    The one before it stays for readers that had begun; older ones are deleted.
    """
    for name, rows in _tables(all_files(spark, root), dictionary, models).items():
        store = f"{stores}/{name}"
        before = _generation(spark, store)
        rows.write.mode("overwrite").parquet(f"{store}/generation={before + 1:06d}/{BASE}")
        fs, path = _fs(spark, store)
        for old in list_dirs(spark, store):
            if old.startswith("generation=") and int(old.removeprefix("generation=")) < before:
                fs.delete(path.suffix(f"/{old}"), True)


def update(spark: SparkSession, root: str, dictionary: DataFrame, stores: str, checkpoint: str, models: Callable[[DataFrame], DataFrame] | None = None, full: bool = False) -> None:
    """New files only, or all of them if that is asked for or both label stores are empty."""
    held = [read_store(spark, f"{stores}/{name}") for name in ("keyword_labels", "ml_labels")]
    if full or all(s is None or s.isEmpty() for s in held):
        full_rebuild(spark, root, dictionary, stores, models)
    else:
        stream_enrich(stream_debates(spark, root), dictionary, stores, checkpoint, models).awaitTermination()
