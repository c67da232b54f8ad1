"""Stores that grow by appends, kept readable by folding.

A store is a folder of ``batch=...`` folders, one for each append, and of ``merged=...`` folders that stand for
several of these.  A manifest (``manifest=<number>``) names the merged folders that count and the batches that they
replace; the newest whole one holds.  Every folder counts from when its _SUCCESS is there, which Spark writes last, so
an append or a folding that was killed changes nothing.  Files directly in the folder are rows that never fold.

Folders of like size fold together once ``FAN`` of them are there, so a row is rewritten once a level, and fewer than
``FAN`` folders a level are read.  What a folding replaces is deleted by the next one: readers that had begun can end.
One writer at a time is assumed.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import _fs, exists, list_dirs

#: Folders of a level that fold together; a level's folders are up to so many times as large as those of the level below.
FAN = 16
#: Bytes of the largest folder of the lowest level, and of a merged file.
UNIT, FILE = 16 << 20, 128 << 20


def newest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """Each key's row with the greatest ``order`` (null least); a hot key is reduced before it travels."""
    last = rows.groupBy(F.col(key).alias("_key")).agg(F.max_by(F.struct(*rows.columns), F.struct(order)).alias("_row"))
    return last.select("_row.*")


def append(df: DataFrame, store: str, name: str | None = None) -> None:
    """The rows as a batch of their own; an append that is run again adds them again, which readers by key don't notice."""
    df.write.parquet(f"{store}/batch={name + '-' if name else ''}{uuid.uuid4().hex}")


def _whole(spark: SparkSession, store: str, kind: str) -> list[str]:
    return [n for n in list_dirs(spark, store) if n.startswith(f"{kind}=") and exists(spark, f"{store}/{n}/_SUCCESS")]


def _manifest(spark: SparkSession, store: str) -> tuple[int, dict]:
    found = max(_whole(spark, store, "manifest"), default=None)
    if not found:
        return 0, {"merged": [], "folded": []}
    return int(found.removeprefix("manifest=")), json.loads(spark.read.text(f"{store}/{found}", wholetext=True).first()[0])


def folders(spark: SparkSession, store: str) -> list[str]:
    """Names of the folders whose rows are the store's."""
    held = _manifest(spark, store)[1]
    return sorted(held["merged"] + [b for b in _whole(spark, store, "batch") if b not in set(held["folded"])])


def read(spark: SparkSession, store: str, key: str | None = None, order: str = "stamp", schema=None) -> DataFrame | None:
    """All rows, or each key's newest; None if the store has no folder that counts."""
    if not exists(spark, store):
        return None
    fs, path = _fs(spark, store)
    paths = [f"{store}/{n}" for n in folders(spark, store)]
    if any(s.isFile() and s.getPath().getName().endswith(".parquet") for s in fs.listStatus(path)):
        paths.append(f"{store}/*.parquet")
    if not paths:
        return None
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", True)
    rows = reader.parquet(*paths)
    return newest(rows, key, order) if key else rows


def _level(size: int) -> int:
    level = 0
    while size > UNIT * FAN**level:
        level += 1
    return level


def compact(spark: SparkSession, store: str, key: str | None = None, order: str = "stamp", fan: int = FAN) -> bool:
    """Fold the lowest levels that hold ``fan`` folders or more; whether anything was folded.

    With a key its newest row stays, and rows lie in files by the key's hash, sorted; without one all rows stay.
    """
    fs, path = _fs(spark, store)
    sizes = {n: fs.getContentSummary(path.suffix(f"/{n}")).getLength() for n in folders(spark, store)}
    levels: dict[int, list[str]] = {}
    for name, size in sizes.items():
        levels.setdefault(_level(size), []).append(name)
    taken: list[str] = []
    for level in sorted(levels):
        if len(levels[level]) + bool(taken) < fan:
            break
        taken += levels[level]
    if not taken:
        return False
    number, held = _manifest(spark, store)
    # what the folding before this one replaced, and what killed ones left
    for name in list_dirs(spark, store):
        if name in held["folded"] or (name.startswith("merged=") and name not in held["merged"]):
            fs.delete(path.suffix(f"/{name}"), True)
    rows = spark.read.option("mergeSchema", True).parquet(*[f"{store}/{n}" for n in taken])
    files, name = -(-sum(sizes[n] for n in taken) // FILE), f"merged={uuid.uuid4().hex}"
    if key:
        rows = newest(rows, key, order).repartition(files, key).sortWithinPartitions(key)
    else:
        rows = rows.repartition(files)
    rows.write.parquet(f"{store}/{name}")
    told = {"merged": [n for n in held["merged"] if n not in taken] + [name], "folded": taken}
    line = spark.createDataFrame([(json.dumps(told),)], "value string").coalesce(1)
    line.write.mode("overwrite").text(f"{store}/manifest={number + 1:012d}")
    for old in list_dirs(spark, store):
        if old.startswith("manifest=") and int(old.removeprefix("manifest=")) < number:
            fs.delete(path.suffix(f"/{old}"), True)
    return True
