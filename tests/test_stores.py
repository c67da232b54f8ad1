"""Stores fold without changing their rows, whatever is killed or run again, and stay few folders."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from lodestrata.plans.texts import dictionary
from lodestrata.sources import stores, tables
from lodestrata.streaming import debates as streaming


def held(spark, store, key="id"):
    return sorted((tuple(r) for r in stores.read(spark, store, key).select("id", "v", "stamp").collect()), key=repr)


def batch(spark, b):
    return spark.range(12).filter(f"id % {b % 5 + 1} = 0").select(F.when(F.col("id") > 0, F.col("id")).alias("id"), F.lit(f"v{b}").alias("v"), F.lit(b).alias("stamp"))


def test_fifty_batches(spark, tmp_path):
    store, want = f"{tmp_path}/s", {}
    for b in range(50):
        stores.append(batch(spark, b), store)
        want |= {r.id: (r.id, r.v, r.stamp) for r in batch(spark, b).collect()}
        stores.compact(spark, store, "id", fan=4)
        assert len(stores.folders(spark, store)) < 8
    assert held(spark, store) == sorted(want.values(), key=repr)
    assert len(tables.list_dirs(spark, store)) < 16


def test_no_key_keeps_all(spark, tmp_path):
    store = f"{tmp_path}/s"
    for b in range(20):
        stores.append(batch(spark, b), store)
        stores.compact(spark, store, fan=4)
    got = stores.read(spark, store).groupBy("stamp").count().collect()
    assert {r["stamp"]: r["count"] for r in got} == {b: batch(spark, b).count() for b in range(20)}


@pytest.mark.parametrize("at", ["merged", "manifest"])
def test_killed(spark, tmp_path, monkeypatch, at):
    store = f"{tmp_path}/s"
    for b in range(6):
        stores.append(batch(spark, b), store)
    before, names = held(spark, store), stores.folders(spark, store)
    every = sorted(map(tuple, stores.read(spark, store).collect()), key=repr)
    stores.compact(spark, store, "id", fan=3)
    # as if the folding had ended before its manifest, or amid it
    manifest = next(n for n in os.listdir(store) if n.startswith("manifest="))
    shutil.rmtree(f"{store}/{manifest}") if at == "merged" else os.remove(f"{store}/{manifest}/_SUCCESS")
    assert stores.folders(spark, store) == names and held(spark, store) == before
    assert sorted(map(tuple, stores.read(spark, store).collect()), key=repr) == every
    assert stores.compact(spark, store, "id", fan=3) and held(spark, store) == before
    assert sum(n.startswith("merged=") for n in os.listdir(store)) == 1
    # a batch that comes again, and one that was cut short
    stores.append(batch(spark, 2), store)
    stores.append(batch(spark, 9), store, "torn")
    os.remove(next(f"{store}/{n}/_SUCCESS" for n in os.listdir(store) if n.startswith("batch=torn")))
    assert held(spark, store) == before


def test_label_store_folds(spark, tmp_path):
    schema, path = "id string, label string", f"{tmp_path}/labels"
    tables.reset_label_store(spark, path, schema)
    for b in range(2 * stores.FAN + 3):
        tables.append_or_create(spark.createDataFrame([(str(b), "x"), ("same", "y")], schema), path)
    rows = tables.read_label_store(spark, path, schema)
    assert rows.count() == 2 * (2 * stores.FAN + 3) and rows.distinct().count() == 2 * stores.FAN + 4
    assert len(stores.folders(spark, path)) < stores.FAN


def test_stream_folds(spark, tmp_path, monkeypatch):
    """More batches than a level holds; the base goes with them, and the same files by another checkpoint change nothing."""
    monkeypatch.setattr(stores.compact, "__defaults__", (None, "stamp", 3))
    root, out, words = tmp_path / "in", f"{tmp_path}/out", dictionary(spark)
    root.mkdir()
    models = lambda rows: rows.withColumn("n", F.length("text"))
    for day in range(1, 6):
        path = root / f"debates2020-01-{day:02d}a.xml"
        path.write_text(f'<publicwhip><speech id="all"><p>the {day}</p></speech><speech id="d{day}"><p>la {day}</p></speech></publicwhip>')
        os.utime(path, (1000 + day, 1000 + day))
        streaming.update(spark, str(root), words, out, f"{out}/check", models)
    want = {"all": "the 5"} | {f"d{day}": f"la {day}" for day in range(1, 6)}
    said = lambda: {r.speech_id: r.speech for r in streaming.read_store(spark, f"{out}/debates").collect()}
    assert said() == want
    folded = f"{out}/debates/generation=000001"
    assert len(stores.folders(spark, folded)) < 3 and any(n.startswith("merged=") for n in stores.folders(spark, folded))
    streaming.update(spark, str(root), words, out, f"{out}/other", models)
    assert said() == want
    streaming.full_rebuild(spark, str(root), words, out, models)
    assert said() == want and streaming._generation(spark, f"{out}/debates") == 2
    streaming.full_rebuild(spark, str(root), words, out, models)
    assert said() == want and tables.list_dirs(spark, f"{out}/debates") == ["generation=000002", "generation=000003"]
