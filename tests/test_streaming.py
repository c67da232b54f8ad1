"""Stores of rebuilds and stream batches: a rebuild replaces, batches add, replays change nothing, a broken rebuild doesn't count."""

import os
import shutil

from lodestrata.plans.texts import dictionary
from lodestrata.streaming import debates as streaming
from pyspark.sql import functions as F


def put(folder, day, time, **speeches):
    path = folder / f"debates2020-01-{day:02d}a.xml"
    path.write_text("<publicwhip>" + "".join(f'<speech id="{k}"><p>{v}</p></speech>' for k, v in speeches.items()) + "</publicwhip>")
    os.utime(path, (time, time))


def test_rebuild_batch_replay_rebuild(spark, tmp_path):
    root, out, words = tmp_path / "in", f"{tmp_path}/out", dictionary(spark)
    root.mkdir()

    def said(store="debates", key="speech_id", value="speech"):
        rows = streaming.read_store(spark, f"{out}/{store}")
        return {r[key]: r[value] for r in rows.collect()}

    def update(check="check", **how):
        models = lambda rows: rows.withColumn("n", F.length("text"))
        streaming.update(spark, str(root), words, out, f"{out}/{check}", models, **how)

    put(root, 1, 1000, old1="the one", old2="the two")
    update()  # the stores are empty: all files
    assert said() == {"old1": "the one", "old2": "the two"} and said("ml_labels", "id", "n") == {"old1": 7, "old2": 7}
    put(root, 2, 2000, new1="the three", old2="the two again")
    update()
    want = {"old1": "the one", "old2": "the two again", "new1": "the three"}
    assert said() == want
    # the same files again, by the same checkpoint set back and by another one
    shutil.rmtree(f"{out}/check")
    update()
    update("other")
    assert said() == want and set(said("keyword_labels", "id", "text")) <= set(want)
    # an older file that comes late doesn't overwrite what a newer one said
    put(root, 3, 1500, old2="late", late="the late")
    update()
    assert said() == want | {"late": "the late"}
    for path in root.iterdir():
        path.unlink()
    put(root, 4, 4000, only="the only")
    update(full=True)
    assert said() == {"only": "the only"} == said("ml_labels", "id", "text")
    put(root, 5, 5000, more="the more")
    update()
    assert said() == {"only": "the only", "more": "the more"}
    # a rebuild that was cut short is not read
    shutil.copytree(f"{out}/debates/generation=000002", f"{out}/debates/generation=000003")
    os.remove(f"{out}/debates/generation=000003/batch=base/_SUCCESS")
    assert said() == {"only": "the only", "more": "the more"}


def test_no_store(spark, tmp_path):
    assert streaming.read_store(spark, f"{tmp_path}/debates") is None
