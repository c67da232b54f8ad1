"""What a worker has freed goes back to the system, and steps of expressions start no worker: both share an executor's limit."""

import re
from pathlib import Path

import pyarrow as pa
import pytest
from lodestrata.llm import _common as common
from lodestrata.llm import mixing


def resident_mb():
    return int(re.search(r"RssAnon:\s+(\d+)", Path("/proc/self/status").read_text())[1]) / 1024


def scattered():
    """200 MB in small pieces; what is left of them when the rest is freed lies on the last pages."""
    rows = [bytes(60_000) for _ in range(3_500)]
    return rows[-1:]


def test_freed_memory_goes_back():
    def step(batches):
        for batch in batches:
            held.extend(scattered())
            yield batch

    held = []
    batch = pa.RecordBatch.from_pydict({"x": [1, 2]})
    list(common.thrifty(step)(iter([])))
    before = resident_mb()
    list(step(iter([batch])))
    kept = resident_mb()
    assert list(common.thrifty(step)(iter([batch]))) == [batch]
    assert kept - before > 150 and resident_mb() - before < 50


def test_after_each_pair(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    table = pa.table({"x": [1]})
    assert common.thrifty_pair(lambda a, b: pa.concat_tables([a, b]))(table, table).num_rows == 2
    with pytest.raises(ZeroDivisionError):
        common.thrifty_pair(lambda a, b: 1 / 0)(table, table)
    assert len(calls) == 2


def test_mixing_starts_no_python_worker(spark, monkeypatch):
    rows = [(i, "a few words " * (i % 4), f"s{i % 5}" if i % 7 else None) for i in range(60)]
    docs = spark.createDataFrame(pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows], "source": [r[2] for r in rows]}))
    want = sorted(map(tuple, mixing.mixing_report(docs).collect()))
    monkeypatch.setattr(spark.sparkContext, "pythonExec", "/nonexistent/python")
    assert sorted(map(tuple, mixing.mixing_report(docs).collect())) == want and len(want) == 60
