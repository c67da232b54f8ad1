"""Words go through a lattice in large groups, whatever the sizes of the batches that bring them."""

import pyarrow as pa
from lodestrata.llm import lattice


def batches(*sizes):
    at = 0
    for n in sizes:
        yield pa.RecordBatch.from_pydict({"word": pa.array([b"%d" % i for i in range(at, at + n)], pa.binary()), "c": pa.array(range(at, at + n), pa.int64())})
        at += n


def test_batches_are_gathered():
    got = list(lattice._gathered(batches(4, 0, 3, 5, 1, 2), 7))
    assert [b.num_rows for b in got] == [7, 8]
    assert [x for b in got for x in b["c"].to_pylist()] == list(range(15))
    assert [x for b in got for x in b["word"].to_pylist()] == [b"%d" % i for i in range(15)]
    assert list(lattice._gathered(iter([]), 7)) == [] and list(lattice._gathered(batches(0), 7)) == []


def test_a_group_holds_several_arrow_batches():
    assert lattice.GATHER >= 5 * 10_000
