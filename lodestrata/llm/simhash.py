"""SimHash fingerprints of word shingles and exact linking within a Hamming radius.

Linking: 64 bits are split into ``radius + 2`` blocks; fingerprints within the radius
agree on at least two blocks, so every link lies inside the group of some pair of
blocks.  Groups are compared exactly, tile against tile, with numpy exclusive-or and
bit counts; tiles are ordered by population count, and tile pairs whose counts differ
by more than the radius are skipped.  A group too large for one task is dealt out as
tile pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _common as common
from .components import components

TILE = 2048
#: Groups with more fingerprints than this are dealt out as pairs of tiles.
CROWDED = 16 * TILE


def fingerprint(body: bytes, size: int = 3, seed: int = 42) -> int:
    """SimHash of the ``size``-word shingles of a lower-cased text; repeats count; no word: zero."""
    words = body.lower().split()
    if not words:
        return 0
    h64 = xxhash.xxh64_intdigest
    if len(words) <= size:
        hashes = [h64(b" ".join(words), seed)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[:-1]])
        hashes = [h64(joined[a:b], seed) for a, b in zip(starts[: len(words) - size + 1].tolist(), (ends[size - 1 :] - 1).tolist(), strict=True)]
    h = np.array(hashes, np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(h), 65536):
        bits = np.unpackbits(h[at : at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): one row per document; fp is the 64-bit fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(x, size) for x in batch[1].to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch[0], pa.array(fps, pa.int64())], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), common.text_or_empty(text_col).cast("binary").alias("body"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def tile_links(fp: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) of equal ``group`` within ``radius`` bits; rows come ordered by group, then bit count."""
    pop = np.bitwise_count(fp).astype(np.int64)
    left, right = [], []
    # Small groups: neighbours at distance d, all groups at once, while a group is that long.
    last = np.append(np.flatnonzero(group[1:] != group[:-1]), len(group) - 1)
    size = np.diff(np.append(-1, last))
    first = last - size + 1
    small = np.repeat(size <= 64, size)
    to_end = np.repeat(last, size) - np.arange(len(fp))
    live, d = np.flatnonzero(small & (to_end > 0)), 1
    while len(live):
        near = pop[live + d] - pop[live] <= radius
        at = live[near]
        hit = at[np.bitwise_count(fp[at] ^ fp[at + d]) <= radius]
        left.append(hit)
        right.append(hit + d)
        d += 1
        live = live[near & (to_end[live] >= d)]
    for a, n in zip(first[size > 64].tolist(), size[size > 64].tolist(), strict=True):
        for x in range(a, a + n, TILE):
            xe = min(x + TILE, a + n)
            for y in range(x, a + n, TILE):
                if pop[y] - pop[xe - 1] > radius:
                    break
                i, j = np.nonzero(np.bitwise_count(fp[x:xe, None] ^ fp[None, y : min(y + TILE, a + n)]) <= radius)
                i, j = i + x, j + y
                left.append(i[i < j])
                right.append(j[i < j])
    none = np.empty(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _spanning(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Each element's root after joining the pairs: links as a star instead of all pairs."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def solve() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            key, fp = table["key"].to_numpy(), table["fp"].to_numpy().view(np.uint64)
            i, j = tile_links(fp, key, radius)
            root = _spanning(len(fp), i, j)
            linked = np.flatnonzero(root != np.arange(len(fp)))
            signed = fp.view(np.int64)
            pairs = np.unique(np.stack([signed[linked], signed[root[linked]]], 1), axis=0) if len(linked) else np.empty((0, 2), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        for batch in batches:
            # a batch may end inside a group: what follows the last whole group waits
            held.append(batch)
            size += batch.num_rows
            if size >= 4 * CROWDED:
                table = pa.Table.from_batches(held).combine_chunks()
                key = table["key"].to_numpy()
                whole = int(np.searchsorted(key, key[-1], side="left"))
                if whole:
                    held = table.slice(0, whole).to_batches()
                    yield solve()
                    held = table.slice(whole).to_batches()
                    size = table.num_rows - whole
        if size:
            yield solve()

    return run


def links_within(fps: DataFrame, radius: int = 2) -> DataFrame:
    """(a, b): links between distinct fingerprints (``fps``: column fp), enough to join all that lie within ``radius``."""
    n_blocks = radius + 2
    edges = [round(64 * i / n_blocks) for i in range(n_blocks + 1)]
    fp = F.col("fp")

    def block(i: int):
        width = edges[i + 1] - edges[i]
        return F.shiftrightunsigned(fp, edges[i]).bitwiseAND(F.lit((1 << width) - 1)) if width < 64 else fp

    keys = F.array(
        *[
            F.shiftleft(F.lit(n).cast("long"), 59).bitwiseXOR(F.shiftleft(block(i), 30).bitwiseXOR(block(j)))
            if max(edges[i + 1] - edges[i], edges[j + 1] - edges[j]) <= 29
            else F.xxhash64(F.lit(n), block(i), block(j))
            for n, (i, j) in enumerate(combinations(range(n_blocks), 2))
        ]
    )
    rows = fps.select("fp", F.bit_count("fp").alias("pop"), F.explode(keys).alias("key"))
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    crowds = common.cut(sizes.filter(F.col("n") > CROWDED))
    compare = _compare(radius)
    plain = rows if crowds.isEmpty() else rows.join(crowds, "key", "left_anti")
    found = plain.repartition("key").sortWithinPartitions("key", "pop", "fp").select("key", "fp").mapInArrow(compare, "a long, b long")
    if not crowds.isEmpty():
        # One row per tile pair (x <= y): a tile is a bit count and a share of it, and meets counts up to the radius apart.
        tiles = rows.join(crowds, "key").withColumn("parts", F.ceil(F.col("n") / CROWDED).cast("int"))
        tiles = tiles.withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        own = tiles.select("key", "fp", "pop", F.col("pop").alias("x"), F.explode(F.sequence(F.lit(0), F.lit(radius))).alias("up"), "part", "parts")
        low = own.select("key", "fp", "pop", "x", (F.col("x") + F.col("up")).alias("y"), "part", "parts")
        high = own.filter("up > 0").select("key", "fp", "pop", (F.col("x") - F.col("up")).alias("x"), F.col("pop").alias("y"), "part", "parts")
        both = low.unionByName(high)
        pairs = both.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        pairs = pairs.withColumn("tile", F.xxhash64("key", "x", "y", F.least("part", "other"), F.greatest("part", "other")))
        hot = pairs.select(F.col("tile").alias("key"), "pop", "fp").distinct()
        found = found.unionByName(hot.repartition("key").sortWithinPartitions("key", "pop", "fp").select("key", "fp").mapInArrow(compare, "a long, b long"))
    return found


def near_duplicates(docs: DataFrame, radius: int = 2, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Group documents whose fingerprints reach one another over links of at most ``radius`` differing bits.

    Returns doc_id, fp (signed long), component_id (smallest doc_id of the group), one
    row per input row.  Null or wordless text has fingerprint zero and links like any
    other; null ids have a group but never name it (a group of null ids only has a
    null component_id); repeated rows share a group; an empty table gives no rows;
    other columns are ignored.
    """
    rows = common.cut(fingerprints(docs, size, id_col, text_col))
    # Equal fingerprints are one node, so copies never make links.
    nodes = common.cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(links_within(nodes.select("fp"), radius).select(F.col("a").alias("u"), F.col("b").alias("v")))
    group = F.coalesce("component", "fp").alias("group")
    joined = nodes.join(found, nodes["fp"] == found["node"], "left").select("fp", "least", group)
    named = joined.groupBy("group").agg(F.min("least").alias("component_id"))
    return rows.join(joined.select("fp", "group").join(named, "group"), "fp").select("doc_id", "fp", "component_id")
