"""Groups of near-copies: wide SimHash fingerprints nominate pairs, the exact Jaccard of their word shingles decides.

A text is the set of its ``SIZE``-word shingles; two texts link where the sets' Jaccard
similarity is 0.8 or more.  At 0.8 a SimHash bit differs with a chance of about 0.15
(0.19 for a handful of shingles), of unrelated texts of 0.5, so of 256 bits a radius of 70
loses next to no pair and nominates next to no stranger.  Fingerprints are compared in
tiles; a tile holds texts that agree on all ``ROWS`` minima of one of ``BANDS`` groups of
hash functions over their shingles, which two texts of similarity 0.8 do on some band
with a chance of 1 - (1 - 0.8^ROWS)^BANDS, all but three in a million.  So the work
follows the number of texts and the sizes of their groups.  What is nominated is dealt out by
candidate group, in parts of bounded size, with the sets themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _common as common
from .components import components
from .simhash import _spanning

SIZE = 5
#: Differing bits of 256 up to which a pair is nominated.
RADIUS = 70
LANES = 4
BANDS, ROWS = 24, 4
#: Fingerprints in a tile; texts, and shingles, in a part of a candidate group.
TILE = 1024
#: Fingerprints that meet in one task; larger buckets go out as pairs of parts.
BUCKET = 8 * TILE
PART_SHINGLES = 1 << 21


def text_key(text_col: str = "text") -> Column:
    return F.xxhash64(common.text_or_empty(text_col).cast("binary"))


def shingles(body: bytes, size: int = SIZE) -> np.ndarray:
    """The sorted distinct hashes of the ``size``-word shingles of a lower-cased text; a shorter text is one shingle."""
    words = body.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined, h64 = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([h64(joined)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - size + 1]
    return np.unique(np.array([h64(joined[a:b]) for a, b in zip(starts.tolist(), (ends[size - 1 :] - 1).tolist(), strict=True)], np.uint64))


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """The SimHash of a set of shingle hashes, in four lanes of 64 bits."""
    out = np.zeros(LANES, np.uint64)
    for lane in range(LANES if len(hashes) else 0):
        counts = np.zeros(64, np.int64)
        for at in range(0, len(hashes), 16384):
            h = hashes[at : at + 16384] + np.uint64((0x9E3779B97F4A7C15 * (lane + 1)) % (1 << 64))
            h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            h ^= h >> np.uint64(31)
            counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
        out[lane] = np.packbits(2 * counts > len(hashes)).view(np.uint64)[0]
    return out


def bands(hashes: np.ndarray) -> np.ndarray:
    """A key for each band: a hash of the minima of ``ROWS`` hash functions over the set."""
    rng = np.random.default_rng(17)
    odd, flip = rng.integers(0, 1 << 63, (2, BANDS * ROWS), np.uint64)
    least = np.full(BANDS * ROWS, (1 << 64) - 1, np.uint64)
    for at in range(0, len(hashes), 2048):
        part = (hashes[at : at + 2048, None] ^ flip) * (odd * np.uint64(2) + np.uint64(1))
        least = np.minimum(least, (part ^ (part >> np.uint64(32))).min(axis=0))
    out = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for row in least.reshape(BANDS, ROWS).T:
        out = (out ^ row) * np.uint64(0xBF58476D1CE4E5B9)
        out ^= out >> np.uint64(31)
    return out.view(np.int64)


def nominated(fp: np.ndarray, n: np.ndarray, fp2: np.ndarray, n2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within the radius whose sizes allow a Jaccard of 0.8."""
    near = np.zeros((len(fp), len(fp2)), np.uint16)
    for lane in range(LANES):
        near += np.bitwise_count(fp[:, None, lane] ^ fp2[None, :, lane])
    sizes = (5 * n[:, None] >= 4 * n2[None, :]) & (5 * n2[None, :] >= 4 * n[:, None])
    return np.nonzero((near <= RADIUS) & sizes)


def bucket_pairs(tile: np.ndarray, own: np.ndarray, n: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of one tile that are nominated; rows come ordered by tile, then bit count.

    In a tile of two parts (``own``) only texts of different parts are looked at."""
    pop = np.bitwise_count(fp).sum(axis=1, dtype=np.int64)
    last = np.append(np.flatnonzero(tile[1:] != tile[:-1]), len(tile) - 1)
    size = np.diff(np.append(-1, last))
    first = last - size + 1
    mixed = np.repeat(np.maximum.reduceat(own, first) != np.minimum.reduceat(own, first), size)
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    # small tiles: neighbours at distance d, all tiles at once, while a tile is that long
    to_end = np.repeat(last, size) - np.arange(len(tile))
    live, d = np.flatnonzero(np.repeat(size <= 64, size) & (to_end > 0)), 1
    while len(live):
        live = live[pop[live + d] - pop[live] <= RADIUS]
        sizes = (5 * n[live] >= 4 * n[live + d]) & (5 * n[live + d] >= 4 * n[live]) & (~mixed[live] | (own[live] != own[live + d]))
        at = live[sizes]
        at = at[np.bitwise_count(fp[at] ^ fp[at + d]).sum(axis=1) <= RADIUS]
        left.append(at)
        right.append(at + d)
        d += 1
        live = live[to_end[live] >= d]
    for a, m in zip(first[size > 64].tolist(), size[size > 64].tolist(), strict=True):
        for x in range(a, a + m, TILE):
            xe = min(x + TILE, a + m)
            for y in range(x, a + m, TILE):
                if pop[y] - pop[xe - 1] > RADIUS:
                    break
                ye = min(y + TILE, a + m)
                i, j = nominated(fp[x:xe], n[x:xe], fp[y:ye], n[y:ye])
                i, j = i + x, j + y
                ok = (i < j) & (~mixed[i] | (own[i] != own[j]))
                left.append(i[ok])
                right.append(j[ok])
    return np.concatenate(left), np.concatenate(right)


def _lanes(table: pa.Table) -> np.ndarray:
    return np.stack([table[f"f{i}"].to_numpy() for i in range(LANES)], 1).view(np.uint64)


def _star(keys: np.ndarray, root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(u, v): each key that is not the smallest of its root's, and that smallest one."""
    least = keys.copy()
    np.minimum.at(least, root, keys)
    linked = np.flatnonzero(least[root] != keys)
    return keys[linked], least[root[linked]]


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    size = 0

    def solve(table: pa.Table) -> pa.RecordBatch:
        keys = table["key"].to_numpy()
        i, j = bucket_pairs(table["tile"].to_numpy(), table["own"].to_numpy(), table["n"].to_numpy(), _lanes(table))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in _star(keys, _spanning(len(keys), i, j))], ["u", "v"])

    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= 4 * BUCKET:
            table = pa.Table.from_batches(held).combine_chunks()
            # a batch may end inside a tile: what follows the last whole tile waits
            whole = int(np.searchsorted(table["tile"].to_numpy(), table["tile"][-1].as_py()))
            if whole:
                yield solve(table.slice(0, whole))
            held, size = table.slice(whole).to_batches(), table.num_rows - whole
    if size:
        yield solve(pa.Table.from_batches(held).combine_chunks())


def _in_parts(df: DataFrame, group: str) -> DataFrame:
    """Deal each group's rows into ``parts`` (``own``), and a row for each pair of parts (``tile``) that one takes part in."""
    dealt = df.withColumn("own", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    each = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return each.withColumn("tile", F.xxhash64(group, F.least("own", "other"), F.greatest("own", "other"))).drop("other")


def candidates(nodes: DataFrame) -> DataFrame:
    """(u, v): links that join all nominated pairs of ``nodes`` (key, n, f0..f3, bands)."""
    lanes = [f"f{i}" for i in range(LANES)]
    rows = nodes.select("key", F.explode("bands").alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BUCKET).cast("int").alias("parts"), F.count(F.lit(1)).alias("size"))
    met = rows.join(sizes.filter("size > 1").drop("size"), "bucket").join(nodes.select("key", "n", *lanes), "key")
    pop = sum(F.bit_count(x) for x in lanes)
    tiles = _in_parts(met, "bucket").select("tile", "own", "key", "n", *lanes, pop.alias("pop"))
    return tiles.repartition("tile").sortWithinPartitions("tile", "pop", "key").drop("pop").mapInArrow(common.thrifty(_meet), "u long, v long").distinct()


def confirmed(sets: list[np.ndarray], n: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Each text's root after joining those of the pairs (i, j) whose Jaccard is 0.8 or more.

    The text with most open pairs goes first; pairs that are joined by then need no look.
    """
    root = np.arange(len(sets))
    while len(i):
        hub = int(np.bincount(np.concatenate([i, j])).argmax())
        at = (i == hub) | (j == hub)
        others = np.unique(np.concatenate([i[at], j[at]]))
        others = others[others != hub]
        both = np.zeros(len(others), np.int64)
        if n[hub]:
            own = sets[hub]
            joined = np.concatenate([sets[o] for o in others])
            found = own[np.minimum(np.searchsorted(own, joined), len(own) - 1)] == joined
            both = np.add.reduceat(found, np.cumsum(n[others]) - n[others], dtype=np.int64)
        # two wordless texts are alike; other empty sets aren't nominated
        same = others[5 * both >= 4 * (n[hub] + n[others] - both)]
        near = np.unique(root[np.append(same, hub)])
        root[np.isin(root, near)] = near[0]
        open_ = ~at & (root[i] != root[j])
        i, j = i[open_], j[open_]
    return root


def _confirm(table: pa.Table) -> pa.Table:
    keys = table["key"].to_numpy()
    part, n, fp = table["own"].to_numpy(), table["n"].to_numpy(), _lanes(table)
    sets = [np.frombuffer(x, np.uint64) for x in table["hashes"].to_pylist()]
    left, right = [], []
    here, there = np.flatnonzero(part == part.min()), np.flatnonzero(part == part.max())
    for x in range(0, len(here), TILE):
        for y in range(0, len(there), TILE):
            xs, ys = here[x : x + TILE], there[y : y + TILE]
            i, j = nominated(fp[xs], n[xs], fp[ys], n[ys])
            left.append(xs[i])
            right.append(ys[j])
    i, j = np.concatenate(left), np.concatenate(right)
    once = (i < j) | (part[i] != part[j])
    u, v = _star(keys, confirmed(sets, n, i[once], j[once]))
    return pa.table({"u": u, "v": v})


def near_groups(docs: DataFrame, size: int = SIZE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, id, group): each distinct text by its hash, its smallest id (null only if all are) and its group.

    Texts of a group reach one another over pairs whose ``size``-word shingles have a
    Jaccard similarity of 0.8 or more; equal texts are one.  Null text: empty; wordless
    texts are alike.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_key(text_col).alias("key"), common.text_or_empty(text_col).cast("binary").alias("body"))
    lanes = [f"f{i}" for i in range(LANES)]

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.sliced(batches):
            n, fps, keys = [], [], []
            for body in b[2].to_pylist():
                h = shingles(body, size)
                n.append(len(h))
                fps.append(wide_fingerprint(h))
                keys.append(bands(h))
            fp = np.array(fps, np.uint64).reshape(-1, LANES).view(np.int64)
            filed = pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate([*keys, np.empty(0, np.int64)])), BANDS).cast(pa.list_(pa.int64()))
            columns = [b[0], b[1], pa.array(n, pa.int64()), *[pa.array(fp[:, x]) for x in range(LANES)], filed]
            yield pa.RecordBatch.from_arrays(columns, ["id", "key", "n", *lanes, "bands"])

    told = rows.mapInArrow(common.thrifty(features), "id long, key long, n long, " + ", ".join(f"{x} long" for x in lanes) + ", bands array<long>")
    nodes = common.cut(told.groupBy("key").agg(F.min("id").alias("id"), *[F.first(c).alias(c) for c in ("n", *lanes, "bands")]))
    found = components(candidates(nodes.select("key", "n", *lanes, "bands"))).select(F.col("node").alias("key"), F.col("component").alias("near"))
    # a group's first text is not among its nodes
    members = found.unionByName(found.select(F.col("near").alias("key"), "near")).distinct()
    held = common.cut(nodes.drop("id", "bands").join(members, "key"))
    sizes = held.groupBy("near").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / TILE), F.ceil(F.sum("n") / PART_SHINGLES)).cast("int").alias("parts")
    )
    held = common.cut(held.join(sizes, "near"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in common.sliced(batches):
            sets = pa.array([shingles(x, size).tobytes() for x in b.column("body").to_pylist()], pa.binary())
            names = ["key", "near", "parts", "n", *lanes]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names], sets], [*names, "hashes"])

    # copies meet map by map before their text travels
    texts = rows.groupBy("key").agg(F.first("body").alias("body")).join(held, "key")
    kinds = "key long, near long, parts int, n long, " + ", ".join(f"{x} long" for x in lanes) + ", hashes binary"
    sets = _in_parts(texts.mapInArrow(common.thrifty(hashed), kinds), "near")
    links = sets.drop("near", "parts").groupBy("tile").applyInArrow(_confirm, "u long, v long")
    named = components(links)
    return nodes.join(named, nodes["key"] == named["node"], "left").select("key", "id", F.coalesce("component", "key").alias("group"))
