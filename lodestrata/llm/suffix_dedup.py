"""Exact-substring dedup: drop bytes covered by a string that an earlier document also holds.

Plan (``width`` bytes make a repeat):

1. Equal texts are found by hash; only one text of each goes on.
2. Every window of ``width`` bytes belongs to the smallest k-gram hash in it (its
   minimizer).  Equal windows have equal minimizers, so a window whose minimizer
   occurs in one document only can't repeat.  This is lossless.
3. The remaining windows travel as runs ("pieces") to the shard of their minimizer;
   a block of documents sends each distinct piece once.  A shard concatenates its
   distinct pieces, builds their suffix array by induced sorting and the permuted
   longest-common-prefix array, and so learns the smallest document of every class of
   equal windows.  (A piece alone with its minimizer shares windows with no other.)
4. A window is covered if its class has a smaller document.  The shards answer the
   blocks, which find the pieces in their documents again and drop the covered bytes.

Texts move between steps in blocks of documents (hash of id and text), so no task holds
more than a block, a shard or one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import _common as common
from .induced import permuted_lcp, suffix_array

GRAM = 20
BLOCK_BYTES = 2 << 20
SHARD_BYTES = 1 << 20
#: Documents are joined up to this size for their windows to be computed at once (a longer one by itself).
JOIN_BYTES = 1 << 18
#: Windows in a piece at most; longer runs go on as several pieces.
RUN = 512
#: A minimizer whose pieces take more bytes than this sends its windows one by one, each to the shard of its own hash.
CROWDED = 2 << 20
#: Blocks that one task handles one after the other.
BLOCKS_A_TASK = 64
NO_ID = (1 << 63) - 1


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each k-gram of ``data``, built by doubling."""
    power = data.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    power ^= power >> np.uint64(29)
    span, out, at, left = 1, None, 0, k
    n = len(data) - k + 1
    while left:
        if left & 1:
            part = power[at : at + n]
            out = part.copy() if out is None else out * np.uint64(0xBF58476D1CE4E5B9) + part
            at += span
        left >>= 1
        if left:
            power = power[:-span] * np.uint64(0x94D049BB133111EB + 2 * span) + power[span:]
            span *= 2
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(31)
    return out


def window_minima(data: np.ndarray, width: int, k: int) -> np.ndarray:
    """The minimizer of each window of ``width`` bytes, as a 40-bit number."""
    m, w, span = gram_hashes(data, k) >> np.uint64(24), width - k + 1, 1
    while span * 2 <= w:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    return (np.minimum(m[: len(m) - (w - span)], m[w - span :]) if span < w else m).astype(np.int64)


def _runs(minima: np.ndarray) -> np.ndarray:
    """Where a run of one minimizer starts; long runs start anew every RUN windows."""
    new = np.ones(len(minima), bool)
    new[1:] = minima[1:] != minima[:-1]
    at = np.arange(len(minima))
    since = at - np.maximum.accumulate(np.where(new, at, 0))
    return np.flatnonzero(new | ((since % RUN == 0) & (since > 0)))


def _batched(texts: list[bytes], width: int):
    """Documents of at least ``width`` bytes, joined up to JOIN_BYTES at a time: (their indices, bytes, starts, lengths)."""
    group, size = [], 0
    order = [i for i in range(len(texts)) if len(texts[i]) >= width]
    for n, i in enumerate(order):
        group.append(i)
        size += len(texts[i]) + 1
        if size >= JOIN_BYTES or n == len(order) - 1:
            data = np.frombuffer(b"\xff".join([texts[i] for i in group]), np.uint8)
            lengths = np.array([len(texts[i]) for i in group])
            starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
            yield group, data, starts, lengths
            group, size = [], 0


def _windows(data, starts, lengths, width, k):
    minima = window_minima(data, width, k)
    owner = np.repeat(np.arange(len(starts)), lengths + 1)[: len(minima)]
    place = np.arange(len(minima)) - starts[owner]
    return minima, owner, place, place + width <= lengths[owner]


def _columns(table: pa.Table, *names: str) -> list[list]:
    return [table[n].to_pylist() for n in names]


def _keep_first(table: pa.Table, first: set) -> pa.Table:
    ids, keys = _columns(table, "doc_id", "tkey")
    return table.filter(pa.array([p in first for p in zip(ids, keys, strict=True)], pa.bool_()))


def blocks(docs: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """(block, doc_id, tkey, body, kept_...) and the number of blocks: the texts as bytes; a null id counts as larger than any other."""
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"),
        common.text_or_empty(text_col).cast("binary").alias("body"),
        *[F.col(c).alias(f"kept_{c}") for c in keep],
    )
    total = rows.agg(F.sum(F.length("body") + 64)).first()[0] or 0
    n = max(1, round(total / BLOCK_BYTES))
    tkey = F.xxhash64("body")
    block = F.pmod(F.xxhash64("doc_id", tkey), F.lit(n)).cast("int")
    return rows.select(block.alias("block"), "doc_id", tkey.alias("tkey"), "body", *[f"kept_{c}" for c in keep]), n


def _by_block(df: DataFrame, n: int):
    """The groups of one block each, in as many partitions as the blocks ask for."""
    tasks = -(-n // BLOCKS_A_TASK)
    return (df.repartition(tasks, "block") if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df).groupBy("block")


def first_texts(rows: DataFrame) -> DataFrame:
    """(block, doc_id, tkey) of the smallest document of each distinct text."""
    by = rows.groupBy(F.sha2("body", 256).alias("sha")).agg(F.min(F.struct("doc_id", "block", "tkey")).alias("one"))
    return by.select("one.block", "one.doc_id", "one.tkey")


def _merged(m: np.ndarray, *sums: np.ndarray) -> list[np.ndarray]:
    """The distinct values of ``m`` in order, and the sums over each."""
    order = np.argsort(m, kind="stable")
    m = m[order]
    starts = np.flatnonzero(np.append(True, m[1:] != m[:-1])) if len(m) else np.empty(0, np.int64)
    return [m[starts], *(np.add.reduceat(x[order], starts) if len(m) else x for x in sums)]


def shared_minima(rows: DataFrame, first: DataFrame, n: int, width: int, k: int, crowded: int) -> DataFrame:
    """(block, m, crowd) for minimizers found in at least two distinct texts, and whether their pieces take very many bytes."""

    def seen(docs: pa.Table, firsts: pa.Table) -> pa.Table:
        docs = _keep_first(docs, set(zip(*_columns(firsts, "doc_id", "tkey"), strict=True)))
        block = docs["block"][0].as_py() if len(docs) else 0
        found = [[np.empty(0, np.int64)] * 3]
        for _, data, starts, lengths in _batched(docs["body"].to_pylist(), width):
            minima, owner, _, valid = _windows(data, starts, lengths, width, k)
            # windows over a border of documents end a run
            at = np.flatnonzero(np.append(True, (minima[1:] != minima[:-1]) | (valid[1:] != valid[:-1])))
            size = np.diff(at, append=len(minima)) + width - 1
            at, size = at[valid[at]], size[valid[at]]
            # one entry a document: 40 bits of minimizer, 23 of its place among the few thousand joined
            each, size = _merged((minima[at] << 23) | owner[at], size)
            found.append(_merged(each >> 23, np.ones(len(each), np.int64), size))
        m, times, size = _merged(*(np.concatenate(x) for x in zip(*found, strict=True)))
        return pa.table({"m": m, "source": (block << 34) | (np.minimum(times, 2) << 32) | np.minimum(size, (1 << 32) - 1)})

    def common_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(b[0].to_numpy(), b[1].to_numpy()) for b in batches]
        if not got:
            return
        m, source = (np.concatenate(x) for x in zip(*got, strict=True))
        del got
        order = np.argsort(m, kind="stable")
        m, source = m[order], source[order]
        _, docs, size = _merged(m, (source >> 32) & 3, source & ((1 << 32) - 1))
        times = np.diff(np.flatnonzero(np.append(True, m[1:] != m[:-1])), append=len(m))
        shared = np.repeat(docs > 1, times)
        yield pa.RecordBatch.from_arrays([(source[shared] >> 34).astype(np.int32), m[shared], np.repeat(size > crowded, times)[shared]], ["block", "m", "crowd"])

    found = _by_block(rows, n).cogroup(_by_block(first, n)).applyInArrow(common.thrifty_pair(seen), "m long, source long")
    # four blocks of BLOCK_BYTES have a few hundred thousand minimizers: as many go to a task
    parts = max(-(-n // 4), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return found.repartition(parts, "m").mapInArrow(common.thrifty(common_ones), "block int, m long, crowd boolean")


def _find_pieces(texts: list[bytes], wanted: np.ndarray, crowd: np.ndarray, width: int, k: int) -> Iterator[tuple[int, int, int, bytes]]:
    """(document's index, minimizer, place, piece) of the runs of windows whose minimizer is in ``wanted`` (sorted).

    Where ``crowd`` is set, windows come singly, with their own hash for the minimizer."""
    if len(wanted) == 0:
        return
    for group, data, starts, lengths in _batched(texts, width):
        minima, owner, place, valid = _windows(data, starts, lengths, width, k)
        # windows over a border of documents get numbers of their own, so that runs end there
        labels = np.where(valid, minima, -1 - owner)
        begin = _runs(labels)
        stop = np.append(begin[1:], len(labels))
        hit = np.minimum(np.searchsorted(wanted, minima[begin]), len(wanted) - 1)
        ok = np.flatnonzero(valid[begin] & (wanted[hit] == minima[begin]))
        raw = data.tobytes()
        b, e, busy = begin[ok], stop[ok], crowd[hit[ok]]
        columns = (np.asarray(group)[owner[b]], minima[b], place[b], b, e, busy)
        for i, m, at, x, y, single in zip(*(c.tolist() for c in columns), strict=True):
            if not single:
                yield i, m, at, raw[x : y + width - 1]
            else:
                for w in range(x, y):
                    piece = raw[w : w + width]
                    yield i, -1 - abs(_hash(piece) >> 1), at + w - x, piece


def _hash(piece: bytes) -> int:
    return xxhash.xxh64_intdigest(piece) - (1 << 63)


def _wanted(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    table = table.filter(pc.is_valid(table["m"]))
    m, crowd = table["m"].to_numpy(), table["crowd"].to_numpy()
    order = np.argsort(m, kind="stable")
    m, crowd = m[order], crowd[order].astype(bool)
    new = np.ones(len(m), bool)
    new[1:] = m[1:] != m[:-1]
    return m[new], crowd[new]


def block_pieces(rows: DataFrame, side: DataFrame, n: int, width: int, k: int) -> DataFrame:
    """(m, h, piece, block, least, most): the distinct pieces of each block and their hashes, with their smallest and largest document.

    ``side``: (block, doc_id, tkey, m, crowd): first texts and shared minimizers."""
    kinds = {"m": pa.int64(), "h": pa.int64(), "piece": pa.binary(), "block": pa.int32(), "least": pa.int64(), "most": pa.int64()}

    def collect(docs: pa.Table, others: pa.Table) -> pa.Table:
        block = docs["block"][0].as_py() if len(docs) else 0
        wanted, crowd = _wanted(others)
        docs = _keep_first(docs, set(zip(*_columns(others, "doc_id", "tkey"), strict=True)))
        ids, texts = _columns(docs, "doc_id", "body")
        found: dict[tuple[int, int], list] = {}
        for i, m, _, piece in _find_pieces(texts, wanted, crowd, width, k):
            key, own = (m, _hash(piece)), ids[i]
            had = found.get(key)
            if had is None:
                found[key] = [piece, own, own]
            elif own < had[1]:
                had[1] = own
            elif own > had[2]:
                had[2] = own
        # a block asks for its crowded minimizers back: an empty piece stands for one
        found |= {(m, 0): [b"", 0, 0] for m in wanted[crowd].tolist()}
        values = found.values()
        columns = [[key[0] for key in found], [key[1] for key in found], [v[0] for v in values], [block] * len(found), [v[1] for v in values], [v[2] for v in values]]
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds.values(), strict=True)], names=list(kinds))

    return _by_block(rows, n).cogroup(_by_block(side, n)).applyInArrow(common.thrifty_pair(collect), "m long, h long, piece binary, block int, least long, most long")


def class_minima(pieces: DataFrame, n: int, width: int) -> DataFrame:
    """(block, m, crowd, piece_hash, offset, length, least): for each block's pieces, the runs of windows of which it
    holds a document above the smallest of their class; crowded minimizers come back as they are."""

    names = ["block", "m", "crowd", "piece_hash", "offset", "length", "least"]

    def induce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                part = batch.slice(at, 8192)
                marks = part.filter(pc.equal(pc.binary_length(part["piece"]), 0))
                if marks.num_rows:
                    empty = [pa.nulls(marks.num_rows, pa.int64())] * 4
                    yield pa.RecordBatch.from_arrays([marks["block"], marks["m"], pa.array([True] * marks.num_rows), *empty], names)
                    part = part.filter(pc.greater(pc.binary_length(part["piece"]), 0))
                if part.num_rows:
                    held.append(part)
                    size += int(pc.binary_length(part["piece"]).to_numpy()[_changes(part["m"], part["h"])].sum())
                if size >= SHARD_BYTES:
                    table = pa.Table.from_batches(held).combine_chunks()
                    # what follows the last whole minimizer waits
                    whole = int(np.searchsorted(table["m"].to_numpy(), table["m"][-1].as_py()))
                    if whole:
                        yield solve(table.slice(0, whole))
                        common.give_back()
                        rest = table.slice(whole)
                        held, size = rest.to_batches(), pc.sum(pc.binary_length(rest["piece"])).as_py()
        if held:
            yield solve(pa.Table.from_batches(held).combine_chunks())

    def solve(rows: pa.Table) -> pa.RecordBatch:
        starts = _changes(rows["m"], rows["h"])
        pieces = rows.select(["m", "h", "piece"]).take(pa.array(starts))
        doc = np.minimum.reduceat(rows["least"].to_numpy(), starts)
        m, sizes = pieces["m"].to_numpy(), pc.binary_length(pieces["piece"]).to_numpy().astype(np.int64) - (width - 1)
        alone = np.ones(len(m), bool)
        alone[1:] &= m[1:] != m[:-1]
        alone[:-1] &= m[1:] != m[:-1]
        own, several = np.flatnonzero(alone), np.flatnonzero(~alone)
        runs = [np.stack([own, np.zeros(len(own), np.int64), sizes[own], doc[own]], 1)]
        if len(several):
            found = _classes(pieces["piece"].take(pa.array(several)).to_pylist(), doc[several], width)
            found[:, 0] = several[found[:, 0]]
            runs.append(found)
        found = np.concatenate(runs)
        found = found[np.lexsort((found[:, 1], found[:, 0]))]
        first = np.searchsorted(found[:, 0], np.arange(len(m) + 1))
        # each asking row with each run of its piece
        piece = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(rows)))
        each = np.diff(first)[piece]
        row = np.repeat(np.arange(len(piece)), each)
        at = np.repeat(first[piece] - (np.cumsum(each) - each), each) + np.arange(len(row))
        above = found[at, 3] < rows["most"].to_numpy()[row]
        row, at = row[above], at[above]
        of, h = m[piece[row]], pieces["h"].to_numpy()[piece[row]]
        columns = [rows["block"].to_numpy()[row], of, of < 0, h, *(found[at, c] for c in (1, 2, 3))]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    parts = max(-(-n // 8), int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = pieces.repartition(parts, "m").sortWithinPartitions("m", "h")
    return rows.mapInArrow(common.thrifty(induce), "block int, m long, crowd boolean, piece_hash long, offset long, length long, least long")


def _changes(*columns) -> np.ndarray:
    """Where a row differs from the one before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        values = c.to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _classes(pieces: list[bytes], doc: np.ndarray, width: int) -> np.ndarray:
    """[piece, offset, length, least]: runs of windows with the smallest document of their class."""
    s = np.frombuffer(b"\xff".join(pieces), np.uint8)
    lengths = np.array([len(p) for p in pieces])
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    owner = np.repeat(np.arange(len(pieces)), lengths + 1)[: len(s)]
    room = (starts + lengths)[owner] - np.arange(len(s))
    sa = suffix_array(s)
    shared = np.minimum(permuted_lcp(s, sa), np.maximum(room, 0))[sa]
    border = np.flatnonzero(~((room[sa] >= width) & (shared >= width)))
    least = np.empty(len(s), np.int64)
    least[sa] = np.repeat(np.minimum.reduceat(doc[owner[sa]], border), np.diff(np.append(border, len(s))))
    valid = room >= width
    new = np.ones(len(s), bool)
    new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1]) | ~valid[:-1]
    begin = np.flatnonzero(new & valid)
    change = np.flatnonzero(new | ~valid)
    stop = np.append(change, len(s))[np.searchsorted(change, begin, side="right")]
    return np.stack([owner[begin], begin - starts[owner[begin]], stop - begin, least[begin]], 1)


def remove_repeats(
    docs: DataFrame,
    width: int = 50,
    gram: int = GRAM,
    id_col: str = "doc_id",
    text_col: str = "text",
    crowded: int = CROWDED,
    keep: tuple[str, ...] = (),
    as_text: bool = False,
) -> DataFrame:
    """Remove each byte covered by a ``width``-byte string that also starts in a smaller document.

    Returns doc_id, kept (the remaining bytes), n_bytes, n_removed, n_spans, text_hash
    (xxhash64 of the input text) and the columns of ``keep`` as ``kept_<name>``, one row per input row;
    with ``as_text`` ``kept`` is text, and a cut inside a character drops the character's remains, too.
    Null text: empty.  A null id
    counts as larger than any other.  Rows that share an id don't remove from each
    other; of equal texts the smallest id's stays.  Texts shorter than ``width`` are
    never touched.  An empty table gives no rows; other columns are ignored.  Texts are
    UTF-8, in which byte 255 doesn't occur, so it separates documents.
    """
    rows, n = blocks(docs, id_col, text_col, keep)
    first = common.cut(first_texts(rows))
    shared = shared_minima(rows, first, n, width, gram, crowded)
    none = dict.fromkeys(["doc_id", "tkey", "m", "crowd", "piece_hash", "offset", "length", "least"], "long") | {"crowd": "boolean"}

    def padded(df: DataFrame, names: list[str]) -> DataFrame:
        return df.select("block", *[c if c in df.columns else F.lit(None).cast(none[c]).alias(c) for c in names])

    sides = ["doc_id", "tkey", "m", "crowd"]
    # the texts' shuffle is the same in all three joins, so Spark runs it once
    pieces = block_pieces(rows, padded(first, sides).unionByName(padded(shared, sides)), n, width, gram)
    runs = class_minima(pieces, n, width)
    return _drop_covered(rows, padded(first, list(none)).unionByName(padded(runs, list(none))), n, width, gram, as_text)


def _drop_covered(rows: DataFrame, side: DataFrame, n: int, width: int, k: int, as_text: bool) -> DataFrame:
    """Find the pieces again, and drop their covered windows; a text that is not the first of its kind goes whole."""
    held = [f for f in rows.schema.fields if f.name.startswith("kept_")]
    kinds = [pa.int64(), pa.string() if as_text else pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    names = ["doc_id", "kept", "n_bytes", "n_removed", "n_spans", "text_hash"]

    def drop(docs: pa.Table, others: pa.Table) -> pa.Table:
        runs: dict[tuple[int, int], list] = {}
        told = others.filter(pc.is_valid(others["piece_hash"]))
        for m, p, at, count, least in zip(*_columns(told, "m", "piece_hash", "offset", "length", "least"), strict=True):
            runs.setdefault((m, p), []).append((at, count, least))
        wanted, crowd = _wanted(_plain(others))
        first = set(zip(*_columns(others, "doc_id", "tkey"), strict=True))
        ids, keys, texts = _columns(docs, "doc_id", "tkey", "body")
        whole = [(i, k) in first for i, k in zip(ids, keys, strict=True)]
        covered: dict[int, list] = {}
        for i, m, at, piece in _find_pieces([x if w else b"" for x, w in zip(texts, whole, strict=True)], wanted, crowd, width, k):
            for offset, count, least in runs.get((m, _hash(piece)), ()):
                if least < ids[i]:
                    covered.setdefault(i, []).append((at + offset, at + offset + count + width - 1))
        out: list[list] = [[], [], [], [], [], []]
        for i, (own, key, body) in enumerate(zip(ids, keys, texts, strict=True)):
            merged: list[list[int]] = [[0, len(body)]] if not whole[i] and len(body) >= width else []
            for a, b in sorted(covered.get(i, ())):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            at, kept = 0, []
            for a, b in merged:
                kept.append(body[at:a])
                at = b
            kept.append(body[at:])
            left = b"".join(kept)
            row = (None if own == NO_ID else own, left.decode("utf-8", "ignore") if as_text else left, len(body), sum(b - a for a, b in merged), len(merged), key)
            for c, v in zip(out, row, strict=True):
                c.append(v)
        columns = [pa.array(c, t) for c, t in zip(out, kinds, strict=True)]
        return pa.table([*columns, *(docs[f.name] for f in held)], names=[*names, *(f.name for f in held)])

    schema = f"doc_id long, kept {'string' if as_text else 'binary'}, n_bytes long, n_removed long, n_spans long, text_hash long"
    schema = ", ".join([schema, *(f"`{f.name}` {f.dataType.simpleString()}" for f in held)])
    return _by_block(rows, n).cogroup(_by_block(side, n)).applyInArrow(common.thrifty_pair(drop), schema)


def _plain(table: pa.Table) -> pa.Table:
    """Minimizers proper: the hashes of single windows are negative."""
    return table.filter(pc.greater_equal(pc.fill_null(table["m"], -1), 0))


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

