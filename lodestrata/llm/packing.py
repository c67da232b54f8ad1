"""Harmonic packing of tokenised documents into fixed-capacity sequences.

A piece of length in (C/(k+1), C/k] belongs to class k, and a sequence of class k
takes exactly k pieces, so no search over open bins is needed: a piece's sequence
follows from its rank in its class.  Every task ranks its own pieces; one small
table of counts (task x class) turns the local ranks into global ones.  Because
documents may be cut freely, a document is first cut at class boundaries until the
room left in a piece's slot is at most ``slack`` tokens.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import _common as common
from .tokens import WordTokens, by_size

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, klass int, task int, local_rank long"


def classes(capacity: int) -> list[int]:
    """The class sizes: 1 to 16, then powers of two down to slots of eight tokens.

    >>> classes(64)
    [1, 2, 3, 4, 5, 6, 7, 8]
    """
    ks = [k for k in range(1, 17) if capacity // k >= min(8, capacity)]
    k = 32
    while capacity // k >= 8:
        ks.append(k)
        k *= 2
    return ks


def slots(capacity: int) -> list[tuple[int, int]]:
    """(slot length, class), longest slot first."""
    return [(capacity // k, k) for k in classes(capacity)]


def cuts(n: int, capacity: int, slack: int) -> list[tuple[int, int]]:
    """(piece length, class) of a document of ``n`` tokens; the lengths sum to ``n``."""
    out, table = [], slots(capacity)
    full, n = divmod(n, capacity)
    out += [(capacity, 1)] * full
    while n:
        fit = max(i for i, (length, _) in enumerate(table) if length >= n)
        length, k = table[fit]
        if length - n > slack and fit + 1 < len(table):
            length, k = table[fit + 1]  # the longest slot that this piece fills whole
        out.append((min(n, length), k))
        n -= min(n, length)
    return out


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, slack: int, eos: int) -> DataFrame:
    """One row per piece with its class and its rank among the task's pieces of that class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, task = WordTokens.of(tokenizer), TaskContext.get().partitionId()
        end, seen = int(eos).to_bytes(4, "little"), {}
        for part in (part for batch in batches for part in by_size(batch, texts=1)):
            rows = []
            data, ends = words.batch(part[1])
            for doc_id, start, stop in zip(part[0].to_pylist(), ends, ends[1:], strict=False):
                ids = bytes(data[start:stop]) + end
                n, at = len(ids) // 4, 0
                for length, k in cuts(n, capacity, slack):
                    seen[k] = seen.get(k, -1) + 1
                    rows.append((doc_id, at, length, zlib.crc32(memoryview(ids)[4 * at : 4 * (at + length)]), n, k, task, seen[k]))
                    at += length
            if rows:
                kinds = [pa.int64()] * 5 + [pa.int32()] * 2 + [pa.int64()]
                names = [c.split()[0] for c in PIECES.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return docs.mapInArrow(common.thrifty(run), PIECES)


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Give every piece its sequence and its offset there.

    ``pieces``: the rows of :func:`token_pieces`, already written (their ranks must
    not change between reads).  The pieces that don't fill a last sequence of their
    class are fewer than the sum of the class sizes, whatever the input; first-fit
    decreasing places these few in one group.
    """
    counts = pieces.groupBy("klass", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("klass").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("klass")
    base = counts.select(
        "klass", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), F.sum("n").over(whole).alias("total")
    )
    ranked = pieces.join(base, ["klass", "task"]).withColumn("rank", F.col("base") + F.col("local_rank"))
    filled = F.col("rank") < F.floor(F.col("total") / F.col("klass")) * F.col("klass")
    keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "klass", "rank"]
    regular = ranked.filter(filled).select(
        *keep, (F.shiftleft(F.col("klass").cast("long"), 44) + F.floor(F.col("rank") / F.col("klass"))).alias("sequence_id")
    )

    def first_fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "klass", "rank"], ascending=[False, True, True], kind="stable")
        room = np.empty(0, np.int64)
        at = []
        for n in pdf["length"]:
            fits = np.flatnonzero(room >= n)
            if len(fits) == 0:
                room = np.append(room, capacity)
                fits = [len(room) - 1]
            room[fits[0]] -= n
            at.append(fits[0])
        return pdf.assign(sequence_id=np.asarray(at, np.int64), rank=np.arange(len(pdf), dtype=np.int64))[[*keep, "sequence_id"]]

    rest = (
        ranked.filter(~filled)
        .groupBy(F.lit(0).alias("one"))
        .applyInPandas(lambda pdf: first_fit(pdf.drop(columns="one", errors="ignore")), regular.schema)
    )
    inside = Window.partitionBy("sequence_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    return regular.unionByName(rest).withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("long"))


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, slack: int = 8, eos: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    ``tokenizer``: path of a ``tokenizers`` file, the same on every machine.
    Returns doc_id, start, length, ids_crc32, doc_tokens, klass, rank, sequence_id,
    offset.  Null or empty text: one piece with the end id alone.  Null ids stay
    null; repeated rows are packed once each; an empty table gives no rows; other
    columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), common.text_or_empty(text_col).alias("text"))
    return pack(common.cut(token_pieces(rows, tokenizer, capacity, slack, eos)), capacity)
