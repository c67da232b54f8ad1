"""Relevance search: an inverted index in blocks of documents and BM25 that skips blocks which can't reach the best n.

Every task turns its rows into blocks and each block into postings, so building shuffles
nothing.  A posting row holds one term of one block: the ids, the counts, the lengths, and what
bounds any score in it.  A task's postings are written in order of (term, block), so a search
reads the pages of its own terms only, and a term that is everywhere is spread over all files.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import scratch

K1, B = 1.2, 0.75
#: Documents and words of a block.
BLOCK_ROWS, BLOCK_WORDS = 4096, 1 << 20
#: Decimals of a score; ties after rounding go to the smaller id.
DIGITS = 9
NOT_WORD = re.compile(r"[\W_]+")
INDEX = "term string, block long, ids array<long>, counts array<int>, lengths array<int>, peak_counts array<int>, peak_lengths array<int>, n_docs long, n_words long"


def words(text: str) -> list[str]:
    """Lower-cased runs of letters and digits."""
    return [w for w in NOT_WORD.split(text.lower()) if w]


def _postings(first: int, rows: list[tuple[int, Counter, int]]) -> list[tuple]:
    found: dict[str, tuple[list, list, list]] = {}
    for id_, counts, length in rows:
        for term, n in counts.items():
            ids, tfs, lengths = found.setdefault(term, ([], [], []))
            ids.append(id_)
            tfs.append(n)
            lengths.append(length)
    out = [(t, first, ids, tfs, lengths, *_peaks(tfs, lengths), 0, 0) for t, (ids, tfs, lengths) in found.items()]
    return [*out, ("", first, [], [], [], [], [], len(rows), sum(r[2] for r in rows))]


def _peaks(tfs: list[int], lengths: list[int]) -> tuple[list[int], list[int]]:
    """The pairs that no other beats in both count and length: one has the best weight, whatever the mean length is."""
    counts, kept = [], []
    for length, negative in sorted({(length, -tf) for tf, length in zip(tfs, lengths, strict=True)}):
        if not counts or -negative > counts[-1]:
            counts.append(-negative)
            kept.append(length)
    return counts, kept


def build_index(docs: DataFrame, id_col: str, text: str | Column) -> DataFrame:
    """Postings of ``docs`` (ids whole numbers, one row each), written once; the term '' has each block's size and words.

    Null texts have no words but count as documents; rows without an id are left out.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).alias("text"), F.monotonically_increasing_id().alias("nth")
    ).filter("id is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in INDEX.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 4, pa.int64(), pa.int64()]

        def out(first: int, held: list) -> pa.RecordBatch:
            columns = zip(*_postings(first, held), strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        held, first, n_words = [], None, 0
        for batch in batches:
            for id_, text_, nth in zip(batch[0].to_pylist(), batch[1], batch[2].to_pylist(), strict=True):
                found = words(text_.as_py())
                first = nth if first is None else first
                held.append((id_, Counter(found), len(found)))
                n_words += len(found)
                if len(held) == BLOCK_ROWS or n_words > BLOCK_WORDS:
                    yield out(first, held)
                    held, first, n_words = [], None, 0
        if held:
            yield out(first, held)

    path = scratch(docs.sparkSession, "index")
    rows.mapInArrow(run, INDEX).sortWithinPartitions("term", "block").write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(INDEX).parquet(path)


def _weight(tf: Column, length: Column, mean: float) -> Column:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))


def search(index: DataFrame, question: str, n: int) -> tuple[DataFrame, dict[str, int]]:
    """The best ``n`` documents for a question's distinct words (id, score), and how many blocks held a word and were scored.

    Scores are BM25 (k1 1.2, b 0.75, idf ln(1 + (N - df + 0.5) / (df + 0.5))), rounded to nine decimals; no word found: no row.
    The blocks of highest bound that hold ``n`` documents are scored first.  Their n-th best score is a floor: a
    block whose bound is below can't change the result and is never opened.
    """
    terms = sorted(set(words(question)))
    rows = index.filter(F.col("term").isin(["", *terms]))
    sums = rows.groupBy("term").agg(F.sum(F.size("ids")).alias("df"), F.sum("n_docs").alias("docs"), F.sum("n_words").alias("words")).collect()  # a row for each word asked
    known = {r["term"]: r for r in sums}
    total = known.pop("", None)
    if not known:
        return index.select(F.explode("ids").alias("id"), F.lit(0.0).alias("score")).limit(0), {"blocks": 0, "scored": 0}
    docs, mean = total["docs"], total["words"] / total["docs"]
    idf = F.lit(0.0)
    for term, r in known.items():
        idf = F.when(F.col("term") == term, math.log(1 + (docs - r["df"] + 0.5) / (r["df"] + 0.5))).otherwise(idf)
    rows = rows.filter("term <> ''").withColumn("idf", idf)
    best = F.col("idf") * F.array_max(F.transform(F.arrays_zip("peak_counts", "peak_lengths"), lambda p: _weight(p["peak_counts"], p["peak_lengths"], mean)))
    bounds = rows.groupBy("block").agg(F.sum(best).alias("bound"), F.max(F.size("ids")).alias("matches"))

    def scored(blocks: DataFrame) -> DataFrame:
        near = rows.join(blocks, "block", "left_semi").select("idf", F.explode(F.arrays_zip("ids", "counts", "lengths")).alias("p"))
        one = F.col("idf") * _weight(F.col("p.counts"), F.col("p.lengths"), mean)
        return near.groupBy(F.col("p.ids").alias("id")).agg(F.round(F.sum(one), DIGITS).alias("score"))

    # at most n blocks, since each holds a match
    before = Window.orderBy(F.desc("bound"), "block").rowsBetween(Window.unboundedPreceding, -1)
    head = bounds.orderBy(F.desc("bound"), "block").limit(n).withColumn("before", F.coalesce(F.sum("matches").over(before), F.lit(0)))
    first = scored(F.broadcast(head.filter(F.col("before") < n).select("block"))).orderBy(F.desc("score"), "id").limit(n)
    floor = first.agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).first()
    least = floor["least"] if floor["n"] == n else 0.0
    kept = bounds.filter(F.col("bound") >= least - 10.0**-DIGITS).select("block")
    counts = bounds.agg(F.count(F.lit(1)).alias("a"), F.count(F.when(F.col("bound") >= least - 10.0**-DIGITS, 1)).alias("b")).first()
    return scored(kept).orderBy(F.desc("score"), "id").limit(n), {"blocks": counts["a"], "scored": counts["b"]}


def search_works(works: DataFrame, question: str, min_cites: int = 4, n: int = 10_000) -> DataFrame:
    """Works cited more than ``min_cites`` times, with title and abstract, most relevant first, at most ``n``.

    Titles and abstracts are searched; the statistics are those of the works that pass the filter.
    """
    found = works.filter((F.col("cited_by_count") > min_cites) & F.col("title").isNotNull() & F.col("abstract").isNotNull())
    index = build_index(found, "id", F.concat_ws(" ", "title", "abstract"))
    top, _ = search(index, question, n)
    return found.join(F.broadcast(top), "id").orderBy(F.desc("score"), "id")  # at most n rows are sent
