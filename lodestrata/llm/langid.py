"""Language identification as inference of a multilingual mixture.

Each language has smoothed character-trigram probabilities (hashed to a fixed number
of buckets).  A text is cut into segments of about 64 bytes at white space; a
segment's log-likelihood under a language is the sum over its trigrams.  Expectation
-maximisation estimates the proportions with which the languages produce the
segments, and languages are dropped while a penalised likelihood (half the log of the
number of segments for each language) grows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _common as common

BUCKETS = 1 << 16
SEGMENT = 64
PIECE = 1 << 20
LETTER = regex.compile(r"\p{L}")


def _trigrams(data: np.ndarray) -> np.ndarray:
    """A bucket for each byte position: a hash of it and its two successors."""
    padded = np.concatenate([data, np.full(2, 32, np.uint8)]).astype(np.uint32)
    code = (padded[:-2] << 16) | (padded[1:-1] << 8) | padded[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def _pieces(data: np.ndarray, at: int = 0, end: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(start, buckets) of the data from ``at`` to ``end``, a million positions at a time."""
    end = len(data) if end is None else end
    for a in range(at, end, PIECE):
        b = min(a + PIECE, end)
        yield a, _trigrams(data[a : b + 2])[: b - a]


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)


def train(rows: DataFrame, floor: float = 0.5) -> tuple[list[str], np.ndarray]:
    """(languages, log-probabilities [language, bucket]) from (lang, text); counts cover all given rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in common.sliced(batches):
            for lang, text in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                if text:
                    mine = counts.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    for _, buckets in _pieces(_bytes(text)):
                        mine += np.bincount(buckets, minlength=BUCKETS)
        for lang, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(c[at])], ["lang", "bucket", "c"])

    found = rows.mapInArrow(common.thrifty(run), "lang string, bucket long, c long").groupBy("lang", "bucket").agg(F.sum("c").alias("c"))
    got = found.toPandas()  # at most BUCKETS rows a language
    langs = sorted(got["lang"].unique())
    counts = np.full((len(langs), BUCKETS), floor)
    counts[pd.Categorical(got["lang"], categories=langs).codes, got["bucket"].to_numpy(np.int64)] += got["c"].to_numpy(np.float64)
    return langs, np.log(counts / counts.sum(axis=1, keepdims=True))


def segment_scores(text: str, table: np.ndarray) -> np.ndarray:
    """[segment, language] log-likelihoods."""
    data = _bytes(text)
    if len(data) == 0:
        return np.zeros((1, table.shape[1]))
    spaces = np.flatnonzero(data == 32)
    want = np.arange(SEGMENT, len(data), SEGMENT)
    at = np.searchsorted(spaces, want)
    cuts = np.where(at < len(spaces), spaces[np.minimum(at, len(spaces) - 1)], len(data)) if len(spaces) else want
    starts = np.unique(np.concatenate([[0], cuts[cuts < len(data)]]))
    out = np.zeros((len(starts), table.shape[1]))
    for a, buckets in _pieces(data):
        # the segment that began last goes on in this piece
        first, last = np.searchsorted(starts, a, side="right"), np.searchsorted(starts, a + len(buckets))
        out[first - 1 : last] += np.add.reduceat(table[buckets], np.append(a, starts[first:last]) - a, axis=0)
    return out


def proportions(scores: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Mixture proportions by expectation-maximisation, over the language set of best penalised likelihood."""
    n, k = scores.shape

    def fit(members: list[int]) -> tuple[float, np.ndarray]:
        own = scores[:, members]
        top = own.max(axis=1, keepdims=True)
        like = np.exp(own - top)
        weight = np.full(len(members), 1 / len(members))
        for _ in range(rounds):
            part = like * weight
            new = (part / part.sum(axis=1, keepdims=True)).mean(axis=0)
            if np.abs(new - weight).max() < 1e-4:
                weight = new
                break
            weight = new
        value = float((np.log((like * weight).sum(axis=1)) + top[:, 0]).sum())
        return value - 0.5 * len(members) * np.log(n + 1), weight

    members = list(range(k))
    best, weight = fit(members)
    while len(members) > 1:
        rest = [m for i, m in enumerate(members) if i != int(weight.argmin())]
        value, w = fit(rest)
        if value < best:
            break
        members, best, weight = rest, value, w
    out = np.zeros(k)
    out[members] = weight
    return out


def identify(
    docs: DataFrame,
    folds: int = 4,
    held_fold: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Predict the language of every text from a model of the labelled rows outside the held-out fold.

    Returns doc_id, held_out, lang_pred, score (the share of the predicted language),
    languages (every language kept, by share) and the columns of ``keep`` as
    ``kept_<name>``, one row per input row.  Null text or
    text without a letter, or no labelled training row at all: ``und`` with score 0.
    A null id is never held out.  Ties go to the language first in code-point order.
    Repeated rows are predicted alike; an empty table gives no rows; other columns are
    ignored.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (common.fold(id_col, folds) == held_fold).alias("held_out"),
        F.col(text_col).cast("string").alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
        *[F.col(c).alias(f"kept_{c}") for c in keep],
    )
    langs, logs = train(rows.filter(~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text"))
    model = docs.sparkSession.sparkContext.broadcast(np.ascontiguousarray(logs.T))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = model.value
        for batch in common.sliced(batches):
            preds, scores, sets = [], [], []
            for text in batch[2].to_pylist():
                if not langs or not text or not LETTER.search(text):
                    preds.append("und")
                    scores.append(0.0)
                    sets.append([])
                    continue
                share = proportions(segment_scores(text, table))
                best = int(share.argmax())
                preds.append(langs[best])
                scores.append(min(1.0, float(share[best])))
                sets.append([langs[i] for i in np.argsort(-share, kind="stable") if share[i] > 0])
            yield pa.RecordBatch.from_arrays(
                [
                    batch[0],
                    batch[1],
                    pa.array(preds, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(sets, pa.list_(pa.string())),
                    *batch.columns[3:],
                ],
                ["doc_id", "held_out", "lang_pred", "score", "languages", *names],
            )

    names = [f"kept_{c}" for c in keep]
    rows = rows.select("doc_id", "held_out", "text", *names)
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[3:]]
    return rows.mapInArrow(
        common.thrifty(run), ", ".join(["doc_id long, held_out boolean, lang_pred string, score double, languages array<string>", *kinds])
    )
