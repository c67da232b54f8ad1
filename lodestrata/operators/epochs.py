"""Text classifiers trained in epochs: mini-batches inside tasks, weights averaged over tasks.

An epoch is one pass.  Every task starts from the same weights, goes through its training rows in
mini-batches and returns its weights times its rows; their mean starts the next epoch.
The same pass scores the validation rows with the weights that the epoch began with, so
each epoch's result is known one pass later.  The best epoch's weights are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import kept
from .sums import add_up
from .svd import sparse, sparse_rows
from .training import train_val_split

FEATURES = 1 << 12


def term_counts(df: DataFrame, features: int, out: str) -> DataFrame:
    """``df`` with its texts' hashed word counts as a sparse vector; null texts have none."""
    words = RegexTokenizer(inputCol="_text", outputCol="_words", pattern=r"\W+")
    counts = HashingTF(inputCol="_words", outputCol=out, numFeatures=features)
    return counts.transform(words.transform(df.withColumn("_text", F.coalesce("text", F.lit(""))))).drop("_text", "_words")


def _unit_rows(i: np.ndarray, counts: np.ndarray, sizes: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """TF-IDF values of length one by row, and the row of each."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    x = counts * idf[i]
    norm = np.sqrt(np.bincount(row, x * x, len(sizes)))
    return x / np.maximum(norm, 1e-12)[row], row


def _scores(i: np.ndarray, x: np.ndarray, row: np.ndarray, n: int, w: np.ndarray) -> np.ndarray:
    return np.bincount(row, w[i] * x, n) + w[-1]


def _loss(scores: np.ndarray, y: np.ndarray) -> float:
    return float((np.logaddexp(0, scores) - y * scores).sum())


@dataclass
class TextClassifier:
    """Weights of the words' slots and a bias, with the inverse document frequencies of the training texts."""

    idf: np.ndarray
    weights: np.ndarray


def apply_classifiers(df: DataFrame, models: dict[str, TextClassifier]) -> DataFrame:
    """``{name}_preds`` (0 or 1) of every model: words are counted once and all models score them in one pass."""
    features = {len(m.idf) for m in models.values()}
    if len(features) != 1:
        raise ValueError("models must share their number of features")
    shared = df.sparkSession.sparkContext.broadcast(models)

    @F.pandas_udf("array<int>")
    def sides(parts: pd.DataFrame) -> pd.Series:
        if not len(parts):
            return pd.Series([], dtype=object)
        sizes, out = parts["i"].map(len).to_numpy(), []
        i, counts = np.concatenate(parts["i"].to_list()).astype(np.int64), np.concatenate(parts["x"].to_list()).astype(np.float64)
        for m in shared.value.values():
            x, row = _unit_rows(i, counts, sizes, m.idf)
            out.append((_scores(i, x, row, len(sizes), m.weights) > 0).astype(np.int32))
        return pd.Series(list(np.stack(out, axis=1)))

    scored = term_counts(df, features.pop(), "_tf").withColumn("_sides", sides(sparse("_tf"))).drop("_tf")
    return scored.withColumns({f"{name}_preds": F.col("_sides")[k] for k, name in enumerate(models)}).drop("_sides")


def fit_text_classifier(
    df: DataFrame,
    epochs: int = 12,
    batch: int = 60,
    rate: float = 5.0,
    decay: float = 1e-4,
    patience: int = 3,
    threshold: float = 1e-4,
    seed: int = 13,
    features: int = FEATURES,
) -> tuple[TextClassifier, list[tuple[int, float, float, float, bool]]]:
    """Train on four fifths of ``df`` (id, text, relevant 0 or 1), choose the epoch by accuracy on the rest.

    Returns the best epoch's classifier and (epoch, training loss, validation loss, validation accuracy, best)
    of each.  Training ends when accuracy hasn't risen by more than ``threshold`` for ``patience``
    epochs.  Rows without text or label are left out; none at all is an error.
    """
    usable = df.filter("text is not null and relevant is not null").select("id", "text", "relevant")
    return fit_counts(kept(term_counts(usable, features, "tf").drop("text")), features, epochs, batch, rate, decay, patience, threshold, seed)


def fit_counts(
    df: DataFrame, features: int, epochs: int = 12, batch: int = 60, rate: float = 5.0, decay: float = 1e-4, patience: int = 3, threshold: float = 1e-4, seed: int = 13
) -> tuple[TextClassifier, list[tuple[int, float, float, float, bool]]]:
    """``fit_text_classifier`` on words that are counted already: (id, tf: a sparse vector of ``features`` slots, relevant).

    ``df`` is read several times, so it should be kept.
    """
    train, val = train_val_split(df.filter("relevant is not null").select("id", "tf", "relevant"), seed)
    counted = train.withColumn("held", F.lit(False)).unionByName(val.withColumn("held", F.lit(True)))
    counted = kept(counted.withColumn("_order", F.xxhash64(F.lit(seed), "id")).repartition("id").sortWithinPartitions("_order").select("tf", "relevant", "held"))
    if counted.filter("not held").isEmpty():
        raise ValueError("there are no rows to train on")
    idf = np.asarray(IDF(inputCol="tf", outputCol="x").fit(counted.filter("not held")).idf.toArray())
    rows = counted.select(sparse("tf").alias("row"), F.col("relevant").cast("double").alias("y"), "held")
    w = np.zeros(features + 1)

    def epoch(start: np.ndarray) -> np.ndarray:
        shared = rows.sparkSession.sparkContext.broadcast((start, idf))

        def local(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            begin, idf_ = shared.value
            now, seen, loss, held = begin.copy(), 0, 0.0, np.zeros(3)
            waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []  # rows short of a batch

            def learn(i: np.ndarray, x: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> None:
                nonlocal now, seen, loss
                row = np.repeat(np.arange(len(sizes)), sizes)
                scores = _scores(i, x, row, len(y), now)
                loss += _loss(scores, y)
                error = (1 / (1 + np.exp(-scores)) - y) / len(y)
                step = np.append(np.bincount(i, error[row] * x, len(now) - 1), error.sum())
                now *= 1 - rate * decay
                now -= rate * step
                seen += len(y)

            for part in batches:
                i, counts, sizes = sparse_rows(part[0])
                x, row = _unit_rows(i, counts, sizes, idf_)
                y, out = part[1].to_numpy(), part[2].to_numpy(zero_copy_only=False)
                if out.any():
                    scores = _scores(i, x, row, len(y), begin)[out]
                    held += [float(((scores > 0) == (y[out] > 0)).sum()), out.sum(), _loss(scores, y[out])]
                own = ~out[row]
                waiting.append((i[own], x[own], sizes[~out], y[~out]))
                i, x, sizes, y = (np.concatenate(c) for c in zip(*waiting, strict=True))
                ends, whole = np.concatenate([[0], np.cumsum(sizes)]), len(y) - len(y) % batch
                for first in range(0, whole, batch):
                    a, b = ends[first], ends[first + batch]
                    learn(i[a:b], x[a:b], sizes[first : first + batch], y[first : first + batch])
                waiting = [(i[ends[whole] :], x[ends[whole] :], sizes[whole:], y[whole:])]
            if waiting and len(waiting[0][3]):
                learn(*waiting[0])
            return np.concatenate([now * seen, [seen, loss], held])

        found = add_up(rows, local, features + 6)
        shared.unpersist()
        return found

    history, best = [], (-1.0, 0, w)
    for n in range(epochs + 1):
        found = epoch(w)
        seen, loss, right, held, held_loss = found[features + 1 :]
        accuracy = right / held if held else 0.0
        if n:  # the pass scored what the epoch before made
            history[-1][2:4] = [float(held_loss / max(held, 1)), float(accuracy)]
            if accuracy > best[0] + threshold:
                best = (accuracy, n, w)
            if n - best[1] >= patience or n == epochs:
                break
        history.append([n + 1, float(loss / seen), 0.0, 0.0])
        w = found[: features + 1] / seen
    return TextClassifier(idf, best[2]), [(*h, h[0] == best[1]) for h in history]
