"""Unigram scoring over subword lattices.

Vocabulary: the pieces of a public subword vocabulary and, as pieces of their own, the words of the training
texts.  The pieces' unigram scores come from expectation-maximisation over all training words, each word
once.  A word's probability sums over all its segmentations, by a forward recursion in
log space; the whole word is one of them:

    P_k(w) = ((c_k(w) - D_k)+ + (D_k * V_k + 1/4) * (f_k * G(w) + (1 - f_k) * L_k(w))) / (N_k + 1/2)

L_k(w) is the sum over subword pieces, whose word-final forms make it
sum to at most one over all words; D_k the discount (Ney's estimate) that pays for it; G the
distribution of all training words, and f_k the share of words seen once in k that were seen elsewhere; the document end
has (docs_k + 1/4) / (N_k + 1/2).  There is a component k for each frequent class of training texts
(their ``lang``), and one for all training texts together.  A text's probability is the product over its words and
the end, summed over the components by their shares; the
class of a scored text is never looked at.  So the model is a proper distribution over
texts as token sequences, and a text's score marginalises segmentations and components.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _common as common
from .tokens import byte_alphabet

#: Words of at least this share of all tokens travel with the code; there are at most 1 / HEAD of them.
HEAD = 1e-6
FLUSH = 400_000
#: Words that go through a lattice together: groups of one length and the same components are then long enough for arrays to pay.
GATHER = 80_000
#: Classes of training texts with a component of their own, the most frequent ones; the component of all texts speaks for the others.
CLASSES = 8
FINAL = "</w>"


class Pieces:
    """A subword vocabulary over bytes, in which word-final pieces end in ``</w>``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.model, self.alphabet = tokenizer.model, byte_alphabet()
        self.vocabulary = sorted(p for p in tokenizer.get_vocab(with_added_tokens=False) if not p.startswith("<|"))
        self.at = {p: i for i, p in enumerate(self.vocabulary)}

    @staticmethod
    @cache
    def of(path: str) -> Pieces:
        return Pieces(path)

    def spell(self, word: bytes) -> str:
        return word.decode("latin-1").translate(self.alphabet)

    def segment(self, spelled: str) -> list[str]:
        return [t.value for t in self.model.tokenize(spelled)]


class Table:
    """Strings' numbers looked up by 64-bit polynomial hash, many at a time; -1 for strings that are not held."""

    BASE = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, numbers: dict[str, int]):
        base, hashes = int(self.BASE), np.zeros(len(numbers), np.uint64)
        for n, word in enumerate(numbers):
            value = 0
            for c in word:
                value = (value * base + ord(c) + 1) % (1 << 64)
            hashes[n] = value
        ids = np.fromiter(numbers.values(), np.int32, len(numbers))
        # a slot holds one string; those that find theirs taken go on to the next level
        self.levels, bits, mix = [], max(16, (8 * len(ids)).bit_length()), 0xBF58476D1CE4E5B9
        while len(ids):
            shift, factor = np.uint64(64 - bits), np.uint64(mix)
            slots, first = np.unique((hashes * factor) >> shift, return_index=True)
            keys, values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
            keys[slots], values[slots] = hashes[first], ids[first]
            self.levels.append((factor, shift, keys, values))
            hashes, ids = np.delete(hashes, first), np.delete(ids, first)
            bits, mix = 16, (mix * 0x94D049BB133111EB + 2) % (1 << 64) | 1

    def find(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(hashes.shape, -1, np.int32)
        for factor, shift, keys, values in self.levels:
            slots = ((hashes * factor) >> shift).astype(np.int64)
            out = np.where(keys[slots] == hashes, values[slots], out)
        return out


class Lattice:
    """All segmentations of words under given piece scores (natural logs; a column for each component), many words of one length at a time."""

    def __init__(self, pieces: list[str], logs: np.ndarray):
        inner = {p: i for i, p in enumerate(pieces) if not p.endswith(FINAL)}
        final = {p.removesuffix(FINAL): i for i, p in enumerate(pieces) if p.endswith(FINAL) and p != FINAL}
        self.longest = max(map(len, [*inner, *final]), default=1)
        self.inner, self.final = Table(inner), Table(final)
        logs = np.asarray(logs, np.float64).reshape(len(pieces), -1)
        self.logs = np.append(logs, np.full((1, logs.shape[1]), -np.inf), axis=0)  # no piece: index -1

    def edges(self, words: list[str], n: int) -> Iterator[tuple[int, np.ndarray]]:
        """For each end 1 .. n: the first start, and the pieces [start, word] from there to the end."""
        letters = np.array(words, f"U{n}").view(np.uint32).reshape(len(words), n).T.astype(np.uint64) + np.uint64(1)
        open_ = np.zeros((0, len(words)), np.uint64)
        for j in range(1, n + 1):
            open_ = np.concatenate([open_[-self.longest + 1 :] if self.longest > 1 else open_[:0], np.zeros((1, len(words)), np.uint64)])
            open_ = open_ * Table.BASE + letters[j - 1]
            yield j - len(open_), (self.inner if j < n else self.final).find(open_)

    def score(self, words: list[str]) -> np.ndarray:
        """[word, component]: log probability, summed over the word's segmentations.

        >>> Lattice(["a", "b</w>", "ab</w>"], np.log([.5, .2, .1])).score(["ab", "b", "ba"])[:, 0].round(3).tolist()
        [-1.609, -1.609, -inf]
        """
        return self._by_length(words, self.logs, None)

    def expect(self, words: list[str], used: np.ndarray) -> np.ndarray:
        """[piece, component]: the pieces' expected uses in the words, each under the components for which ``used`` [word, component] is set."""
        counts = np.zeros((len(self.logs) - 1, self.logs.shape[1]))
        # words of the same components go together, through these only
        kind = used @ (1 << np.arange(used.shape[1]))
        for value in np.unique(kind).tolist():
            at, columns = np.flatnonzero(kind == value), [k for k in range(used.shape[1]) if value >> k & 1]
            if columns:
                part = np.zeros((len(counts), len(columns)))
                self._by_length([words[w] for w in at.tolist()], self.logs[:, columns], part)
                counts[:, columns] += part
        return counts

    def _by_length(self, words: list[str], logs: np.ndarray, counts: np.ndarray | None) -> np.ndarray:
        width = logs.shape[1]
        out = np.full((len(words), width), -np.inf)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        for n in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == n)
            for part in np.array_split(at, max(1, len(at) * n * width // 200_000)):
                ahead = np.full((n + 1, len(part), width), -np.inf)
                ahead[0] = 0
                kept = []
                for j, (i, ids) in enumerate(self.edges([words[w] for w in part], n), 1):
                    ahead[j] = _log_sum(ahead[i:j] + logs[ids])
                    if counts is not None:
                        kept.append((i, ids))
                out[part] = ahead[n]
                if counts is not None:
                    _uses(ahead, kept, logs, counts)
        return out


def _uses(ahead: np.ndarray, edges: list[tuple[int, np.ndarray]], logs: np.ndarray, counts: np.ndarray) -> None:
    """From the end back: with which probability a segmentation has a border at a place, and so takes each piece that ends there."""
    border = np.zeros(ahead.shape)
    border[-1] = np.isfinite(ahead[-1])
    pieces, shares = [], []
    for j in range(len(edges), 0, -1):
        i, ids = edges[j - 1]
        start, word = np.nonzero(ids >= 0)
        found, start = ids[start, word], start + i
        here = np.where(np.isfinite(ahead[j]), ahead[j], 0.0)
        share = np.exp(ahead[start, word] + logs[found] - here[word]) * border[j][word]
        border[start, word] += share
        pieces.append(found)
        shares.append(share)
    pieces, shares = np.concatenate(pieces), np.concatenate(shares)
    for k in range(counts.shape[1]):
        counts[:, k] += np.bincount(pieces, shares[:, k], len(counts))


def _log_sum(terms: np.ndarray) -> np.ndarray:
    top = terms.max(axis=0)
    safe = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return safe + np.log(np.exp(terms - safe).sum(axis=0))


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows, at least so many at a time but at the end."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def word_counts(rows: DataFrame, classes: int) -> DataFrame:
    """(word binary, c0, c1 ..., c, held): counts in the training texts of each class, in all of them, and in held-out texts, over all documents.

    ``rows``: (k, body); k below ``classes``: a class, ``classes``: another training text, above: held out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [Counter() for _ in range(classes + 2)]

        def flush() -> Iterator[pa.RecordBatch]:
            for k, found in enumerate(seen):
                columns = [pa.array(list(found), pa.binary()), pa.array([k] * len(found), pa.int32()), pa.array(list(found.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["word", "k", "n"])
                found.clear()

        for batch in batches:
            for k, body in zip(batch[0].to_pylist(), batch[1].to_pylist(), strict=True):
                seen[k].update(body.lower().split())
                if sum(map(len, seen)) > FLUSH:
                    yield from flush()
        yield from flush()

    part = rows.mapInArrow(run, "word binary, k int, n long")

    def total(of):
        return F.coalesce(F.sum(F.when(of, F.col("n"))), F.lit(0))

    sums = [total(F.col("k") == k).alias(f"c{k}") for k in range(classes)]
    return part.groupBy("word").agg(*sums, total(F.col("k") <= classes).alias("c"), total(F.col("k") > classes).alias("held"))


def _classes(rows: DataFrame) -> tuple[list[str], list[int], int]:
    """The most frequent classes of the training texts, their numbers of texts, and the number of all training texts."""
    found = rows.filter(~F.col("held_out")).groupBy("class").count()
    total = found.agg(F.sum("count")).first()[0] or 0
    top = found.filter("class is not null").orderBy(F.desc("count"), "class").limit(CLASSES).collect()
    return [r["class"] for r in top], [r["count"] for r in top], total


def piece_scores(counts: DataFrame, vocabulary: str, classes: int, rounds: int = 2) -> np.ndarray:
    """[piece, component]: natural-log scores of the vocabulary's pieces, by expectation-maximisation over all training words.

    Each word counts once for each component that has seen it, since the pieces speak for words that are rare or new.
    The first step counts the vocabulary's own segmentation, ``rounds`` more the
    expected uses over all segmentations.  What meets is bounded by the vocabulary.
    """
    pieces = Pieces.of(vocabulary).vocabulary
    context, size, width = counts.sparkSession.sparkContext, len(pieces), classes + 1
    names = [*(f"c{k}" for k in range(classes)), "c"]
    words = counts.filter("c > 0").select("word", *names)
    logs = None
    for _ in range(rounds + 1):
        now = context.broadcast(logs)

        def run(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            pieces, uses = Pieces.of(vocabulary), np.zeros((size, width))
            lattice = Lattice(pieces.vocabulary, now.value) if now.value is not None else None
            for batch in _gathered(batches, GATHER):
                spelled = [pieces.spell(w) for w in batch[0].to_pylist()]
                used = np.stack([c.to_numpy() > 0 for c in batch.columns[1:]], 1)
                if lattice:
                    uses += lattice.expect(spelled, used)
                else:
                    cut = [[pieces.at[p] for p in pieces.segment(s)] for s in spelled]
                    flat = np.fromiter((p for c in cut for p in c), np.int64)
                    each = np.repeat(used, [len(c) for c in cut], axis=0)
                    for k in range(width):
                        uses[:, k] += np.bincount(flat[each[:, k]], minlength=size)
            at, k = np.nonzero(uses)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(k), pa.array(uses[at, k])], ["piece", "k", "uses"])

        got = words.mapInArrow(run, "piece long, k long, uses double").groupBy("piece", "k").agg(F.sum("uses").alias("uses")).toPandas()
        total = np.full((size, width), 1e-3)
        total[got["piece"].to_numpy(np.int64), got["k"].to_numpy(np.int64)] += got["uses"].to_numpy(np.float64)
        logs = np.log(total / total.sum(axis=0))
    return logs


class Components:
    """The components' figures from their counts (arrays over the components, the last one of all training texts)."""

    def __init__(self, tokens, types, once, twice, elsewhere, texts):
        tokens, types, once, twice, elsewhere, texts = (np.asarray(x, np.float64) for x in (tokens, types, once, twice, elsewhere, texts))
        # Ney's estimate of the discount from the words seen once and twice
        self.discount = np.clip(once / np.maximum(1, once + 2 * twice), 0.5, 0.95)
        self.total = tokens + texts + 0.5
        spread = self.discount * types + 0.25
        share = (elsewhere + 0.5) / (once + 1)
        share[-1] = 0
        known = tokens[-1] - self.discount[-1] * types[-1]
        self.general = spread * share / known if known > 0 else np.zeros(len(spread))
        self.spelled = np.log(spread * (1 - share if known > 0 else 1.0))
        self.end = np.log(texts + 0.25) - np.log(self.total)
        shares = np.append(texts[:-1], texts[-1] - texts[:-1].sum() + 1)
        with np.errstate(divide="ignore"):
            self.prior = np.log(shares / shares.sum())

    def words(self, c: np.ndarray, logs: np.ndarray) -> np.ndarray:
        """[word, component]: log probabilities from counts and the sums over subword pieces; they stay in logs, as long words' fall below the smallest double."""
        seen = np.maximum(c - self.discount, 0) + self.general * np.maximum(c[:, -1:] - self.discount[-1], 0)
        with np.errstate(divide="ignore"):
            return np.logaddexp(np.log(seen), self.spelled + logs) - np.log(self.total)


def score_texts(
    docs: DataFrame,
    vocabulary: str,
    folds: int = 5,
    held_fold: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    class_col: str = "lang",
) -> DataFrame:
    """Score all texts with a model of those outside the held-out fold.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10
    probability) and pooled_score (that of the component of all training texts alone), one row per input row.  Null text:
    empty, so its score is the end's
    alone.  A null id is never held out.  Repeated rows are scored (and learned from)
    once each.  Texts of null, missing or rare classes are learned by the component of all texts.  Without training texts all
    probability goes to the lattice and the end.  A word costs a step of a loop for each character, so very long ones are slow.
    An empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (common.fold(id_col, folds) == held_fold).alias("held_out"),
        common.text_or_empty(text_col).cast("binary").alias("body"),
        (F.col(class_col) if class_col in docs.columns else F.lit(None)).cast("string").alias("class"),
    )
    classes, texts, n_docs = _classes(rows)
    size = len(classes)
    number = F.lit(size)
    for k, value in enumerate(classes):
        number = F.when(F.col("class") == value, k).otherwise(number)
    counts = common.cut(word_counts(rows.select(F.when(F.col("held_out"), size + 1).otherwise(number).alias("k"), "body"), size))
    names = [*(f"c{k}" for k in range(size)), "c"]

    def each(of) -> list:
        return [F.sum(of(F.col(c))) for c in names]

    def number_of(test) -> list:
        return each(lambda c: F.when(test(c), 1).otherwise(0))

    figures = [each(lambda c: c), number_of(lambda c: c > 0), number_of(lambda c: c == 1), number_of(lambda c: c == 2)]
    figures.append(number_of(lambda c: (c == 1) & (F.col("c") > 1)))
    flat = counts.agg(*[x for part in figures for x in part], F.sum(F.col("c") + F.col("held"))).first()
    flat, everything = [x or 0 for x in flat[:-1]], flat[-1] or 0
    parts = [flat[i : i + size + 1] for i in range(0, len(flat), size + 1)]
    model = Components(*parts, [*texts, n_docs])
    n, v = parts[0][-1] + n_docs, parts[1][-1] + (n_docs > 0)
    base_end = math.log10((n_docs + 0.5) / (n + 0.5 * (v + 1)))
    context = docs.sparkSession.sparkContext
    scores = context.broadcast(piece_scores(counts, vocabulary, size))
    owns = [f"own{k}" for k in range(size + 1)]
    own_kinds = "".join(f", {c} double" for c in owns)

    def score_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.of(vocabulary)
        lattice = Lattice(pieces.vocabulary, scores.value)
        for batch in _gathered(batches, GATHER):
            c = np.stack([x.to_numpy().astype(np.float64) for x in batch.columns[2:]], 1)
            own = model.words(c, lattice.score([pieces.spell(w) for w in batch[0].to_pylist()]))
            base = np.log10((c[:, -1] + 0.5) / (n + 0.5 * (v + 1)))
            columns = [batch[0], batch[1], pa.array(c[:, -1] > 0), pa.array(base), *(pa.array(x) for x in own.T)]
            yield pa.RecordBatch.from_arrays(columns, ["word", "times", "known", "base", *owns])

    scored = common.cut(
        counts.select("word", (F.col("c") + F.col("held")).alias("times"), *names).mapInArrow(
            score_words, f"word binary, times long, known boolean, base double{own_kinds}"
        )
    )
    is_head = F.col("times") >= HEAD * everything
    found = scored.filter(is_head).toPandas()  # 1 / HEAD words at most
    numbers = {bytes(w): i for i, w in enumerate(found["word"])}
    head = context.broadcast((numbers, found[["known", "base", *owns]].to_numpy(np.float64)))

    def score_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, values = head.value
        for batch in batches:
            rare, times, sums = [], [], []
            for i, body in enumerate(batch[2].to_pylist()):
                words = Counter(body.lower().split())
                k = np.fromiter(words.values(), np.int64, len(words))
                at = np.fromiter(map(numbers.get, words, repeat(-1)), np.int64, len(words))
                mine = k[at >= 0] @ values[at[at >= 0]]
                rare += compress(words, (at < 0).tolist())
                times.append(k[at < 0])
                # a word with a space in it matches none, and keeps these rows apart
                sums.append((b" %d" % i, int(k.sum()) + 1, int(mine[0]) + (n_docs > 0), mine[1] + base_end, *(mine[2:] + model.end).tolist()))
            rows = np.arange(batch.num_rows)
            at = pa.array(np.append(np.repeat(rows, [len(t) for t in times]), rows))
            words = pa.array([*rare, *(s[0] for s in sums)], pa.binary())
            uses = np.concatenate([*times, np.zeros(len(sums), np.int64)])
            own = [np.append(np.zeros(len(rare), kind), np.array([s[k] for s in sums], kind)) for k, kind in enumerate([np.int64] * 2 + [np.float64] * (2 + size), 1)]
            yield pa.RecordBatch.from_arrays(
                [batch[0].take(at), batch[1].take(at), words, pa.array(uses), *(pa.array(c) for c in own)],
                ["doc_id", "tkey", "word", "times", "n_tokens", "n_known", "base", *owns],
            )

    parts = rows.select("doc_id", F.xxhash64("body").alias("tkey"), "body").mapInArrow(
        score_docs, f"doc_id long, tkey long, word binary, times long, n_tokens long, n_known long, base double{own_kinds}"
    )
    tail = scored.filter(~is_head).select("word", "known", *[F.col(c).alias(f"w_{c}") for c in ("base", *owns)])
    times = F.col("times")

    def summed(column: str):
        return F.sum(F.col(column) + F.coalesce(times * F.col(f"w_{column}"), F.lit(0.0))).alias(column)

    sums = (
        parts.join(tail, "word", "left")
        .groupBy("doc_id", "tkey")
        .agg(
            F.sum("n_tokens").alias("n_tokens"),
            F.sum(F.col("n_known") + F.when(F.col("known"), times).otherwise(0)).alias("n_known"),
            *[summed(c) for c in ("base", *owns)],
            F.sum(F.when(F.col("n_tokens") > 0, 1).otherwise(0)).alias("copies"),
        )
    )
    # rows that are equal in id and text were summed together: they come apart again
    one = sums.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    one = one.withColumn("by", F.array(*[F.col(c) / F.col("copies") + float(x) for c, x in zip(owns, model.prior, strict=True)]))
    top = F.array_max("by")
    return one.select(
        "doc_id",
        (common.fold("doc_id", folds) == held_fold).alias("held_out"),
        F.expr("n_tokens div copies").alias("n_tokens"),
        F.expr("n_known div copies").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") / F.col("copies")).alias("base_score"),
        ((top + F.log(F.aggregate("by", F.lit(0.0), lambda total, x: total + F.exp(x - top)))) / math.log(10)).alias("score"),
        (F.col(owns[-1]) / F.col("copies") / math.log(10)).alias("pooled_score"),
    )
