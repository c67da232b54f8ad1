"""Lattice sums, expected uses and text scores against enumeration of all segmentations."""

import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from lodestrata.llm import lattice
from lodestrata.llm.lattice import Components, Lattice, Pieces
from lodestrata.llm.queries import tokenizer_path

PIECES = ["a", "b", "ab", "ba", "a</w>", "b</w>", "ab</w>", "aba</w>"]


def scores(seed=1):
    return np.random.default_rng(seed).dirichlet(np.ones(len(PIECES)), 2).T


def ways(word):
    """All segmentations, as lists of pieces."""
    if word + "</w>" in PIECES:
        yield [word + "</w>"]
    for i in range(1, len(word)):
        if word[:i] in PIECES:
            yield from ([word[:i], *rest] for rest in ways(word[i:]))


def weigh(way, p, k):
    return math.prod(p[PIECES.index(x), k] for x in way)


def test_sums_over_all_segmentations():
    p, words = scores(), ["aba", "ab", "b", "abab", "bbbb", "ababbaab", "c", "aab", "ba"]
    got = np.exp(Lattice(PIECES, np.log(p)).score(words))
    assert np.allclose(got, [[sum(weigh(w, p, k) for w in ways(word)) for k in (0, 1)] for word in words])


def test_expected_uses():
    p, words = scores(2), ["aba", "abab", "ababbaab", "c", "ab"]
    used = np.array([[True, False], [True, True], [False, True], [True, True], [False, False]])
    want = np.zeros(p.shape)
    for word, use in zip(words, used, strict=True):
        for k in (0, 1):
            total = sum(weigh(w, p, k) for w in ways(word))
            for w in ways(word) if use[k] else ():
                for x in w:
                    want[PIECES.index(x), k] += weigh(w, p, k) / total
    assert np.allclose(Lattice(PIECES, np.log(p)).expect(words, used), want)


def test_probabilities_sum_to_one_at_most():
    p = scores(3)
    words = ["".join(w) for n in range(1, 13) for w in itertools.product("ab", repeat=n)]
    counts = {"ab": (3, 4), "b": (1, 1), "abba": (0, 2), "a": (1, 3)}
    c = np.array([counts.get(w, (0, 0)) for w in words], float)
    tokens = c.sum(axis=0)
    model = Components(tokens, (c > 0).sum(axis=0), (c == 1).sum(axis=0), (c == 2).sum(axis=0), [1, 0], [2, 5])
    total = np.exp(model.words(c, Lattice(PIECES, np.log(p)).score(words))).sum(axis=0) + np.exp(model.end)
    assert (total <= 1 + 1e-9).all() and (total > 0.9).all() and np.exp(model.prior).sum() == pytest.approx(1)


@pytest.mark.parametrize("doubled", [1, 2])
def test_text_scores(spark, monkeypatch, doubled):
    monkeypatch.setattr(lattice, "HEAD", 0.02)
    words = "der die und haus the and house river été maison la une".split()
    rng = np.random.default_rng(5)
    rows = []
    for i in range(40):
        own = words[(i % 3) * 4 : (i % 3) * 4 + 4]
        rows.append((i, " ".join(rng.choice(own) + rng.choice(["", "s", "heit", "Zx"]) for _ in range(rng.integers(0, 25))), ("de", "en", None)[i % 3]))
    rows += [(None, "Haus haus HAUS", "de"), (50, None, "en")]
    table = [(i, t, g, 1, 2, "x") for i, t, g in rows] * doubled
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string, c int, copies int, word string").repartition(3)
    got = lattice.score_texts(docs, tokenizer_path()).collect()
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _, _ in rows}
    texts = {i: (t or "").encode().lower().split() for i, t, _ in rows}
    named = [g for g, _ in sorted(Counter(g for i, _, g in rows if g and not held[i]).items(), key=lambda x: (-x[1], x[0]))]
    parts = [[i for i, _, g in rows if not held[i] and g == name] for name in named] + [[i for i, _, _ in rows if not held[i]]]
    counts = [Counter(w for i in part for w in texts[i] * doubled) for part in parts]
    every = sorted({w for t in texts.values() for w in t})
    c = np.array([[n[w] for n in counts] for w in every], float)
    pieces = Pieces.of(tokenizer_path())
    spelled = [pieces.spell(w) for w in every]
    logs = None
    for _ in range(3):
        if logs is None:
            uses = np.zeros((len(pieces.vocabulary), len(parts)))
            for s, used in zip(spelled, c > 0, strict=True):
                for p in pieces.segment(s):
                    uses[pieces.at[p]] += used
        else:
            uses = Lattice(pieces.vocabulary, logs).expect(spelled, c > 0)
        logs = np.log((uses + 1e-3) / (uses + 1e-3).sum(axis=0))
    elsewhere = ((c == 1) & (c[:, -1:] > 1)).sum(axis=0)
    model = Components(c.sum(axis=0), (c > 0).sum(axis=0), (c == 1).sum(axis=0), (c == 2).sum(axis=0), elsewhere, [len(p) * doubled for p in parts])
    own = dict(zip(every, model.words(c, Lattice(pieces.vocabulary, logs).score(spelled)), strict=True))
    want = {}
    for i, t in texts.items():
        by = model.end + sum((own[w] for w in t), np.zeros(len(parts)))
        want[i] = (np.logaddexp.reduce(by + model.prior) / math.log(10), by[-1] / math.log(10))
    assert len(got) == len(table)
    for r in got:
        assert (r["score"], r["pooled_score"]) == pytest.approx(want[r["doc_id"]]) and r["held_out"] == held[r["doc_id"]]
