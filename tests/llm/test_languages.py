"""Mixture inference against a plain version of the same model; the pipeline's language and mixing stages, and its empty tables."""

import hashlib
import math
import zlib
from collections import Counter

import corpus_pipeline
import pytest
from lodestrata.llm import langid

from test_corpus import corpus, docs  # noqa: F401


def buckets(text):
    data = text.lower().encode() + b"  "
    codes = [(data[i] << 16) | (data[i + 1] << 8) | data[i + 2] for i in range(len(data) - 2)]
    return [(c * 2654435761 % (1 << 32)) >> 16 for c in codes]


def segments(text):
    """Cut at the first space at or after each multiple of the segment's length; without any space, at the multiples."""
    data, out = text.lower().encode(), {0}
    for at in range(langid.SEGMENT, len(data), langid.SEGMENT):
        cut = data.find(b" ", at) if b" " in data else at
        if cut >= 0:
            out.add(cut)
    return [*sorted(out), len(data)]


def model(rows):
    counts = {}
    for lang, text in rows:
        if text:
            counts.setdefault(lang, Counter()).update(buckets(text))
    langs = sorted(counts)
    total = {k: sum(counts[k].values()) + 0.5 * langid.BUCKETS for k in langs}
    return langs, lambda k, b: math.log((counts[k][b] + 0.5) / total[k])


def fit(scores, members):
    weight = [1 / len(members)] * len(members)
    top = [max(s[m] for m in members) for s in scores]
    like = [[math.exp(s[m] - t) for m in members] for s, t in zip(scores, top, strict=True)]
    for _ in range(30):
        new = [0.0] * len(members)
        for row in like:
            part = [x * w for x, w in zip(row, weight, strict=True)]
            for i, p in enumerate(part):
                new[i] += p / sum(part) / len(like)
        done, weight = max(abs(a - b) for a, b in zip(new, weight, strict=True)) < 1e-4, new
        if done:
            break
    value = sum(math.log(sum(x * w for x, w in zip(row, weight, strict=True))) + t for row, t in zip(like, top, strict=True))
    return value - 0.5 * len(members) * math.log(len(scores) + 1), weight


def predict(text, langs, log):
    if not text or not any(c.isalpha() for c in text):
        return "und", 0.0
    found, ends = buckets(text), segments(text)
    scores = [[sum(log(k, b) for b in found[x:y]) for k in langs] for x, y in zip(ends, ends[1:], strict=False)]
    members = list(range(len(langs)))
    best, weight = fit(scores, members)
    while len(members) > 1:
        rest = [m for i, m in enumerate(members) if i != weight.index(min(weight))]
        value, w = fit(scores, rest)
        if value < best:
            break
        members, best, weight = rest, value, w
    at = max(range(len(members)), key=lambda i: (weight[i], -members[i]))
    return langs[members[at]], weight[at]


def brute(rows):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 4 == 2
    langs, log = model([(r[2], r[1]) for r in rows if not held(r[0]) and r[2] and r[1]])
    return [predict(r[1], langs, log) for r in rows]


def some(corpus):  # noqa: F811
    mixed = f"{corpus[1][1]} {corpus[3][1]}"
    return [*corpus[:40], *corpus[72:], (301, mixed, "en", "s0"), (302, "ééé" * 90, None, "s0")]


def test_against_plain_sums(spark, corpus):  # noqa: F811
    rows = some(corpus)
    got = sorted((str(r["doc_id"]), r["lang_pred"], round(r["score"], 6)) for r in langid.identify(docs(spark, rows)).collect())
    assert got == sorted((str(r[0]), lang, round(score, 6)) for r, (lang, score) in zip(rows, brute(rows), strict=True))


def test_language_stage(spark, corpus):  # noqa: F811
    rows = some(corpus)
    full = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars int")
    want = sorted((str(r[0]), r[1], lang, str(r[3])) for r, (lang, score) in zip(rows, brute(rows), strict=True) if lang != "und" and score >= 0.5)
    got = corpus_pipeline.language(spark, full, "").collect()
    assert sorted((str(r["doc_id"]), r["text"], r["lang"], str(r["source"])) for r in got) == want and 0 < len(want) < len(rows)


def test_mixing_stage(spark, corpus):  # noqa: F811
    full = spark.createDataFrame([(*r, 1) for r in corpus], "doc_id long, text string, lang string, source string, n_chars int")
    size = lambda r: len((r[1] or "").encode().split())
    sizes = {s: sum(size(r) for r in corpus if r[3] == s) for s in {r[3] for r in corpus}}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, stopped = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, set()
    while True:
        free = [s for s in order if s not in stopped]
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in stopped)
        target = {s: 3 * sizes[s] for s in stopped} | {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if target[s] > 3 * sizes[s]}
        if not over:
            break
        stopped |= over
    want = []
    for r in corpus:
        rate = target[r[3]] / sizes[r[3]] if sizes[r[3]] else 0
        draw = int(hashlib.md5(f"{'null' if r[0] is None else r[0]}:7".encode()).hexdigest()[:12], 16) / (1 << 48)
        want += [(str(r[0]), str(r[1]))] * (math.floor(rate) + (draw < rate - math.floor(rate)))
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in corpus_pipeline.mixing(spark, full, "").collect()) == sorted(want)


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_empty_tables(spark, name):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert dict(corpus_pipeline.STAGES)[name](spark, none, "").count() == 0
