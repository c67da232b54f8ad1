"""I-Match fingerprints, likeness and neighbours against plain loops; ranges of ids of any spread."""

import hashlib
import random
import struct
from collections import Counter

import pytest
import xxhash
from lodestrata.llm import imatch


def xx(values, seed=42):
    for v in values:
        seed = xxhash.xxh64_intdigest(v if isinstance(v, bytes) else struct.pack("<q", v), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def hashed(text):
    return list(dict.fromkeys(xx([w.encode()]) for w in text.lower().split()))


def slot(h):
    return (h % (1 << 64)) >> (64 - imatch.TERM_BITS)


def level(kept, d):
    out = []
    for r in range(imatch.SUBSETS):
        inside = [t for t in kept if t & ((1 << d) - 1) == r]
        out.append(f"{xx(inside) % (1 << 64):X}"[:8] if inside else "-")
    return f"{d}:{','.join(out)}"


def fingerprint(text, lexicon):
    every = sorted(hashed(text))
    kept = [h for h in every if slot(h) in lexicon]
    parts = [f"{xx(kept or every) % (1 << 64):X}"]
    for mark, terms in (("", kept), ("*", every if len(kept) < imatch.THIN * len(every) else [])):
        if terms or not mark:
            d = len(terms).bit_length() - 1 if terms else 0
            parts += [mark + level(terms, d), mark + level(terms, max(0, d - 1))]
    return "|".join(parts)


def likeness(a, b):
    best = 0.0
    for x in a.split("|")[1:]:
        for y in b.split("|")[1:]:
            (dx, hx), (dy, hy) = x.split(":"), y.split(":")
            told = [(i, j) for i, j in zip(hx.split(","), hy.split(","), strict=True) if (i, j) != ("-", "-")]
            if dx == dy and told:
                best = max(best, sum(i == j for i, j in told) / len(told))
    return 1.0 if a == b else best


def table(ids):
    rng = random.Random(8)
    words = [f"{rng.choice(['Wort', 'mot', 'été'])}{i}" for i in range(150)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 60))) for _ in ids]
    for i in range(0, len(texts), 9):
        texts[i] = texts[0]
    texts[5] = None
    return list(zip(ids, texts, strict=True))


IDS = [[*range(120), 1 << 60], [7] * 60 + [9] * 30 + [*range(10, 30)], [None] * 50 + [*range(-20, 20)], [0, 1], [None, None, None]]


@pytest.mark.parametrize("ids", IDS)
def test_fingerprints(spark, monkeypatch, ids):
    monkeypatch.setattr(imatch, "RANGE", 8)
    rows = table(ids) if len(ids) > 9 else [(i, f"one two {k}") for k, i in enumerate(ids)]
    docs = spark.createDataFrame([(i, t, 1, 2, 3, "x", "y") for i, t in rows], "doc_id long, text string, part int, tie int, guest int, bits string, body string")
    got = imatch.fingerprints(docs.repartition(3)).collect()
    distinct = {t or "" for _, t in rows}
    df = Counter(s for t in distinct for s in {slot(h) for h in hashed(t)})
    low, high = (max(2.0, x * len(distinct)) for x in imatch.BAND)
    lexicon = {s for s, n in df.items() if low <= n <= high}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), -((xx([(r[1] or "").encode()]) % (1 << 64)) >> 1)))
    want = []
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", order[(k + 1) % len(order)][1] or ""
        edited = t[: len(t) - len(t) // 3] + nxt[: len(t) // 3]
        own, other, after = (fingerprint(x, lexicon) for x in (t, edited, nxt))
        want.append((str(i), len(t), hashlib.sha256(edited.encode()).hexdigest(), own, other, likeness(own, other), likeness(own, after)))
    names = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    for have, should in zip(sorted((str(r["doc_id"]), *(r[c] for c in names)) for r in got), sorted(want), strict=True):
        assert have == should


@pytest.mark.parametrize("ids", IDS[:3])
def test_ranges_are_even(spark, monkeypatch, ids):
    monkeypatch.setattr(imatch, "RANGE", 8)
    rows = [(i, f"text {k}") for k, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, body string")
    sizes = [r["count"] for r in imatch.rings(docs).filter("guest = 0").groupBy("part").count().collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 24
