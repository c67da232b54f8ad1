"""The corpus operators against brute force, on small fixtures with nulls, empties, copies and clashing columns."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
import xxhash

from lodestrata.llm import ann, imatch, induced, langid, lattice, mixing, packing, simhash, style_tree, suffix_dedup, urls
from lodestrata.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, fp int, block int, m long, body string, word string"


def docs(spark, rows):
    full = [(i, t, lang, src, 1, 2, 3, "x", "y") for i, t, lang, src in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    words = {"en": "the of and to in is it was for that".split(), "fr": "le la les des est une dans que qui pour".split()}
    rows = []
    for i in range(60):
        lang = "en" if i % 3 else "fr"
        rows.append((i, " ".join(rng.choice(words[lang]) + rng.choice(["", "", "s", "ing"]) for _ in range(rng.randrange(1, 120))), lang, f"s{i % 4}"))
    passage = " ".join(rng.choice(words["en"]) for _ in range(60))
    rows += [(100 + i, f"Start {i} {passage} end {i * 7}", "en", "s0") for i in range(12)]
    rows += [(200, rows[5][1], "en", None), (201, rows[5][1], None, None), (202, None, "fr", "s1"), (203, "", "en", "s1"), (204, "1234 ???", "en", "s2")]
    rows += [(None, rows[7][1], "en", "s0"), (205, "a" * 5000, "en", "s3"), (206, "é" * 300 + "ß", "fr", "s3"), (205, "a" * 5000, "en", "s3")]
    return rows


EMPTY = []


def test_suffix_arrays(monkeypatch):
    rng = random.Random(1)
    for direct in (1024, 3):
        monkeypatch.setattr(induced, "DIRECT_NAMES", direct)
        for _ in range(150):
            b = bytes(rng.randrange(rng.choice([1, 2, 4, 250])) for _ in range(rng.choice([0, 1, 2, 7, 60, 200])))
            b = (b[: max(1, len(b) // 5)] * 6)[: len(b)] if rng.random() < 0.4 else b
            s = np.frombuffer(b, np.uint8)
            sa = induced.suffix_array(s)
            assert sa.tolist() == sorted(range(len(b)), key=lambda i: b[i:])
            lcp = induced.permuted_lcp(s, sa)
            for r in range(1, len(b)):
                x, y = b[sa[r] :], b[sa[r - 1] :]
                assert lcp[sa[r]] == next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))


def brute_repeats(rows, width):
    first, out = {}, []
    key = lambda r: (1 << 63) if r[0] is None else r[0]
    for r in sorted(rows, key=key):
        b = (r[1] or "").encode()
        cover = np.zeros(len(b) + 1, int)
        for i in range(len(b) - width + 1):
            if first.setdefault(b[i : i + width], key(r)) < key(r):
                cover[i] += 1
                cover[i + width] -= 1
        gone = np.cumsum(cover)[: len(b)] > 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((r[0], len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("crowded", [suffix_dedup.CROWDED, 200])
def test_repeats(spark, corpus, crowded):
    got = suffix_dedup.digest(suffix_dedup.remove_repeats(docs(spark, corpus), crowded=crowded))
    assert sorted(map(tuple, got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str) == brute_repeats(corpus, 50)


def brute_groups(fps, radius):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fps))]


def slow_fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_near_duplicates(spark, corpus):
    got = simhash.near_duplicates(docs(spark, corpus)).collect()
    fps = [slow_fingerprint(r[1]) for r in corpus]
    groups, least = brute_groups(fps, 2), {}
    for r, g in zip(corpus, groups, strict=True):
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    want = sorted(((r[0], f, least.get(g)) for r, f, g in zip(corpus, fps, groups, strict=True)), key=str)
    assert sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in got), key=str) == want


@pytest.mark.parametrize("crowded", [16 * 2048, 8])
def test_links(spark, monkeypatch, crowded):
    monkeypatch.setattr(simhash, "CROWDED", crowded)
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(8)]
    fps = list({b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(0, 5))) & ((1 << 64) - 1) for b in base for _ in range(60)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.links_within(spark.createDataFrame([(f,) for f in signed], "fp long")).collect()
    assert all(((r["a"] % (1 << 64)) ^ (r["b"] % (1 << 64))).bit_count() <= 64 for r in links)
    at = {f: i for i, f in enumerate(signed)}
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in links:
        a, b = find(at[r["a"]]), find(at[r["b"]])
        root[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(fps))] == brute_groups(fps, 2)


def test_packing(spark, corpus):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    got = packing.pack_documents(docs(spark, corpus), tokenizer_path(), capacity=64, slack=4).toPandas()
    pieces = {}
    for p in got.itertuples():
        pieces.setdefault(None if math.isnan(p.doc_id) else p.doc_id, []).append(p)
    for i in {r[0] for r in corpus}:
        texts = [r[1] for r in corpus if r[0] == i]
        ids = np.array([*tok.encode(texts[0] or "", add_special_tokens=False).ids, 1], "<u4")
        assert sum(p.length for p in pieces[i]) == len(ids) * len(texts)
        assert all(p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes()) and p.doc_tokens == len(ids) for p in pieces[i])
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s["length"].sum() <= 64 and s["offset"].tolist() == [0, *s["length"].cumsum()[:-1]]


def test_scores(spark, corpus):
    got = lattice.score_texts(docs(spark, corpus), tokenizer_path()).collect()
    assert len(got) == len(corpus)
    words = [(r[0], (r[1] or "").encode().lower().split()) for r in corpus]
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in words]
    counts = {}
    for (_, w), h in zip(words, held, strict=True):
        for x in [] if h else [*w, None]:
            counts[x] = counts.get(x, 0) + 1
    n, v = sum(counts.values()), len(counts)
    want = sorted((str(i), h, len(w) + 1, round(sum(math.log10((counts.get(x, 0) + 0.5) / (n + 0.5 * (v + 1))) for x in [*w, None]), 6)) for (i, w), h in zip(words, held, strict=True))
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 and r["train_tokens"] == n for r in got)


@pytest.mark.parametrize("part", [mixing.PART, 2])
def test_mixing(spark, corpus, monkeypatch, part):
    monkeypatch.setattr(mixing, "PART", part)
    got = mixing.mixing_report(docs(spark, corpus)).collect()
    assert len(got) == len(corpus)
    sizes, src = {}, {}
    for i, t, _, s in corpus:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
        src[i] = s
    order, total = sorted(sizes, key=lambda s: (s is None, s or "")), sum(sizes.values())
    weight, stopped = {s: (5, 2, 1)[n % 3] for n, s in enumerate(order)}, set()
    while True:
        left = total - sum(3 * sizes[s] for s in stopped)
        free = [s for s in order if s not in stopped]
        target = {s: left * weight[s] / sum(weight[f] for f in free) for s in free} | {s: 3 * sizes[s] for s in stopped}
        over = {s for s in free if target[s] > 3 * sizes[s]}
        if not over:
            break
        stopped |= over
    for r in got:
        assert r["target"] == pytest.approx(target[src[r["doc_id"]]]) and r["taken"] <= 3 * r["size"]


def test_fingerprints(spark, corpus):
    got = imatch.fingerprints(docs(spark, corpus)).collect()
    order = sorted(corpus, key=lambda r: (r[0] is None, -(r[0] or 0), [-ord(c) for c in r[1] or ""]))
    want = []
    for k, r in enumerate(order):
        t, nxt = r[1] or "", order[(k + 1) % len(order)][1] or ""
        third = len(t) // 3
        want.append((str(r[0]), len(t), hashlib.sha256((t[: len(t) - third] + nxt[:third]).encode()).hexdigest()))
    assert sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in got) == sorted(want)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    by = {r["doc_id"]: r["fingerprint"] for r in got}
    assert by[5] == by[200] == by[201]


def test_languages(spark, corpus):
    got = {r["doc_id"]: r for r in langid.identify(docs(spark, corpus)).collect()}
    assert {got[i]["lang_pred"] for i in (202, 203, 204)} == {"und"}
    right = [got[i]["lang_pred"] == lang for i, t, lang, _ in corpus if i is not None and i < 60 and len(t) > 30]
    assert sum(right) / len(right) > 0.95
    mixed = langid.proportions(np.array([[0.0, -9.0]] * 5 + [[-9.0, 0.0]] * 15))
    assert mixed == pytest.approx([0.25, 0.75], abs=0.01)
    assert langid.proportions(np.array([[0.0, -9.0]] * 20)).tolist() == [1.0, 0.0]


def test_pages(spark):
    one = """<html><body><header><h1>Site</h1></header><div id="cookie-notice">We use</div><main><h2>T&eacute;st</h2><p>One<br>two &amp; three
    </p><aside>no</aside><ul><li>a<li>b</ul><form><p>mail</p></form><section class="comments"><p>nice</p></section></main><footer>f</footer>"""
    plain = "<html><body><div class='top'>Same line</div><div class='story'><p>Story {}</p><p>More {}</p></div></body></html>"
    rows = [(1, "http://a.b/x", one, 1), (2, None, None, 1), (3, "nonsense", "", 1)] + [(10 + i, "http://h.x/" + str(i), plain.format(i, i * 3), 1) for i in range(6)]
    got = {r["page_id"]: r["text"] for r in style_tree.extract(spark.createDataFrame(rows, "page_id long, url string, html string, low int")).collect()}
    assert got[1] == "Tést\nOne two & three\na\nb" and got[2] == "" and got[3] == ""
    assert got[12] == "Story 2\nMore 6"


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, 24))
    x[50:90] = x[50]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(1000, None, 0), (1100, [0.0] * 24, 0), (1200, [float("nan")] * 24, 0), (1300, [None] * 24, 0)]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>, bucket int"), every=50).toPandas()
    hit = 0
    for q in range(0, 400, 50):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        mine = got[got["query_id"] == q].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 11)) and np.allclose(mine["score"], d[mine["vec_id"]])
        hit += len(set(mine["vec_id"]) & set(np.lexsort((np.arange(400), d))[:10].tolist()))
    assert hit / 80 >= 0.9 and set(got["query_id"]) == set(range(0, 400, 50))
    few = ann.nearest(spark.createDataFrame(rows[:4], "vec_id long, embedding array<double>, bucket int"), every=2).collect()
    assert len(few) == 6


def test_urls(spark):
    rows = [
        (1, "https://WWW.Example.ORG/es/1?x"), (2, "http://a.com/fr/x#y"), (3, "http://a.com/de/x"), (4, "http://b.net/en/1"), (5, None), (6, "no scheme"),
        (7, "http://example.org/en/12"), (8, "http://badexample.org/es/"), (9, "http://x.org"), (2, "http://a.com/fr/x#y"),
    ]
    got = {r["page_id"]: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert (got[1]["host"], got[1]["path"], got[1]["rule"], got[1]["verdict"]) == ("www.example.org", "/es/1", "example.org/es/", "block")
    assert got[2]["rule"] == "com/fr/" and got[3]["verdict"] == "block" and got[7]["rule"] == "example.org/en/1" and got[8]["rule"] == "org/"
    assert got[5]["host"] == "" and got[6]["path"] == "" and got[9]["rule"] is None and got[4]["rule"] is None
    assert all(r["verdict"] in ("allow", "block") for r in got.values())


def test_empty_tables(spark):
    none = docs(spark, [(0, "x", "en", "s")]).limit(0)
    assert packing.pack_documents(none, tokenizer_path()).count() == 0
    assert lattice.score_texts(none, tokenizer_path()).count() == 0
    assert mixing.mixing_report(none).count() == 0
    assert imatch.fingerprints(none).count() == 0
    assert langid.identify(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert style_tree.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    assert ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0
