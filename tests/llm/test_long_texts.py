"""A text of 300,000 characters, its near copy and a passage of it, through each operator on documents."""

import hashlib
import random

import pytest
from lodestrata.llm import imatch, langid, lattice, mixing, packing, simhash, suffix_dedup
from lodestrata.llm.near_texts import near_groups
from lodestrata.llm.queries import tokenizer_path

from test_corpus import brute_repeats, slow_fingerprint

RNG = random.Random(6)
WORDS = ["".join(RNG.choice("abcdefghié") for _ in range(RNG.randrange(2, 9))) for _ in range(4000)]
LONG = " ".join(RNG.choice(WORDS) for _ in range(50_000))
NEAR = " ".join(w if i % 500 else "changed" for i, w in enumerate(LONG.split()))
ROWS = [(1, LONG), (2, NEAR), (3, "Before it " + LONG[50_000:60_000] + " after it"), (4, "x" * 20_000), (5, "short and other")]


@pytest.fixture(scope="module")
def docs(spark):
    assert len(LONG) > 290_000
    return spark.createDataFrame([(i, t, "en", "s") for i, t in ROWS], "doc_id long, text string, lang string, source string").repartition(2)


def test_repeats(docs):
    got = suffix_dedup.digest(suffix_dedup.remove_repeats(docs)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == brute_repeats(ROWS, 50)


def test_fingerprints(docs):
    assert {r["doc_id"]: r["fp"] % (1 << 64) for r in simhash.near_duplicates(docs).collect()} == {i: slow_fingerprint(t) for i, t in ROWS}


def test_near_copies(docs):
    groups = {r["id"]: r["group"] for r in near_groups(docs).collect()}
    assert groups[1] == groups[2] and len(set(groups.values())) == 4


def test_packing(docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    got = packing.pack_documents(docs, tokenizer_path()).groupBy("doc_id").sum("length").collect()
    assert {r[0]: r[1] for r in got} == {i: len(tok.encode(t, add_special_tokens=False).ids) + 1 for i, t in ROWS}


def test_scores(docs):
    got = {r["doc_id"]: r for r in lattice.score_texts(docs, tokenizer_path()).collect()}
    assert all(got[i]["n_tokens"] == len(t.split()) + 1 and -1e7 < got[i]["score"] < 0 for i, t in ROWS)


def test_edited_texts(docs):
    got = {r["doc_id"]: r for r in imatch.fingerprints(docs).collect()}
    for k, (i, t) in enumerate(ROWS):
        after = ROWS[k - 1][1]  # ids descend
        edited = t[: len(t) - len(t) // 3] + after[: len(t) // 3]
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and got[i]["n_chars"] == len(t)


def test_languages_and_sizes(docs):
    assert {r["lang_pred"] for r in langid.identify(docs).collect()} == {"en"}
    assert {r["doc_id"]: r["size"] for r in mixing.mixing_report(docs).collect()} == {i: len(t.split()) for i, t in ROWS}
