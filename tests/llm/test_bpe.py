"""Byte-level BPE against the library that reads the same file."""

import hashlib
import random

import pytest

from lodestrata.llm.bpe import Bpe, decode, digests, encode, round_trip
from lodestrata.llm.queries import byte_tokenizer_path, op11_bpe

COLUMNS = "doc_id long, text string, ids string, decoded int"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(byte_tokenizer_path())


def test_random_texts(library):
    rng, bpe = random.Random(3), Bpe.of(byte_tokenizer_path())
    parts = [*"abcTHe  '\n\t\r.,!0129éßñ中文　\x85\xa0\x1c😀́՘₏", "<|endoftext|>", "'s", "'ll", "  ", "<|end", "oftext|>"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 40)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert bpe.encode(text).tolist() == ids
        assert bpe.decode(ids) == library.decode(ids, skip_special_tokens=False) == text
        some = [rng.randrange(0, 50_300) for _ in range(8)]  # no text's ids, some unknown
        assert bpe.decode(some) == library.decode(some, skip_special_tokens=False)


def test_one_very_long_word(library):
    text = "ab" * 100_000 + "é" * 50_000
    assert Bpe.of(byte_tokenizer_path()).encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_query_on_the_given_table(spark, library):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    coded = library.encode_batch([r["text"] or "" for r in table], add_special_tokens=False)
    expected = {
        r["doc_id"]: (len(c.ids), hashlib.sha256(",".join(map(str, c.ids)).encode()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())
        for r, c in zip(table, coded, strict=True)
    }
    assert {r["doc_id"]: tuple(r)[1:] for r in op11_bpe(spark, "/root/testdata/sf0.01").collect()} == expected


def test_nulls_empty_repeats_and_clashing_names(spark):
    rows = [(1, None, "x", 1), (2, "", "x", 1), (None, "So it is.", None, None), (None, "So it is.", None, None), (3, "long " * 60_000, "x", 2)]
    df = spark.createDataFrame(rows, COLUMNS)
    path, empty = byte_tokenizer_path(), hashlib.sha256(b"").hexdigest()
    found = [tuple(r) for r in digests(round_trip(df, path)).collect()]
    assert sorted(found, key=str)[0] == (1, 0, empty, empty) and (2, 0, empty, empty) in found
    assert len(found) == 5 and sum(r[0] is None for r in found) == 2
    back = decode(encode(df, path), path).select("text", "decoded").collect()
    assert all((r["text"] or "") == r["decoded"] for r in back)
    assert round_trip(df.limit(0), path).collect() == []
    odd = spark.createDataFrame([(None,), ([],), ([None, 99_999, 64],)], "ids array<int>")
    assert [r["decoded"] for r in decode(odd, path).collect()] == ["", "", "a"]


def test_other_kinds_are_refused():
    from lodestrata.llm.queries import tokenizer_path

    with pytest.raises(ValueError, match="byte-level"):
        Bpe(tokenizer_path())
