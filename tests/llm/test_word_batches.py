"""Texts are tokenised a batch at a time: Python sees a word once, not once for each form, and the ids are the library's."""

import random
import sys

import pyarrow as pa
import pytest
from lodestrata.llm import tokens
from lodestrata.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def words():
    return tokens.WordTokens(tokenizer_path())


def library(words, text):
    return b"".join(i.to_bytes(4, "little") for i in words.tokenizer.encode(text, add_special_tokens=False).ids)


def batched(words, texts):
    data, ends = words.batch(texts)
    return [bytes(data[a:b]) for a, b in zip(ends, ends[1:], strict=False)]


def test_python_sees_a_word_once_not_its_forms():
    words = tokens.WordTokens(tokenizer_path())
    names = [f"{a}{b}{c}" for a in ("lo", "de", "stra", "ta", "gran") for b in ("mer", "ti", "val", "en", "or", "us") for c in "abcdefghij"]
    text = " ".join(f"{case(w)}{tail}" for w in names for case in (str.lower, str.upper, str.title) for tail in ("", ".", ",", "!!", "&&&", "?"))
    calls = []
    sys.setprofile(lambda frame, event, arg: event == "call" and calls.append(1))
    try:
        got = words.ids(text)
    finally:
        sys.setprofile(None)
    assert len(names) == 300 and len(set(text.split())) == 5_400
    assert len(calls) < 1_000
    assert got == library(words, text)


def test_every_low_code_point_in_context(words):
    points = [chr(p) for p in [*range(0x260), *range(0x300, 0x370), 0x85, 0xA0, 0x1E9E, 0x2028, 0x2C65, 0x3000, 0x4E2D, 0x1F600, 0xFF21]]
    texts = [form.format(p) for p in points for form in ("{}", "a{}", "{}a", "Ab{}c.", "é{}!!", "x {0}{0} y", "9{}'s", "<|{}|>")]
    wrong = [t for t, got in zip(texts, batched(words, pa.array(texts)), strict=True) if got != library(words, t)]
    assert wrong == []


def test_random_strings(words):
    dice = random.Random(11)
    signs = "aabcdeABZéÉßİıǅȺ ñ́ \t\n\x0b\x1c\x85\xa0.,;:!?'’`<|>_-~^$+=&*()[]{}0123½²٣中ﬁ"
    texts = ["".join(dice.choices(signs, k=dice.randrange(14))) for _ in range(6_000)]
    texts += ["it's DON'T we'LL 'S' ''s", "<|endoftext|> <|startoftext|>a <|ENDOFTEXT|>", "word!'s word<", "ÉTÉ... ÉTÉ'S"]
    want = [library(words, t) for t in texts]
    assert batched(words, pa.array(texts)) == want
    assert batched(words, pa.array(["x", *texts], pa.large_string()).slice(1)) == want


def test_null_empty_and_blank(words):
    assert batched(words, pa.array([None, "", " \n ", "a", None])) == [b"", b"", b"", library(words, "a"), b""]
    assert batched(words, pa.array([], pa.string())) == []
    assert batched(words, pa.array([None, None], pa.string())) == [b"", b""]


def test_few_spellings_are_kept_the_last_used(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED", 10)
    monkeypatch.setattr(tokens, "CACHED_PARTS", 20)
    words = tokens.WordTokens(tokenizer_path())
    for at in range(0, 300, 20):
        text = "stays " + " ".join("w" + chr(97 + n % 26) * (1 + n // 26) for n in range(at, at + 20))
        assert words.ids(text) == library(words, text)
        assert len(words.known) == len(words.spelled) <= 30 and "stays" in words.known.to_pylist()
        assert len(set(words.known.to_pylist())) == len(words.known)
    spelled = []
    monkeypatch.setattr(words, "_spell", lambda chunk: spelled.append(chunk) or b"")
    words.ids(text)
    assert spelled == []


def test_slices_by_size():
    texts = ["abcd", None, "é" * 50, "", "abc", "x" * 9, "y"]
    batch = pa.RecordBatch.from_pydict({"id": list(range(7)), "text": texts})
    got = list(tokens.by_size(batch.slice(0), 1, size=10))
    assert [b["id"].to_pylist() for b in got] == [[0, 1], [2], [3, 4], [5, 6]]
    assert [b.num_rows for b in tokens.by_size(batch.slice(2), 1, size=1 << 20, rows=2)] == [2, 2, 1]
    assert list(tokens.by_size(batch.slice(7), 1)) == []
