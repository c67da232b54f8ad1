"""The cache of word ids stays small, whatever the texts, and the ids are the library's when it turns over."""

import pytest
from lodestrata.llm import _common as common
from lodestrata.llm import tokens
from lodestrata.llm.queries import tokenizer_path


def held(words):
    return sum(len(x) for x in vars(words).values() if isinstance(x, dict) and x is not words.alphabet)


def test_a_worker_holds_few_words():
    words = tokens.WordTokens(tokenizer_path())
    most = 0
    for at in range(0, 750_000, 3_000):
        words.ids(" ".join(f"w{chr(97 + n % 26)}{n:x}" for n in range(at, at + 3_000)))
        most = max(most, held(words))
    assert most < 2 * (tokens.CACHED + tokens.CACHED_PARTS) + 20_000


@pytest.mark.parametrize("size", [0, 7])
def test_ids_across_generations(monkeypatch, size):
    monkeypatch.setattr(tokens, "CACHED", size)
    monkeypatch.setattr(tokens, "CACHED_PARTS", size)
    words = tokens.WordTokens(tokenizer_path())
    texts = ["the House, the house; Été 12 don't", "", "a b c d e f g h i j k l", "the house été über-all naïve 北京 <|x", "12 don't the"] * 3
    for text in texts:
        want = words.tokenizer.encode(text, add_special_tokens=False).ids
        assert words.ids(text) == b"".join(i.to_bytes(4, "little") for i in want)


def test_batches_are_sliced():
    import pyarrow as pa

    batches = [pa.RecordBatch.from_pydict({"x": list(range(n))}) for n in (600, 0, 5)]
    got = list(common.sliced(batches, 256))
    assert [b.num_rows for b in got] == [256, 256, 88, 5]
    assert [x for b in got for x in b[0].to_pylist()] == [*range(600), *range(5)]
