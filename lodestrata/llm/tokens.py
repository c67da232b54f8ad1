"""Token ids of texts under a public word-level BPE file; words are spelled once a batch and cached by a process."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: A process keeps the spellings of so many chunks and parts, together (memory of a worker, not a cap on texts).
CACHED, CACHED_PARTS = 100_000, 200_000

#: A plain chunk: letters of ASCII and plain Latin, then ASCII punctuation but ' (contractions) and < (special tokens).
PLAIN = r"^(?P<word>[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}]*)(?P<tail>[!-&(-/:;=-@\[-`{-~]*)$"


def byte_alphabet() -> dict[int, str]:
    """Byte-level BPE writes each byte as a printable character: printable Latin-1 stays, others follow from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


def by_size(batch: pa.RecordBatch, texts: int, size: int = 3 << 20, rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose texts (column number ``texts``) have so many bytes; a longer text is a slice of its own."""
    ends, at = np.cumsum(pc.binary_length(batch[texts]).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)), 0
    while at < batch.num_rows:
        most = int(ends[at - 1] if at else 0) + size
        to = min(max(at + 1, int(np.searchsorted(ends, most, "right"))), at + rows)
        yield batch.slice(at, to - at)
        at = to


class WordTokens:
    """Ids of white-space separated chunks, joined as little-endian unsigned 32-bit integers.

    The tokenizer drops white space and never merges across it, so a text's ids are
    its chunks' ids in order.  Arrow splits a batch's texts, tells its distinct chunks and parts the plain ones
    into a word and a tail; what no batch before had goes to the BPE model, an odd chunk cut by the tokenizer's
    pattern or through the whole tokenizer.  The spellings used last are kept, as arrays.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known, self.spelled = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.alphabet = byte_alphabet()
        self.pattern = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

    @staticmethod
    @cache
    def of(path: str) -> WordTokens:
        return WordTokens(path)

    def _spell(self, chunk: str) -> bytes:
        low = chunk.lower()
        if chunk.isascii() and chunk.isprintable() and "<|" not in chunk:
            ids = [t.id for part in ([low] if low.isalpha() else self.pattern.findall(low)) for t in self.model.tokenize(part)]
        elif chunk.isalpha() and max(chunk) < "ɐ" and "İ" not in chunk:
            ids = [t.id for t in self.model.tokenize(low.encode().decode("latin-1").translate(self.alphabet))]
        else:
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        return b"".join([i.to_bytes(4, "little") for i in ids])

    def _spellings(self, chunks: pa.Array) -> pa.Array:
        """The ids of distinct chunks; these come first in what is kept."""
        at = pc.index_in(chunks, value_set=self.known)
        fresh, old = at.is_null().to_numpy(zero_copy_only=False), at.drop_null().to_numpy()
        places = at.fill_null(0).to_numpy().astype(np.int64)
        places[fresh] = len(self.known) + np.arange(fresh.sum())
        new = pa.array(map(self._spell, chunks.filter(pa.array(fresh)).to_pylist()), pa.large_binary())
        found = pa.concat_arrays([self.spelled, new]).take(pa.array(places))
        most, rest = CACHED + CACHED_PARTS, np.ones(len(self.known), bool)
        rest[old] = False
        rest = pa.array(np.flatnonzero(rest)[: max(0, most - len(chunks))])
        self.known = pa.concat_arrays([chunks[:most], self.known.take(rest)])
        self.spelled = pa.concat_arrays([found[:most], self.spelled.take(rest)])
        return found

    def batch(self, texts: pa.Array) -> tuple[memoryview, list[int]]:
        """All texts' ids in a row, and the bytes at which the first text's start and each text's end."""
        lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
        chunks = lists.values.dictionary_encode()
        word, tail = pc.extract_regex(chunks.dictionary, PLAIN).flatten()
        word, tail = pc.coalesce(pc.utf8_lower(word), chunks.dictionary), tail.fill_null("")
        parts = pa.concat_arrays([word, tail]).dictionary_encode()
        ids = self._spellings(parts.dictionary).take(parts.indices)
        ids = pc.binary_join_element_wise(ids[: len(word)], ids[len(word) :], pa.scalar(b"", pa.large_binary())).take(chunks.indices)
        _, ends, data = ids.buffers()
        ends = np.frombuffer(ends, np.int64)[ids.offset :] if len(ids) else np.zeros(1, np.int64)
        return memoryview(data or b""), ends[lists.offsets.to_numpy()].tolist()

    def ids(self, text: str) -> bytes:
        data, (start, end) = self.batch(pa.array([text.encode("utf-8", "replace").decode()]))
        return bytes(data[start:end])
