"""Byte-level BPE under a public vocabulary: a queue of merge ranks over a linked list of symbols.

A word's bytes are symbols of a doubly linked list.  A heap holds each neighbouring
pair that the vocabulary merges, by (rank, place).  The least is taken, and skipped as
stale if its left symbol is gone or its pair has changed since; otherwise the right
symbol is unlinked and the two new neighbours are queued.  A word of n bytes costs
O(n log n) whatever its length.  Decoding joins the vocabulary's strings.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import byte_alphabet

#: Entries after which a worker's cache of words starts anew, and the longest word kept there (memory, not a cap on texts).
CACHED, KEPT_CHARS = 600_000, 64
#: Bytes of ids and text after which a step hands on what it has.
FLUSH = 8 << 20
#: Fixed: how the byte-level pre-tokenizer of the vocabulary file splits a text.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Bpe:
    """One vocabulary file with its merges; a file that asks for more than plain byte-level BPE is refused."""

    def __init__(self, path: str):
        from tokenizers.pre_tokenizers import ByteLevel

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre, added = spec["model"], spec["pre_tokenizer"] or {}, spec["added_tokens"]
        plain = model.get("type", "BPE") == "BPE" and not any(
            model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        )
        plain &= spec["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        plain &= not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added)
        if not plain:
            raise ValueError(f"{path} is not a plain byte-level BPE vocabulary")
        vocab, alphabet = model["vocab"], byte_alphabet()
        self.size = 1 + max([*vocab.values(), *(t["id"] for t in added)])
        self.symbols = [vocab[alphabet[b]] for b in range(256)]
        self.pairs = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.pairs[vocab[a] * self.size + vocab[b]] = (rank, vocab[a + b])
        self.added = {t["content"]: t["id"] for t in added if t["content"]}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if longest_first else None
        self.split = regex.compile(PIECES).findall
        byte_of = {c: b for b, c in alphabet.items()}
        self.strings = {}
        for token, i in [*vocab.items(), *self.added.items()]:
            known = all(c in byte_of for c in token)
            self.strings[i] = bytes(byte_of[c] for c in token) if known else token.encode()
        self.known: dict[str, bytes] = {}
        self.agreed: dict[str, bool] = {}
        self.library = ByteLevel(add_prefix_space=False)

    @staticmethod
    @cache
    def of(path: str) -> Bpe:
        return Bpe(path)

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token's bytes."""
        ids = [self.symbols[b] for b in word]
        n, size, pairs = len(ids), self.size, self.pairs
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = []
        for i in range(n - 1):
            if found := pairs.get(ids[i] * size + ids[i + 1]):
                queue.append((found[0], i, found[1]))
        heapq.heapify(queue)
        while queue:
            rank, i, new = heapq.heappop(queue)
            j = after[i]
            if ids[i] < 0 or j == n or pairs.get(ids[i] * size + ids[j]) != (rank, new):
                continue  # stale
            ids[i], ids[j], k = new, -1, after[j]
            after[i] = k
            if k < n:
                before[k] = i
                if found := pairs.get(new * size + ids[k]):
                    heapq.heappush(queue, (found[0], i, found[1]))
            if (h := before[i]) >= 0 and (found := pairs.get(ids[h] * size + new)):
                heapq.heappush(queue, (found[0], h, found[1]))
        return [i for i in ids if i >= 0]

    def _words(self, text: str) -> list[str]:
        """Pre-tokens of a text.

        Two libraries' tables of letters and numbers may be of different Unicode versions, so each character beyond
        the Latin ones is tried once in both; a text that holds one they class differently is split by the vocabulary's own library.
        """
        if text.isascii() or max(text) < "\u0250":
            return self.split(text)
        for c in set(text):
            agree = self.agreed.get(c)
            if agree is None:
                probe = f"a{c}1{c}!{c} {c}"
                agree = self.agreed[c] = self.split(probe) == [probe[x:y] for _, (x, y) in self.library.pre_tokenize_str(probe)]
            if not agree:
                return [text[x:y] for _, (x, y) in self.library.pre_tokenize_str(text)]
        return self.split(text)

    def _plain(self, text: str) -> bytes:
        words = self._words(text)
        parts = list(map(self.known.get, words))
        if None in parts:
            if len(self.known) > CACHED:
                self.known.clear()
            for at, part in enumerate(parts):
                if part is None:
                    word = words[at]
                    if (ids := self.known.get(word)) is None:
                        ids = array("I", self.merge(word.encode())).tobytes()
                        if len(word) <= KEPT_CHARS:
                            self.known[word] = ids
                    parts[at] = ids
        return b"".join(parts)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text; an added token's own string in it gives that token's id."""
        if self.special and any(t in text for t in self.added):
            parts = self.special.split(text)
            ids = [np.uint32(self.added[p]).tobytes() if i % 2 else self._plain(p) for i, p in enumerate(parts)]
            return np.frombuffer(b"".join(ids), "<u4")
        return np.frombuffer(self._plain(text), "<u4")

    def decode(self, ids: list[int]) -> str:
        """The ids' strings joined; ids outside the vocabulary give nothing, bytes that are no UTF-8 the replacement character."""
        try:
            joined = b"".join([self.strings[i] for i in ids])
        except KeyError:
            joined = b"".join([self.strings.get(i, b"") for i in ids])
        return joined.decode("utf-8", "replace")


def _step(df: DataFrame, path: str, source: str, ids_col: str | None, text_col: str | None) -> DataFrame:
    """Add the ids of the text column ``source``, or the text of an id column ``source``, or both, in one Arrow pass."""
    from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

    encodes = ids_col is not None
    made = [c for c in (ids_col, text_col) if c]
    keep = [f for f in df.schema.fields if f.name not in made]
    names = [f.name for f in df.schema.fields]
    if len(set(names)) < len(names):
        raise ValueError("column names must differ")
    schema = StructType([*keep])
    if ids_col:
        schema = schema.add(ids_col, ArrayType(IntegerType(), False), False)
    if text_col:
        schema = schema.add(text_col, StringType(), False)
    at, kept = names.index(source), [names.index(f.name) for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe.of(path)

        def out(batch: pa.RecordBatch, first: int, ids: list[np.ndarray], texts: list[str]) -> pa.RecordBatch:
            columns = [batch.column(i).slice(first, max(len(ids), len(texts))) for i in kept]
            if ids_col:
                ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
            if text_col:
                columns.append(pa.array(texts, pa.string()))
            return pa.RecordBatch.from_arrays(columns, [f.name for f in schema.fields])

        for batch in batches:
            first, held, ids, texts = 0, 0, [], []
            for i in range(batch.num_rows):
                value = batch.column(at)[i].as_py()
                if encodes:
                    ids.append(bpe.encode(value or ""))
                    held += ids[-1].nbytes
                if text_col:
                    texts.append(bpe.decode(ids[-1].tolist() if encodes else [x for x in value or [] if x is not None]))
                    held += len(texts[-1])
                if held > FLUSH:
                    yield out(batch, first, ids, texts)
                    first, held, ids, texts = i + 1, 0, [], []
            if ids or texts:
                yield out(batch, first, ids, texts)

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, tokenizer: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` with the token ids of ``text_col`` (array of int) in ``ids_col``.

    ``tokenizer``: path of a byte-level BPE file, the same on every machine.  No
    special token is added; one that stands in the text counts as itself.  Null and
    empty texts give no ids.  Rows are independent: no shuffle, repeated rows are
    encoded each, other columns (nulls included) pass through, a column named
    ``ids_col`` is replaced, an empty table gives no rows.
    """
    return _step(df, tokenizer, text_col, ids_col, None)


def decode(df: DataFrame, tokenizer: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with the text of ``ids_col`` in ``text_col``; null and empty arrays give an empty text, null and unknown ids nothing."""
    return _step(df, tokenizer, ids_col, None, text_col)


def round_trip(df: DataFrame, tokenizer: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """:func:`encode` and :func:`decode` of its ids in one pass over the texts."""
    return _step(df, tokenizer, text_col, ids_col, decoded_col)


def digests(coded: DataFrame, ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """Per document: doc_id, n_tokens, and SHA-256 of its ids (decimal, joined by commas) and of its decoded text."""
    ids = F.col(ids_col)
    return coded.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded_col).cast("binary"), 256).alias("decoded_sha256"),
    )
