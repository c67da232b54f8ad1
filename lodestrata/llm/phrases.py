"""Phrase collocations by prefix-free parsing.

A piece of text is cut where the hash of ``overlap`` consecutive words says so, so equal
passages are cut alike wherever they stand.  Neighbouring chunks share these words.
The distinct chunks with their frequencies are the dictionary; phrases are
counted inside it, weighted, and a phrase belongs to the chunk in which it starts
before the shared words, so none counts twice.  Levels prune: two words are
counted only where both are frequent, longer phrases only where each two neighbours are.
What is frequent travels as a bitmap of fixed size, which can let through too much
(exact counts follow) and never too little.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _common as common

#: Fixed: what ends a piece; bytes.split() then splits at space and tab only.
ENDS = re.compile(rb"[.,;:!?\x0A-\x0D]")
#: Words after which a counting step hands on its sums, and bits of the map of frequent phrases.
BLOCK, BITS = 1_000_000, 27
ODD, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * STEP
    return x ^ (x >> np.uint64(29))


def _roll(h: np.ndarray, following: np.ndarray) -> np.ndarray:
    return _mix(h * ODD + following)


def parse(words: list[bytes], ends: list[int], overlap: int, rarity: int) -> Iterator[tuple[int, int, int]]:
    """(first word, word after the last, starts) of each chunk; ``ends``: where each piece ends.

    A chunk's first ``starts`` words are its own; the rest are the next chunk's too.
    """
    h = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    n = len(h) - overlap + 1
    cut = np.zeros(0, np.int64)
    if n > 0:
        window = h[:n]
        for k in range(1, overlap):
            window = _roll(window, h[k : k + n])
        cut = np.flatnonzero(_mix(window) % np.uint64(rarity) == 0)
    at, begin = 0, 0
    for end in ends:
        while at < len(cut) and cut[at] <= begin:
            at += 1
        while at < len(cut) and cut[at] + overlap < end:
            where = int(cut[at])
            yield begin, where + overlap, where - begin
            begin = where
            at += 1
        yield begin, end, end - begin
        begin = end


def chunks(docs: DataFrame, lang_col: str, text_col: str, overlap: int, rarity: int) -> DataFrame:
    """The dictionary: lang, chunk (words joined by spaces), starts, freq."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts, starts, held = [], [], [], 0
            for lang, text in zip(batch[0].to_pylist(), batch[1], strict=True):
                words, ends = [], []
                for piece in ENDS.split(text.as_py().encode().lower()):
                    if found := piece.split():
                        words += found
                        ends.append(len(words))
                for a, b, own in parse(words, ends, overlap, rarity):
                    texts.append(b" ".join(words[a:b]).decode())
                    langs.append(lang)
                    starts.append(own)
                held += len(words)
                if held > BLOCK:
                    yield pa.RecordBatch.from_arrays([pa.array(langs), pa.array(texts), pa.array(starts, pa.int64())], ["lang", "chunk", "starts"])
                    langs, texts, starts, held = [], [], [], 0
            if texts:
                yield pa.RecordBatch.from_arrays([pa.array(langs), pa.array(texts), pa.array(starts, pa.int64())], ["lang", "chunk", "starts"])

    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), common.text_or_empty(text_col).alias("text"))
    parsed = rows.mapInArrow(run, "lang string, chunk string, starts long")
    return parsed.groupBy("lang", "chunk", "starts").agg(F.count(F.lit(1)).alias("freq"))


class _Block:
    """The words of some chunks as numbers, with what a phrase may start at and where it must end."""

    def __init__(self, langs: pa.Array, texts: pa.Array, starts: np.ndarray, freq: np.ndarray):
        import xxhash

        lists = pc.split_pattern(texts, " ")
        first = lists.offsets.to_numpy().astype(np.int64)
        first -= first[0]
        sizes = np.diff(first)
        words, lang = lists.flatten().dictionary_encode(), langs.dictionary_encode()
        self.words, self.langs = words.dictionary, lang.dictionary
        pair = np.repeat(lang.indices.to_numpy().astype(np.int64), sizes) * len(self.words) + words.indices.to_numpy()
        kinds, self.id = np.unique(pair, return_inverse=True)
        self.lang_of, self.word_of = kinds // max(1, len(self.words)), kinds % max(1, len(self.words))
        hashed = np.array([xxhash.xxh3_64_intdigest(w) for w in self.words.to_pylist()], np.uint64)
        seeds = np.array([xxhash.xxh3_64_intdigest(x, 1) for x in self.langs.to_pylist()], np.uint64)
        self.hash = _roll(seeds[self.lang_of], hashed[self.word_of]) if len(kinds) else np.zeros(0, np.uint64)
        place = np.arange(first[-1]) - np.repeat(first[:-1], sizes)
        self.own = place < np.repeat(starts, sizes)
        self.room = np.repeat(sizes, sizes) - place
        self.weight = np.repeat(freq, sizes)

    def rows(self, name: np.ndarray, n: int, where: np.ndarray) -> pa.RecordBatch:
        """Sums of the phrases of ``n`` words that start at ``where``; ``name``: a number for each phrase there."""
        _, first, of = np.unique(name, return_index=True, return_inverse=True)
        sums = np.zeros(len(first), np.int64)
        np.add.at(sums, of, self.weight[where])
        at = where[first]
        parts = [self.words.take(pa.array(self.word_of[self.id[at + k]])) for k in range(n)]
        phrase = pc.binary_join_element_wise(*parts, " ") if n > 1 else parts[0]
        lang = self.langs.take(pa.array(self.lang_of[self.id[at]]))
        return pa.RecordBatch.from_arrays([lang, phrase, pa.array(np.full(len(first), n, np.int32)), pa.array(sums)], ["lang", "phrase", "n_words", "f"])


def _in(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    slot = h & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _counted(parsed: DataFrame, lengths: range, bitmap) -> DataFrame:
    """Counts (lang, phrase, n_words, f) of the phrases of these lengths whose shorter parts the bitmap lets through.

    Length 2 asks it for both words, longer ones for each two neighbours; without a bitmap all pass.
    """

    def block(langs, texts, starts, freq) -> Iterator[pa.RecordBatch]:
        b = _Block(langs, texts, starts, freq)
        if lengths[0] == 1:
            where = np.flatnonzero(b.own)
            yield b.rows(b.id[where], 1, where)
            return
        bits = np.frombuffer(bitmap.value, np.uint8)
        size, kinds = len(b.id), max(1, len(b.hash))
        if size < 2:
            return
        if lengths[0] == 2:
            good = _in(bits, b.hash)[b.id]
            pairs = good[:-1] & good[1:] & (b.room[:-1] > 1)
        else:
            pairs = (b.room[:-1] > 1) & _in(bits, _roll(b.hash[b.id[:-1]], b.hash[b.id[1:]]))
        where = np.flatnonzero(pairs & (lengths[0] > 2 or b.own[:-1]))
        name = b.id[where] * kinds + b.id[where + 1]
        if lengths[0] == 2:
            if len(where):
                yield b.rows(name, 2, where)
            return
        pairs = np.append(pairs, False)
        for n in lengths:
            # a phrase of n words is one of n - 1, numbered anew, and a word
            _, name = np.unique(name, return_inverse=True)
            longer = pairs[where + n - 2]
            where, name = where[longer], name[longer]
            name = name * kinds + b.id[where + n - 1]
            mine = b.own[where]
            if mine.any():
                yield b.rows(name[mine], n, where[mine])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words = [], 0
        for batch in batches:
            held.append(batch)
            words += max(batch[1].nbytes // 6, 1)
            if words > BLOCK:
                yield from _blocks(held, block)
                held, words = [], 0
        if held:
            yield from _blocks(held, block)

    return parsed.mapInArrow(run, "lang string, phrase string, n_words int, f long").groupBy("lang", "phrase", "n_words").agg(F.sum("f").alias("f"))


def _blocks(held: list[pa.RecordBatch], block) -> Iterator[pa.RecordBatch]:
    t = pa.Table.from_batches(held).combine_chunks()
    if t.num_rows:
        columns = [c.chunk(0) if c.num_chunks else c.combine_chunks() for c in t.columns]
        yield from block(columns[0], columns[1], columns[2].to_numpy(), columns[3].to_numpy())


def _bitmap(frequent: DataFrame):
    """Broadcast a bitmap of 2^BITS bits with the slot of each phrase (lang, phrase of one or two words) set.

    Slots are gathered into blocks of 32,768 bits in Spark, so at most 2^BITS / 32,768 rows of 4 KB reach the driver.
    """

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            out = np.zeros(batch.num_rows, np.uint64)
            seeds = np.array([xxhash.xxh3_64_intdigest(x, 1) for x in batch[0].to_pylist()], np.uint64)
            phrases = [p.split(" ") for p in batch[1].to_pylist()]
            if batch.num_rows:
                deep = [[xxhash.xxh3_64_intdigest(w) for w in p] for p in phrases]
                out = _roll(seeds, np.array([d[0] for d in deep], np.uint64))
                two = np.array([len(d) > 1 for d in deep])
                if two.any():
                    second = _roll(seeds[two], np.array([d[1] for d in deep if len(d) > 1], np.uint64))
                    out[two] = _roll(out[two], second)
            slot = (out & np.uint64((1 << BITS) - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(slot)], ["slot"])

    found = frequent.select("lang", "phrase").mapInArrow(slots, "slot long")
    parts = found.groupBy(F.shiftright("slot", 15).alias("part")).agg(F.expr("bitmap_construct_agg(slot & 32767)").alias("bits"))
    bitmap = np.zeros(1 << (BITS - 3), np.uint8)
    for row in parts.collect():
        bitmap[row["part"] * 4096 : row["part"] * 4096 + 4096] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return frequent.sparkSession.sparkContext.broadcast(bitmap.tobytes())


def frequent_phrases(
    docs: DataFrame, least: int = 100, longest: int = 5, rarity: int = 64, lang_col: str = "lang", text_col: str = "text"
) -> DataFrame:
    """lang, phrase, n_words, f, n for each phrase of 1 to ``longest`` words that occurs ``least`` times or more in its language.

    ``n``: all word occurrences of the language.  ``rarity``: one window in so many
    cuts; it changes no result.  Words are split at space and tab, pieces
    at ``.,;:!?`` and line ends; only A-Z are lower-cased.  Null languages count as ``und``, null
    texts as empty; repeated rows count each; an empty table gives no rows; other
    columns are ignored.
    """
    parsed = common.cut(chunks(docs, lang_col, text_col, max(1, longest - 1), rarity))
    words = common.cut(_counted(parsed, range(1, 2), None))
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    found = words.filter(F.col("f") >= least)
    levels = [found]
    for lengths in (range(2, 3), range(3, longest + 1)):
        if longest >= lengths[0]:
            bitmap = _bitmap(levels[-1])
            levels.append(common.cut(_counted(parsed, lengths, bitmap).filter(F.col("f") >= least)))
            bitmap.unpersist()
    out = levels[0]
    for level in levels[1:]:
        out = out.unionByName(level)
    return out.join(totals, "lang")


def _cuts() -> Column:
    """(k, left, right) of each cut of a phrase."""
    words = F.split("phrase", " ")

    def part(k: Column) -> Column:
        return F.struct(
            k.alias("k"),
            F.array_join(F.slice(words, F.lit(1), k), " ").alias("left"),
            F.array_join(F.slice(words, k + 1, F.size(words) - k), " ").alias("right"),
        )

    return F.transform(F.sequence(F.lit(1), F.col("n_words") - 1), part)


def collocations(
    docs: DataFrame, least: int = 100, longest: int = 5, share: int = 100, top: int = 2000, salts: int = 16, lang_col: str = "lang", text_col: str = "text"
) -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score (:func:`frequent_phrases` states the inputs).

    score: the least over all cuts of floor(1000 a n / (l r)), in exact decimals of 38
    digits; ties of cuts go to the shorter left part.  A phrase goes if one longer
    candidate around it has ``share`` percent of its count; as counts don't grow with length, one
    word more is enough to look at.  ``salts``: copies of the counts of single words,
    with which most cuts meet.
    """
    found = common.cut(frequent_phrases(docs, least, longest, lang_col=lang_col, text_col=text_col))
    candidates = found.filter("n_words > 1")
    inside = candidates.filter("n_words > 2").select(
        "lang",
        F.explode(F.expr("array(substring_index(phrase, ' ', n_words - 1), substring(phrase, instr(phrase, ' ') + 1))")).alias("phrase"),
        "f",
    )
    inside = inside.groupBy("lang", "phrase").agg(F.max("f").alias("around"))
    parts = found.select("lang", F.col("phrase").alias("part"), "f", "n_words")
    copies = F.when(F.col("n_words") == 1, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    parts = parts.select("lang", "part", "f", F.explode(copies).alias("salt"))

    def side(name: str, count: str) -> tuple[DataFrame, Column]:
        salt = F.when(F.instr(name, " ") > 0, 0).otherwise(F.pmod(F.xxhash64("phrase"), F.lit(salts)).cast("int"))
        return parts.select("lang", F.col("part").alias(name), F.col("f").alias(count), F.col("salt").alias(f"{name}_salt")), salt

    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), "n", F.explode(_cuts()).alias("c")).select("lang", "phrase", "a", "n", "c.*")
    for name, count in (("left", "l"), ("right", "r")):
        counts, salt = side(name, count)
        cuts = cuts.withColumn(f"{name}_salt", salt).join(counts, ["lang", name, f"{name}_salt"])
    exact = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r")}
    cuts = cuts.select("lang", "phrase", "a", "n", "k", "l", "r", (exact["a"] * exact["n"] * F.lit(1000).cast("decimal(4,0)")).alias("up"), (exact["l"] * exact["r"]).alias("down"))
    scored = cuts.withColumn("score", F.expr("up div down"))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
    kept = best.join(inside, ["lang", "phrase"], "left").filter(F.expr(f"around is null or 100 * around < {int(share)} * a"))
    order = Window.partitionBy("lang").orderBy(F.desc("b.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "b.l", "b.r", "n", "b.score")


#: The same rows in DuckDB: all phrases of one to five words, counted as they stand.
ORACLE = r"""
WITH pieces AS (
  SELECT lang, piece, row_number() OVER () AS id FROM (
    SELECT coalesce(lang, 'und') AS lang,
      unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)),
words AS (SELECT lang, id, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
starts AS (SELECT lang, id, w, unnest(range(1, len(w) + 1)) AS p FROM words),
grams AS (SELECT lang, array_to_string(w[p:p + m - 1], ' ') AS phrase, m FROM starts, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE p + m - 1 <= len(w)),
counted AS (SELECT lang, phrase, m, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE m = 1 GROUP BY lang),
found AS (SELECT * FROM counted WHERE f >= 100),
cuts AS (
  SELECT lang, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS lp, array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS rp
  FROM (SELECT *, unnest(range(1, m)) AS k FROM found WHERE m > 1)),
scored AS (
  SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, n, ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN found x ON x.lang = c.lang AND x.phrase = lp JOIN found y ON y.lang = c.lang AND y.phrase = rp JOIN totals t ON t.lang = c.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM found g WHERE g.lang = b.lang AND g.m > len(string_split(b.phrase, ' ')) AND g.f >= b.a AND contains(' ' || g.phrase || ' ', ' ' || b.phrase || ' ')))
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= 2000
"""
