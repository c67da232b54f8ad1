"""I-Match fingerprints over randomised lexicons, in DataFrame functions only.

A document's terms are its distinct lower-cased words.  Terms in a band of document
frequency (relative to the number of documents) form the lexicon; randomised
subsets of it are drawn by bits of the terms' hashes, disjoint at one density, in densities 1, 1/2,
1/4, ...  A document takes the two densities that leave it few terms in a subset, and its fingerprint
holds, for each density and subset, a hash of its sorted terms there.  Likeness is
the share of equal hashes among the subsets of the densities that two documents have
in common.

Frequencies count distinct texts, so copies don't drive their own terms out of the band.
A document of which the band holds a small part only (one of many near-copies, say)
adds the same two levels over all its terms, marked ``*``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _common as common

SUBSETS = 16
#: Terms in at least / at most this share of the documents form the lexicon.
BAND = (0.0005, 0.05)
#: Terms are told apart by a hash of so many bits, which bounds the lexicon at any corpus size.
TERM_BITS = 21
#: Rows in one range of neighbours, and ranges at most: their bounds are read by the driver.
RANGE, RANGES = 128, 4096
#: Under this share of terms in the band, a document adds levels over all its terms: an edited third may bring up to 1/3.
THIN = 0.4


def terms(body: Column) -> Column:
    """Hashes of the distinct lower-cased words of the text."""
    words = F.array_remove(F.split(F.lower(body), r"[\x20\x09-\x0D]+"), "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def _slot(term: Column) -> Column:
    return F.shiftrightunsigned(term, 64 - TERM_BITS).cast("int")


def lexicon(docs: DataFrame, band: tuple[float, float] = BAND) -> DataFrame:
    """One row: a bit for each hashed term (64 to a long) that tells whether its share of the distinct texts lies in the band.

    All rare terms of a document together add its (number of terms) / 2^21 to the mean
    share of a slot, far under the band, at any number of documents.
    """
    texts = docs.select(F.xxhash64("body").alias("text"), F.array_distinct(F.transform(terms(F.col("body")), _slot)).alias("slots"))
    n = texts.select("text").distinct().count()
    slots = texts.groupBy("text").agg(F.first("slots").alias("slots")).select(F.explode("slots").alias("slot"))
    by = slots.groupBy("slot").agg(F.count(F.lit(1)).alias("df"))
    held = by.filter((F.col("df") >= max(2.0, band[0] * n)) & (F.col("df") <= max(2.0, band[1] * n)))
    words = held.groupBy(F.shiftright("slot", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, slot & 63)")).alias("bits"))
    every = docs.sparkSession.range(1 << (TERM_BITS - 6)).select(F.col("id").cast("int").alias("at"))
    filled = every.join(words, "at", "left").select(F.struct("at", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")).alias("w"))
    return filled.agg(F.sort_array(F.collect_list("w")).alias("ws")).select(F.transform("ws", lambda w: w["bits"]).alias("bits"))


def band_terms(hashed: Column, bits: Column) -> Column:
    """The sorted ones of each text's hashed terms that are in the lexicon; ``hashed``: an array of texts."""

    def told(h: Column) -> Column:
        word = F.element_at(bits, F.shiftrightunsigned(h, 70 - TERM_BITS).cast("int") + 1)
        return F.call_function("shiftrightunsigned", word, _slot(h).bitwiseAND(F.lit(63))).bitwiseAND(F.lit(1).cast("long")) == 1

    return F.transform(hashed, lambda one: F.sort_array(F.filter(one, told)))


def thin_terms(hashed: str, kept: str) -> Column:
    """All sorted hashed terms where few of them are in the lexicon, elsewhere none."""
    return F.when(F.size(kept) < THIN * F.size(hashed), F.sort_array(hashed)).otherwise(F.array().cast("array<bigint>"))


def density(kept: str) -> Column:
    """Density d keeps one term in 2^d, so that a subset holds one to two terms on average (two to four at d - 1)."""
    n = F.size(kept)
    return F.when(n > 0, F.floor(F.log2(n.cast("double")))).otherwise(0).cast("int")


def mask(d: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), d) - 1


def fingerprint(kept: str, d: str, subsets: int = SUBSETS) -> Column:
    """``all|d:h,h,...|d-1:h,h,...``: a hash of all band terms (of all words where no word is in the band), then for two
    densities one hash a subset (``-`` where the subset holds none of the terms).  Where the band is thin, two levels over
    all terms follow: ``|*d:h,h,...|*d-1:h,h,...``."""
    whole = F.when(F.size(kept) > 0, F.hex(F.xxhash64(kept))).otherwise(F.hex(F.xxhash64(F.sort_array(f"hashed_{kept}"))))
    lower = F.greatest(F.col(d) - 1, F.lit(0))
    levels = [_level(kept, F.col(d), f"{d}_mask", subsets), _level(kept, lower, f"{d}_mask_lower", subsets)]
    every, e = f"every_{kept}", f"d_every_{kept}"
    wide = [_level(every, F.col(e), f"{e}_mask", subsets), _level(every, F.greatest(F.col(e) - 1, F.lit(0)), f"{e}_mask_lower", subsets)]
    return F.concat_ws("|", whole, *levels, *[F.when(F.size(every) > 0, F.concat(F.lit("*"), x)) for x in wide])


def _level(kept: str, d: Column, mask: str, subsets: int) -> Column:
    drawn = F.filter(kept, lambda t: t.bitwiseAND(F.col(mask)) < subsets)
    inside = F.transform(
        F.sequence(F.lit(0).cast("long"), F.lit(subsets - 1).cast("long")), lambda r: F.filter(drawn, lambda t: t.bitwiseAND(F.col(mask)) == r)
    )
    hashes = F.transform(inside, lambda a: F.when(F.size(a) > 0, F.substring(F.hex(F.xxhash64(a)), 1, 8)).otherwise("-"))
    return F.concat(d.cast("string"), F.lit(":"), F.array_join(hashes, ","))


def likeness(a: str, b: str) -> Column:
    """Share of equal subset hashes, 0 to 1, the best of the densities that both fingerprints have; equal fingerprints: 1."""
    left, right = F.split(F.col(a), r"\|"), F.split(F.col(b), r"\|")

    def share(x: Column, y: Column) -> Column:
        """Null unless both are of one density and some subset holds terms of either."""
        pairs = F.arrays_zip(F.split(F.substring_index(x, ":", -1), ",").alias("x"), F.split(F.substring_index(y, ":", -1), ",").alias("y"))
        told = F.filter(pairs, lambda p: (p["x"] != "-") | (p["y"] != "-"))
        equal = F.filter(told, lambda p: p["x"] == p["y"])
        same = F.substring_index(x, ":", 1) == F.substring_index(y, ":", 1)
        return F.when(same & (F.size(told) > 0), F.size(equal) / F.size(told))

    levels = [(i, j) for own in ((1, 2), (3, 4)) for i in own for j in own]
    found = F.greatest(*[share(F.get(left, i), F.get(right, j)) for i, j in levels])
    return F.when(F.col(a) == F.col(b), 1.0).otherwise(F.coalesce(found, F.lit(0.0)))


def _bounds(docs: DataFrame) -> tuple[list[int], list[int], int]:
    """Ids that cut the table into ranges of about RANGE rows, how many ranges begin with each, and ranges for null ids."""
    n, known = docs.agg(F.count(F.lit(1)), F.count("doc_id")).first()
    ranges = min(RANGES, -(-known // RANGE))
    found = docs.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 8 * RANGES)).first()[0] if ranges > 1 else []
    bounds = sorted(set(found or []))
    return bounds, [found.count(b) for b in bounds], min(RANGES, -(-(n - known) // RANGE))


def part_of(bounds: list[int], times: list[int], unknown: int) -> Column:
    """The range of (doc_id, tie): ranges are numbered as they ascend, null ids first; an id that fills several is split by ``tie``."""
    at, tie = F.lit(0), F.shiftright("tie", 32)

    def share(of: Column) -> Column:
        return F.shiftright(tie * of, 31)

    if bounds:
        ids = F.lit(bounds)
        steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(bounds).bit_length()))])
        at = F.aggregate(steps, F.lit(0), lambda had, step: F.when(F.get(ids, had + step - 1) <= F.col("doc_id"), had + step).otherwise(had))
    at = at.cast("long")
    first = F.lit(False) if not bounds else F.coalesce(F.get(F.lit(bounds), at.cast("int") - 1) == F.col("doc_id"), F.lit(False))
    many = F.lit(1) if not bounds else F.coalesce(F.get(F.lit(times), at.cast("int") - 1), F.lit(1))
    known = F.shiftleft(2 * at + 2, 20) + F.when(first, share(many.cast("long"))).otherwise(F.lit(1 << 20))
    return F.when(F.col("doc_id").isNull(), share(F.lit(max(1, unknown)).cast("long"))).otherwise(known)


def rings(docs: DataFrame) -> DataFrame:
    """(part, doc_id, tie, body, guest): documents in ranges of ids, each with the first document of the next range below as a guest.

    ``docs``: (doc_id, body).  Read by descending id and ``tie`` (a hash of the text), guest last, a range holds every
    document's successor; below the lowest range comes the highest.  Null ids are below
    all others.  Rows equal in id and text stay in one range.
    """
    tied = docs.withColumn("tie", F.shiftrightunsigned(F.xxhash64("body"), 1))
    rows = tied.withColumn("part", part_of(*_bounds(docs)))
    top = F.max(F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), "tie")).alias("top")
    firsts = sorted((r["part"], r["top"]["tie"]) for r in rows.groupBy("part").agg(top).collect())  # a few thousand ranges at most
    above = [(part, firsts[(i + 1) % len(firsts)][0], tie) for i, (part, tie) in enumerate(firsts)]
    guests = docs.sparkSession.createDataFrame(above, "part long, to long, tie long")
    found = rows.join(F.broadcast(guests), ["part", "tie"]).groupBy("to").agg(F.first("body").alias("body"))
    guest = found.select(F.col("to").alias("part"), F.lit(None).cast("long").alias("doc_id"), F.lit(-1).cast("long").alias("tie"), "body", F.lit(1).alias("guest"))
    return rows.select("part", "doc_id", "tie", "body", F.lit(0).alias("guest")).unionByName(guest)


def fingerprints(
    docs: DataFrame, band: tuple[float, float] = BAND, subsets: int = SUBSETS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Fingerprint every text and its edited form.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.  The edited text has its last floor(n/3) code points
    replaced by the first as many (or all) of the next document's, by descending id;
    after the last comes the first.  Null text: empty.  Null ids come last; rows with
    one id follow each other by descending hash of the text.  An empty table gives no rows; other
    columns are ignored.  Texts are dealt out once; all else happens where they are.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), common.text_or_empty(text_col).alias("body"))
    bits = common.cut(lexicon(rows, band)).scalar()
    order = Window.partitionBy("part").orderBy("guest", F.col("doc_id").desc_nulls_last(), F.col("tie").desc())
    third = "cast(floor(length(body) / 3) as int)"
    edited = F.concat(F.expr(f"substring(body, 1, length(body) - {third})"), F.expr(f"substring(next_body, 1, {third})"))
    paired = rings(rows).withColumn("next_body", F.coalesce(F.lead("body").over(order), F.lit(""))).withColumn("edited", edited)
    own = ["part", "guest", "doc_id", "tie"]
    hashed = paired.select(
        *own,
        F.length("body").cast("long").alias("n_chars"),
        F.when(F.col("guest") == 0, F.sha2(F.col("edited").cast("binary"), 256)).alias("edited_sha256"),
        F.array(terms(F.col("body")), terms(F.col("edited"))).alias("hashed"),
        bits.alias("bits"),
    )
    # the lexicon is named once, so that no row carries it
    kept = hashed.withColumn("in_band", band_terms(F.col("hashed"), F.col("bits"))).drop("bits")
    names = ("kept", "kept_edited")
    for i, name in enumerate(names):
        kept = kept.withColumn(name, F.col("in_band")[i]).withColumn(f"hashed_{name}", F.col("hashed")[i])
    kept = kept.drop("in_band", "hashed").withColumns({f"every_{name}": thin_terms(f"hashed_{name}", name) for name in names})
    levels = [f"{x}{name}" for name in names for x in ("", "every_")]
    # columns of their own, since lambdas would compute them anew for each term
    kept = kept.withColumns({f"d_{name}": density(name) for name in levels})
    kept = kept.withColumns({f"d_{name}_mask": mask(F.col(f"d_{name}")) for name in levels} | {f"d_{name}_mask_lower": mask(F.greatest(F.col(f"d_{name}") - 1, F.lit(0))) for name in levels})
    told = kept.select(
        *own, "n_chars", "edited_sha256", fingerprint("kept", "d_kept", subsets).alias("fingerprint"), fingerprint("kept_edited", "d_kept_edited", subsets).alias("edited_fingerprint")
    )
    near = told.withColumn("next_fingerprint", F.lead("fingerprint").over(order)).filter("guest = 0")
    return near.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )
