"""Column functions of the toolkit: text, dates, amounts, labels."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: First days of the parliamentary terms.
TERM_STARTS = ("2005-05-06", "2010-05-06", "2015-05-07", "2017-06-08", "2019-07-04")


def employee_max(c: Column) -> Column:
    """Upper bound of a head-count band: null gives 0, ``51-100`` 100, ``10000+`` 10000; other text raises."""
    return F.coalesce(F.regexp_extract(c, r"(\d+)\+?$", 1).cast("int"), F.lit(0))


def step_decay(y: Column, at: float) -> Column:
    """1 up to ``at``, then an exponential fall to 0.1 at twice that."""
    return F.when(y <= at, 1.0).otherwise(F.exp(F.lit(math.log(0.1) / at) * (y - at)))


def clean_lines(c: Column, breaks: str = r"\R") -> Column:
    """Lines stripped of spaces of any kind, blank ones dropped, joined by one space; ``breaks`` matches a line's end."""
    lines = F.transform(F.split(c, breaks), lambda x: F.regexp_replace(x, r"^\p{Zs}+|\p{Zs}+\z", ""))
    return F.array_join(F.filter(lines, lambda x: x != ""), " ")


def collapse_ws(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def date_from_path(c: Column) -> Column:
    """The date of a ``debatesYYYY-MM-DD`` file name, as text; null without one."""
    return F.nullif(F.regexp_extract(c, r"debates(\d{4}-\d{2}-\d{2})", 1), F.lit(""))


def term_bucket(date: Column, starts: tuple[str, ...] = TERM_STARTS) -> Column:
    """Number of the half-open term that a date falls in, from 1; null before the first."""
    out = F.lit(None).cast("int")
    for n, start in enumerate(starts, 1):
        out = F.when(date >= F.lit(start).cast("date"), n).otherwise(out)
    return out


def split_list(c: Column, sep: str = ",") -> Column:
    return F.coalesce(F.transform(F.split(c, sep), lambda x: F.trim(x)), F.array().cast("array<string>"))


def parse_keywords(c: Column, sep: str = ",") -> Column:
    """An AND-combination: terms stripped, then ``~`` becomes a space (a word edge)."""
    return F.transform(F.split(c, sep), lambda x: F.replace(F.trim(x), F.lit("~"), F.lit(" ")))


def has_mission(c: Column, missions: tuple[str, ...] = ("ASF", "AHL", "AFS")) -> Column:
    return F.coalesce(c, F.lit("")).rlike("|".join(missions))


def preds_to_label(missions: dict[str, str]) -> Column:
    """Comma-joined missions (name -> 0/1 column) that are predicted, in order; none: empty."""
    return F.concat_ws(",", *[F.when(F.col(c) == 1, F.lit(m)) for m, c in missions.items()])


def with_provenance(text: Column, year: Column, speaker: Column, party: Column) -> Column:
    """The speech with a note on when, by whom and for which party it was held (null prints as None)."""
    none = F.lit("None")
    said = [F.lit("This speech was held in "), F.coalesce(year, none), F.lit(" by "), F.coalesce(speaker, none)]
    return F.concat(text, *said, F.lit(". Party: "), F.coalesce(party, none))


def sentences(c: Column) -> Column:
    return F.split(c, r"(?<=[.!?]) +")


def truncate_tokens(c: Column, n: int = 512) -> Column:
    """The first ``n`` white-space separated tokens."""
    return F.array_join(F.slice(F.split(c, r"\s+"), 1, n), " ")


def vector_from_text(c: Column) -> Column:
    """``[0.1 0.2 ...]`` as an array of doubles."""
    return F.split(F.trim(F.regexp_replace(c, r"[\[\]]", "")), r"\s+").cast("array<double>")


def sample_key(c: Column, seed: int) -> Column:
    """A repeatable random order of ids, the same in other engines."""
    return F.md5(F.concat(c.cast("string"), F.lit(f"-{seed}")).cast("binary"))


def argmax(c: Column) -> Column:
    return (F.array_position(c, F.array_max(c)) - 1).cast("int")
