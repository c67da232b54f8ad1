"""Debates: headings, speakers' parties, terms, shares, terms of topics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import sentences


def headings(rows: DataFrame, strict: bool = False) -> DataFrame:
    """Speeches with the major and minor heading above them.

    ``rows``: (path, pos, tag, text) with tags major-heading, minor-heading, speech.
    A major heading resets the minor one; with ``strict`` only if its text changes, and
    files without minor headings are left out.
    """
    upto = Window.partitionBy("path").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    major = F.when(F.col("tag") == "major-heading", F.col("text"))
    out = rows.withColumn("major_heading", F.last(major, ignorenulls=True).over(upto))
    if strict:
        whole = Window.partitionBy("path")
        out = out.withColumn("_any", F.max(F.col("tag") == "minor-heading").over(whole)).filter("_any").drop("_any")
        before = F.lag("major_heading").over(Window.partitionBy("path").orderBy("pos"))
        new = (F.col("tag") == "major-heading") & ~before.eqNullSafe(F.col("major_heading"))
    else:
        new = F.col("tag") == "major-heading"
    out = out.withColumn("_new", new.cast("int")).withColumn("_part", F.sum("_new").over(upto))
    inside = Window.partitionBy("path", "_part").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    minor = F.when(F.col("tag") == "minor-heading", F.col("text"))
    out = out.withColumn("minor_heading", F.last(minor, ignorenulls=True).over(inside))
    return out.filter(F.col("tag") == "speech").drop("_new", "_part", "tag")


def clean_memberships(df: DataFrame) -> DataFrame:
    """Memberships with a full start date, an end date of this century and a party."""
    return df.filter((F.length("start_date") > 4) & F.col("end_date").startswith("20") & F.col("on_behalf_of_id").isNotNull())


#: Fixed value: 2^22 days reach past the year 9999.
DAY_LEVELS = 22


def _day_blocks(start: str, end: str) -> Column:
    """The fewest blocks of 2^level days, each starting at a multiple of its length, that make up the days from ``start`` to ``end``."""
    ends = f"transform(sequence(0, {DAY_LEVELS}), k -> named_struct('level', k, 'lo', -shiftright(-unix_date({start}), k), 'hi', shiftright(unix_date({end}) + 1, k)))"
    first = "if(x.lo < x.hi and (x.lo & 1) = 1, array(named_struct('level', x.level, 'block', x.lo)), array())"
    last = "if(x.lo < x.hi and (x.hi & 1) = 1, array(named_struct('level', x.level, 'block', x.hi - 1)), array())"
    return F.expr(f"flatten(transform({ends}, x -> concat({first}, {last})))")


def first_term(days: DataFrame, memberships: DataFrame) -> DataFrame:
    """(person_id, day, term): of the person's terms that hold the day the first in list order; pairs without such a term are left out.

    A term becomes a row for each of its blocks of days, at most two a length, and only the first term of a
    person's block is kept; a day asks for the one block of each length that holds it.  So neither terms nor days
    meet by person alone: many terms of one person spread over blocks, and equal blocks are reduced before they travel.
    """
    term = F.struct("pos", "a", "b", F.col("on_behalf_of_id").alias("party"))
    terms = memberships.withColumns({"a": F.to_date("start_date"), "b": F.to_date("end_date")}).filter("a is not null and b is not null and person_id is not null")
    blocks = terms.select("person_id", "pos", F.explode(_day_blocks("a", "b")).alias("x"))
    # numbers alone are reduced by hash as they come; a term with its text would be sorted with all its blocks
    blocks = blocks.groupBy("person_id", "x.level", "x.block").agg(F.min("pos").alias("pos"))
    # no more numbers than there are lengths
    levels = blocks.agg(F.collect_set("level")).scalar()
    asked = days.filter("person_id is not null and day is not null").select("person_id", "day").distinct().withColumn("_levels", levels)
    asked = asked.select("person_id", "day", F.explode("_levels").alias("level")).withColumn("block", F.expr("shiftright(unix_date(day), level)"))
    first = asked.join(blocks, ["person_id", "level", "block"]).groupBy("person_id", "day").agg(F.min("pos").alias("pos"))
    held = first.join(terms.select("person_id", "pos", "a", "b", term.alias("term")), ["person_id", "pos"]).filter("day between a and b")
    return held.groupBy("person_id", "day").agg(F.min("term").alias("term"))


def speaker_party(speeches: DataFrame, memberships: DataFrame) -> DataFrame:
    """Party of a speech: its membership id's if it has one (unknown: null), else the person's first term in list order that holds the date.

    ``memberships``: (pos, id, person_id, on_behalf_of_id, start_date, end_date); of
    repeated ids the last counts.  Null without an id where person or date is null; terms with a null date, or that end
    before they start, hold no day.  Every speech gives one row.
    """
    last = F.max(F.struct("pos", "on_behalf_of_id"))["on_behalf_of_id"]
    by_id = memberships.filter("id is not null").groupBy(F.col("id").alias("speaker_id")).agg(last.alias("_by_id"))
    said = speeches.select(*[c for c in speeches.columns if c != "party"]).withColumn("_day", F.to_date("date"))
    # null keys would all meet in one task: each speech goes only into the join that can answer it
    named = F.col("speaker_id").isNotNull()
    asks = ~named & F.col("person_id").isNotNull() & F.col("_day").isNotNull()
    terms = first_term(said.filter(asks).select("person_id", F.col("_day").alias("day")), memberships)
    terms = terms.select("person_id", F.col("day").alias("_day"), F.col("term.party").alias("_by_person"))
    out = [
        said.filter(named).join(by_id, "speaker_id", "left").withColumn("party", F.col("_by_id")),
        said.filter(asks).join(terms, ["person_id", "_day"], "left").withColumn("party", F.col("_by_person")),
        said.filter(~named & ~asks).withColumn("party", F.lit(None).cast("string")),
    ]
    columns = [*[c for c in said.columns if c != "_day"], "party"]
    return out[0].select(*columns).unionByName(out[1].select(*columns)).unionByName(out[2].select(*columns))


def length_bucket(df: DataFrame, text: str = "text", tol: float = 0.1) -> DataFrame:
    """short / average / long against the mean length, within ``tol``."""
    mean = df.agg(F.avg(F.length(text)).alias("m")).scalar()
    n = F.length(text)
    out = df.withColumn("_mean", mean)
    return out.withColumn("bucket", F.when(n < F.col("_mean") * (1 - tol), "short").when(n > F.col("_mean") * (1 + tol), "long").otherwise("average")).drop("_mean")


def count_per_year(df: DataFrame, year: Column, start: int, end: int) -> DataFrame:
    """Rows of every year in [start, end), zeros included."""
    years = df.sparkSession.range(start, end).select(F.col("id").cast("int").alias("year"))
    counts = df.groupBy(year.cast("int").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    return years.join(counts, "year", "left").select("year", F.coalesce("n", F.lit(0)).alias("n"))


def value_counts(df: DataFrame, col: str, order: str = "count") -> DataFrame:
    """Rows of each value but null, the most frequent first or (``order="key"``) by value."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(col) if order == "key" else counts.orderBy(F.desc("n"), col)


def shares(hits: DataFrame, all_rows: DataFrame, keys: list[str]) -> DataFrame:
    """Hits over all rows per key, for keys that both have."""
    a = hits.groupBy(*keys).agg(F.count(F.lit(1)).alias("hits"))
    b = all_rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"))
    return a.join(b, keys).withColumn("share", F.try_divide("hits", "total"))


def share_per_year(hits: DataFrame, all_rows: DataFrame) -> DataFrame:
    return shares(hits, all_rows, ["year"]).orderBy("year")


def share_per_party(hits: DataFrame, all_rows: DataFrame) -> DataFrame:
    return shares(hits, all_rows, ["party"]).orderBy(F.desc("total"), "party")


def split_sentences(df: DataFrame, owner: str, text: str = "text") -> DataFrame:
    return df.select(owner, F.posexplode(sentences(F.col(text))).alias("pos", "sentence"))


def keyword_sentences(df: DataFrame, owner: str, date: str, term: str) -> DataFrame:
    rows = df.select(owner, date, F.explode(sentences(F.col("text"))).alias("sentence"))
    return rows.filter(F.col("sentence").rlike(term))


#: Spark ML's English stop words that are words of two letters and more, without apostrophes.
STOP_WORDS = tuple(
    """
    me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself they them
    their theirs themselves what which who whom this that these those am is are was were be been being have has had having do does did doing
    an the and but if or because as until while of at by for with about against between into through during before after above below to
    from up down in out on off over under again further then once here there when where why how all any both each few more most other some
    such no nor not only own same so than too very can will just don should now cannot could ought would
    """.split()
)


def count_terms(df: DataFrame, keys: list[str], stop: tuple[str, ...] = STOP_WORDS) -> DataFrame:
    """(keys, term, tf): lower-cased words of two letters and more, without stop words."""
    words = df.select(*keys, F.explode(F.split(F.lower("text"), r"[^a-z]+")).alias("term"))
    return words.filter((F.length("term") >= 2) & ~F.col("term").isin(*stop)).groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("tf"))


def class_tfidf(terms: DataFrame, keys: list[str]) -> DataFrame:
    """Class-based weights tf * log(1 + A / f): A the mean words of a class, f a term's count in all classes."""
    per_class = terms.groupBy(*keys).agg(F.sum("tf").alias("words")).agg(F.avg("words").alias("a")).scalar()
    f = terms.groupBy("term").agg(F.sum("tf").alias("f"))
    return terms.join(f, "term").withColumn("a", per_class).select(*keys, "term", "tf", (F.col("tf") * F.log(1 + F.col("a") / F.col("f"))).alias("weight"))


def topics_over_time(df: DataFrame, topic: str, value: Column, bins: int = 20) -> DataFrame:
    """Rows per topic and equal-width bin of ``value`` (numbered from 0)."""
    rows = df.withColumn("_v", value.cast("double"))
    ends = rows.agg(F.struct(F.min("_v").alias("a"), F.max("_v").alias("b")).alias("e")).scalar()
    at = rows.withColumn("_e", ends)
    width = (F.col("_e.b") - F.col("_e.a")) / bins
    n = F.coalesce(F.floor(F.try_divide(F.col("_v") - F.col("_e.a"), width)), F.lit(0))
    return at.withColumn("bin", F.least(n, F.lit(bins - 1)).cast("int")).groupBy(topic, "bin").agg(F.count(F.lit(1)).alias("n"))
