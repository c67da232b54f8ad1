"""Keyword dictionaries and labels."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import parse_keywords, sentences
from ..sources.scratch import kept


def keyword_dictionary(sheet: DataFrame, mission: str) -> DataFrame:
    """(mission, topic, combo_id, terms) from rows (Subcategory, Keywords); rows without a subcategory go."""
    rows = sheet.filter(F.col("Subcategory").isNotNull() & F.col("Keywords").isNotNull())
    return rows.select(
        F.lit(mission).alias("mission"), F.col("Subcategory").alias("topic"), F.xxhash64("Subcategory", "Keywords").alias("combo_id"), parse_keywords(F.col("Keywords")).alias("terms")
    )


def topic_combinations(dictionary: DataFrame) -> DataFrame:
    """(mission, topic, combos): all combinations of a topic in one row."""
    return dictionary.groupBy("mission", "topic").agg(F.sort_array(F.collect_list("terms")).alias("combos"))


class Matcher:
    """Topics' combinations behind one automaton over all their terms: a text is read once, however many terms there are.

    A combination is looked at only where its longest term was found.  One without any term, or with empty ones
    only, hits every text; one with a null term hits none.
    """

    def __init__(self, topics: list[tuple[str, str, list[list[str]]]]):
        self.names = [(mission, topic) for mission, topic, _ in topics]
        self.always, self.at, numbers = set(), {}, {}
        for n, (_, _, combos) in enumerate(topics):
            for combo in combos:
                if any(t is None for t in combo):
                    continue
                need = {numbers.setdefault(t, len(numbers)): len(t) for t in combo if t}
                if need:
                    self.at.setdefault(max(need, key=need.get), []).append((n, frozenset(need)))
                else:
                    self.always.add(n)
        self.automaton = ahocorasick.Automaton()
        for term, number in numbers.items():
            self.automaton.add_word(term, number)
        self.automaton.make_automaton()

    def hits(self, text: str | None) -> list[tuple[str, str]]:
        if text is None:
            return []
        found = {number for _, number in self.automaton.iter(text)} if len(self.automaton) else set()
        topics = self.always | {n for term in found for n, need in self.at.get(term, ()) if need <= found}
        return [self.names[n] for n in sorted(topics)]


def _slices(dictionary: DataFrame, chars: int) -> Iterator[list[tuple[str, str, list[list[str]]]]]:
    """Topics in groups of at most ``chars`` characters of terms (a longer topic alone); the driver holds one group at a time."""
    part, size = [], 0
    for r in topic_combinations(dictionary).orderBy("mission", "topic").toLocalIterator():
        own = sum(len(t or "") for combo in r["combos"] for t in combo)
        if part and size + own > chars:
            yield part
            part, size = [], 0
        part.append((r["mission"], r["topic"], r["combos"]))
        size += own
    if part:
        yield part


def _by_expressions(topics: list[tuple[str, str, list[list[str]]]]) -> Column:
    """A few terms as expressions of the plan."""
    told = [
        F.struct(F.lit(m).alias("mission"), F.lit(t).alias("topic"), F.array(*[F.array(*[F.lit(w).cast("string") for w in c]) for c in combos]).alias("combos"))
        for m, t, combos in topics
    ]
    hit = F.filter(F.array(*told), lambda t: F.exists(t["combos"], lambda c: F.forall(c, lambda w: F.contains(F.col("text"), w))))
    return F.transform(hit, lambda t: F.struct(t["mission"], t["topic"]))


def _by_automaton(spark: SparkSession, topics: list[tuple[str, str, list[list[str]]]]) -> Column:
    shared = spark.sparkContext.broadcast(Matcher(topics))

    @F.pandas_udf("array<struct<mission:string,topic:string>>")
    def run(texts: pd.Series) -> pd.Series:
        matcher = shared.value
        return texts.map(lambda text: [{"mission": m, "topic": t} for m, t in matcher.hits(text)])

    return run(F.col("text"))


def keyword_match(texts: DataFrame, dictionary: DataFrame, by_sentence: bool = False, expressions: int = 64, chars: int = 1 << 20) -> DataFrame:
    """(id, mission, topic): texts that hold all terms of any combination of a topic, case-sensitively.

    Texts are neither shuffled nor multiplied.  Up to ``expressions`` terms go into the plan; more go out as
    automata of at most ``chars`` characters (some 50 MB for the default), each with topics of its own, and the
    texts are read once for each automaton.  Either way gives the same rows.  A topic with more characters than
    that has an automaton alone, and one with 16 times as many is refused.

    Null texts hit nothing, an empty text only combinations of empty terms; rows with equal ids are matched one by
    one, and other columns of ``texts`` are left alone.  An empty dictionary gives no rows.
    """
    rows = texts.select("id", F.explode(sentences(F.col("text"))).alias("text")) if by_sentence else texts.select("id", "text")
    rows, found = rows.filter(F.col("text").isNotNull()), None
    for topics in _slices(dictionary, chars):
        terms = [t or "" for _, _, combos in topics for combo in combos for t in combo]
        if sum(map(len, terms)) > 16 * chars:
            raise ValueError(f"the terms of topic {topics[0][:2]} are too long for one automaton")
        hits = _by_expressions(topics) if len(terms) <= expressions else _by_automaton(texts.sparkSession, topics)
        part = rows.select("id", F.explode(hits).alias("_t")).select("id", "_t.mission", "_t.topic")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return texts.select("id").limit(0).withColumn("mission", F.lit("")).withColumn("topic", F.lit(""))
    return found.distinct() if by_sentence else found


def general_terms_filter(hits: DataFrame, mode: str = "last") -> DataFrame:
    """Keep hits of ids that also hit a topic named after general terms.

    Of several such topics the last in order that has hits decides (``mode="any"``: any
    does); a mission without such hits is not filtered.  Hits are written once, so texts are
    not matched again for the second look at them.
    """
    hits = kept(hits, "hits")
    general = F.contains(F.lower("topic"), F.lit("general terms"))
    # one row a mission, whatever the texts
    last = hits.filter(general).groupBy("mission").agg(F.max("topic").alias("_last"))
    told = hits.join(last, "mission", "left")
    decides = (F.col("topic") == F.col("_last")) if mode == "last" else general
    hit = F.max(decides).over(Window.partitionBy("mission", "id"))
    return told.withColumn("_hit", hit).filter("_last is null or _hit").select("id", "mission", "topic")


def collapse_labels(hits: DataFrame) -> DataFrame:
    """Per id the distinct missions and topics, sorted and comma-joined."""
    return hits.groupBy("id").agg(
        F.array_join(F.sort_array(F.collect_set("mission")), ",").alias("mission_labels"),
        F.array_join(F.sort_array(F.collect_set("topic")), ",").alias("topic_labels"),
    )


def keyword_classify(df: DataFrame, hits: DataFrame, mission: str) -> DataFrame:
    """0/1 prediction per id from a mission's hits, with whether it is right; one row per id."""
    hit = hits.filter(F.col("mission") == mission).select("id").distinct().withColumn("_hit", F.lit(1))
    out = df.join(hit, "id", "left").withColumn("prediction", F.coalesce("_hit", F.lit(0))).drop("_hit")
    return out.withColumn("correct", (F.col("prediction") == F.col("relevant")).cast("int")).dropDuplicates(["id"])


def taxonomy(sheet: DataFrame) -> DataFrame:
    """Distinct categories and subcategories per mission, without general terms."""
    return sheet.select("mission", "Category", "Subcategory").distinct().filter(~F.contains(F.lower("Category"), F.lit("general terms")))
