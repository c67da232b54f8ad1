"""Listings, works, prompts and evaluation tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def zip_positions(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Tables that number their rows by ``keys``, side by side as far as all of them go."""
    return reduce(lambda a, b: a.join(b, keys), parts)


def inverted_index(df: DataFrame, words: Column, out: str = "index") -> DataFrame:
    """``df`` with a word -> positions map of an array of words; null for null.  Words are sorted within their row, nothing is shuffled."""
    rows = df.withColumn("_sorted", F.array_sort(F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("pos")))))
    places = F.when(F.size("_sorted") > 0, F.sequence(F.lit(0), F.size("_sorted") - 1)).when(F.col("_sorted").isNotNull(), F.array().cast("array<int>"))
    starts = F.filter(places, lambda i: (i == 0) | (F.get("_sorted", i)["word"] != F.get("_sorted", i - 1)["word"]))
    rows = rows.withColumn("_starts", starts)
    stop = lambda n: F.coalesce(F.get("_starts", n + 1), F.size("_sorted"))
    runs = F.transform("_starts", lambda i, n: F.struct(F.get("_sorted", i)["word"], F.transform(F.slice("_sorted", i + 1, stop(n) - i), lambda x: x["pos"])))
    return rows.withColumn(out, F.map_from_entries(runs)).drop("_sorted", "_starts")


def abstract_from_inverted_index(df: DataFrame, id_col: str, index: str) -> DataFrame:
    """Text rebuilt from a word -> positions map, row by row; null for null."""
    words = F.flatten(F.transform(F.map_entries(index), lambda e: F.transform(e["value"], lambda pos: F.struct(pos.alias("pos"), e["key"].alias("word")))))
    return df.select(id_col, F.array_join(F.transform(F.array_sort(words), lambda x: x["word"]), " ").alias("abstract"))


def build_prompts(docs: DataFrame, questions: list[str], id_col: str, text: str) -> DataFrame:
    """A prompt per document and question."""
    qs = F.array(*[F.struct(F.lit(i).alias("n"), F.lit(q).alias("q")) for i, q in enumerate(questions)])
    rows = docs.select(id_col, text, F.explode(qs).alias("x"))
    return rows.select(id_col, F.col("x.n").alias("question_no"), F.concat(F.lit("context: "), F.col(text), F.lit("\n\nUser: "), F.col("x.q")).alias("prompt"))


def eval_dataset(turns: DataFrame) -> DataFrame:
    """Question, answer and contexts per conversation and turn: a user's turn, the assistant's next, and all user turns."""
    q = turns.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
    a = turns.filter("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    contexts = q.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_contexts"), F.sum(F.length("question")).alias("context_chars"))
    return q.join(a, ["conv_id", "turn"]).join(contexts, "conv_id")


def concat_answers(turns: DataFrame) -> DataFrame:
    ordered = F.sort_array(F.collect_list(F.struct("turn", "text")))
    rows = turns.filter("role = 'assistant'").groupBy("conv_id").agg(F.transform(ordered, lambda x: x["text"]).alias("t"))
    return rows.select("conv_id", F.concat(F.array_join("t", " "), F.lit(" ")).alias("answers"))
