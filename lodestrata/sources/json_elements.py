"""Objects of one list in a large JSON document, read in splits.

The document is cut at every closing brace, which Spark's text reader does in splits of a file.  Whether a fragment
begins inside a string, and how deep, follows from counts before it: summed inside a split, and over splits by one row
for each.  Fragments of an object then meet, and the objects go out as JSON lines, so no row or task holds the document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import kept, scratch

TOKEN = re.compile(r'"(?:[^"\\]|\\.)*"|[{}\[\]:]', re.DOTALL)
NEXT = re.compile(r"\s*,\s*\{")


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _rise(bare: Column, inside: int, quotes: Column) -> Column:
    """By how much a fragment and the brace after it change the depth, if it begins inside a string or not."""
    outer = F.regexp_replace(F.concat(F.lit('"' * inside), bare), r'"[^"]*("|\z)', "")
    ends = F.when((quotes + inside) % 2 == 0, 1).otherwise(0)
    return (_count(outer, "{") + _count(outer, "[") - _count(outer, "]") - ends).cast("long")


def _fragments(spark: SparkSession, path: str) -> DataFrame:
    at = (F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("_metadata.file_size").alias("size"))
    text = spark.read.option("lineSep", "}").text(path).select(*at, F.col("value").alias("text"))
    bare = F.regexp_replace("text", r"(?s)\\.", "")  # no escape spans a brace
    rows = text.withColumn("quotes", _count(bare, '"').cast("long"))
    rows = rows.withColumns({"rise0": _rise(bare, 0, F.col("quotes")), "rise1": _rise(bare, 1, F.col("quotes"))})
    # kept, so that the splits are the same for all that follows
    return kept(rows.withColumn("odd", _before("quotes") % 2), "fragments")


def _before(col: str, *by: str, order: str = "at") -> Column:
    """The sum over earlier rows of a split."""
    over = Window.partitionBy(*by or ("path", "block")).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(col).over(over), F.lit(0))


def _split_head(text: str, depth: int, level: int) -> tuple[str | None, int]:
    """The last key of the root whose list opens before the object that ends ``text`` (empty: another value), and where that object begins."""
    if depth == level and (found := NEXT.match(text)):
        return None, found.end() - 1
    key, name, begin = None, "", 0
    for token in TOKEN.finditer(text):
        mark = token[0]
        if mark in "{[":
            if depth == 1:
                key = name if mark == "[" else ""
            if depth == level and mark == "{":
                begin = token.start()
            depth += 1
        elif mark in "}]":
            depth -= 1
        elif mark != ":" and depth == 1:
            name = mark[1:-1]
    return key, begin


def json_elements(spark: SparkSession, path: str, key: str | None = None, schema: T.StructType | str | None = None) -> DataFrame:
    """(path, pos, m): the objects of the document's list ``key``, or of the list that the document is, in order.

    ``path`` is a file or a folder of documents.  ``pos`` counts a list's objects from 0; other members are passed over.
    ``schema`` is that of an object, found out if not given, which takes an object at least.  A document that ends early,
    or inside a string, raises ValueError.  A single object has to fit a row, as has what lies between two.
    """
    level = 2 if key else 1
    rows = _fragments(spark, path)
    # one row for each split
    by = Window.partitionBy("path").orderBy("block")
    odd = F.col("odd") == 0
    sums = rows.groupBy("path", "block").agg(
        F.max("size").alias("size"), F.sum(F.octet_length("text") + F.lit(1)).alias("bytes"), F.sum("quotes").alias("quotes"), F.max("at").alias("last"),
        F.sum(F.when(odd, F.col("rise0")).otherwise(F.col("rise1"))).alias("as0"), F.sum(F.when(odd, F.col("rise1")).otherwise(F.col("rise0"))).alias("as1"),
    )
    sums = sums.withColumn("inside", _before("quotes", "path", order="block") % 2).withColumn("rise", F.when(F.col("inside") == 0, F.col("as0")).otherwise(F.col("as1")))
    sums = sums.select(
        "path", "block", "inside", "rise", _before("rise", "path", order="block").alias("from"),
        F.when(F.lead("block").over(by).isNull(), F.col("last")).alias("end"),
        (F.sum("quotes").over(by) % 2).alias("open"), (F.sum("bytes").over(by) - F.col("size")).alias("over"),
    )
    # a whole document ends outside all brackets; whether a brace follows its last fragment is told by its size, with or
    # without a byte order mark, but not if it is compressed
    left = F.col("from") + F.col("rise")
    well = F.when(F.col("over").isin(0, -3), left == 0).when(F.col("over").isin(1, -2), left == -1).otherwise(left.isin(-1, 0))
    torn = sums.filter(F.col("end").isNotNull() & ((F.col("open") == 1) | ~well)).select("path").take(1)
    if torn:
        raise ValueError(f"the document ends early: {torn[0][0]}")
    rows = rows.join(sums.drop("rise", "open", "over"), ["path", "block"])
    inside = (F.col("odd") + F.col("inside")) % 2
    rows = rows.withColumn("rise", F.when(inside == 0, F.col("rise0")).otherwise(F.col("rise1"))).withColumn("depth", F.col("from") + _before("rise"))
    closes = ((inside + F.col("quotes")) % 2 == 0) & (F.col("depth") + F.col("rise") == level) & ~F.col("at").eqNullSafe(F.col("end"))
    rows = rows.withColumn("closes", closes.cast("long"))
    # the brace at a level also closes objects that lie in other values of the root; they count, and go with their key
    ends = rows.groupBy("path", "block").agg(F.sum("closes").alias("n"))
    ends = ends.select("path", "block", _before("n", "path", order="block").alias("earlier"))
    rows = rows.withColumn("nth", _before("closes")).join(ends, ["path", "block"]).withColumn("nth", F.col("earlier") + F.col("nth"))
    parts = F.sort_array(F.collect_list(F.struct("block", "at", "text")))
    whole = rows.groupBy("path", "nth").agg(F.max("closes").alias("closes"), F.array_join(F.transform(parts, lambda p: p["text"]), "}").alias("text"))
    whole = whole.filter("closes = 1").select("path", "nth", F.concat("text", F.lit("}")).alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            heads = [_split_head(t, level if n else 0, level) for t, n in zip(batch["text"], batch["nth"], strict=True)]
            texts = [t[b:] for t, (_, b) in zip(batch["text"], heads, strict=True)]
            yield pd.DataFrame({"path": batch["path"], "nth": batch["nth"], "name": [k for k, _ in heads], "text": texts})

    objects = kept(whole.mapInPandas(run, "path string, nth long, name string, text string"), "objects")
    if key:
        # keys of a document's root are few
        lists = objects.filter("name is not null").select("path", "name", F.col("nth").alias("first"), F.lead("nth").over(Window.partitionBy("path").orderBy("nth")).alias("next"))
        lists = lists.filter(F.col("name") == key).drop("name")
        objects = objects.join(lists, "path").filter("nth >= first and (next is null or nth < next)")
    else:
        objects = objects.withColumn("first", F.lit(0))
    head = F.to_json(F.struct("path", (F.col("nth") - F.col("first")).alias("pos")))
    line = F.concat(F.left(head, F.length(head) - 1), F.lit(',"m":'), F.regexp_replace("text", r"[\r\n]+", " "), F.lit("}"))
    out = scratch(spark, "elements")
    objects.select(line.alias("value")).write.text(out)
    if schema is None:
        found = spark.read.json(out)
        if "m" not in found.columns:
            raise ValueError(f"no object to find out a schema from: {path}")
        return found.select("path", "pos", "m")
    of = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    return spark.read.schema(T.StructType().add("path", "string").add("pos", "long").add("m", of)).json(out)
