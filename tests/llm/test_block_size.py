"""Blocks of a task stay small: an executor of 3 GB holds two tasks besides Spark's heap."""

from pyspark.sql import functions as F

from lodestrata.llm import suffix_dedup as S


def test_a_block_is_two_megabytes(spark):
    docs = spark.range(80).select(F.col("id").alias("doc_id"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 4000).alias("text"))
    rows, n = S.blocks(docs, "doc_id", "text")
    sizes = [r["size"] for r in rows.groupBy("block").agg(F.sum(F.length("body")).alias("size")).collect()]
    assert n >= 9 and max(sizes) < 8 << 20
