"""Fits read their texts once, however many steps they take."""

from pyspark.sql import functions as F

from lodestrata.operators.epochs import fit_text_classifier
from lodestrata.operators.learning import add_embeddings


def counted(spark):
    reads = spark.sparkContext.accumulator(0)

    @F.udf("string", useArrow=False)
    def text(i):
        reads.add(1)
        return f"word{i % 7} heat{i % 3} pump"

    rows = spark.range(120).repartition(3).select("id", text.asNondeterministic()("id").alias("text"), (F.col("id") % 2).cast("int").alias("relevant"))
    return rows, reads


def test_classifier(spark):
    rows, reads = counted(spark)
    fit_text_classifier(rows, epochs=2, features=64)
    assert reads.value == 120


def test_embeddings(spark):
    rows, reads = counted(spark)
    assert add_embeddings(rows, size=4).count() == 120
    assert reads.value == 120
