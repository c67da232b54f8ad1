"""Steps whose memory or shuffle once grew faster than their input."""

from pyspark.sql import functions as F

from lodestrata.operators import documents as X
from lodestrata.operators.discourse import speaker_party
from lodestrata.plans import catalogue


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_index_of_odd_texts_without_a_shuffle(spark, tmp_path):
    texts = ["b a b  c\na b", "", " ", None, "one", "same same", "z \ty z", "one"]
    rows = [(i % 7, t) for i, t in enumerate(texts)]  # an id that two rows share
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = catalogue.queries()["B30_inverted_index"](spark, str(tmp_path))
    assert "Exchange" not in plan(got)
    want = [(i, t if t is None else " ".join(t.replace("  ", " ").replace("\n", " ").replace(" \t", " ").split(" "))) for i, t in rows]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    index = X.inverted_index(spark.createDataFrame(rows, "doc_id long, text string"), F.split("text", " ")).filter("doc_id = 5").first()["index"]
    assert index == {"same": [0, 1]}


def test_speeches_without_an_id_or_person_spread(spark):
    said = spark.range(0, 4000, 1, 4).select(
        F.col("id").alias("speech_id"), F.when(F.col("id") % 50 == 0, "m1").alias("speaker_id"), F.when(F.col("id") % 4 > 0, F.concat(F.lit("p"), F.col("id") % 90)).alias("person_id"),
        F.when(F.col("id") % 3 > 0, F.date_add(F.lit("2001-01-01").cast("date"), (F.col("id") % 70).cast("int"))).alias("date"),
    )
    members = spark.createDataFrame([(0, "m1", "p1", "x", "2000-01-01", "2010-01-01")], "pos int, id string, person_id string, on_behalf_of_id string, start_date string, end_date string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = speaker_party(said, members).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r["count"] for r in parts) == 4000 and max(r["count"] for r in parts) < 1300
