"""Column functions on texts that the smallest tables don't hold."""

import duckdb
from pyspark.sql import functions as F

from lodestrata.functions import scalars as S
from lodestrata.plans import catalogue

TEXTS = [
    "first\n12195 ends with 1\n25.13.2 starts with 2",  # a line keeps the digits of its own number
    "0 the first line 0",
    "  \xa0spaces 　\n \n\n of any kind ",
    "a\r\nb\r\n\n \tc d\x0b\n e\u0085",
    "",
    "\n \n",
    None,
]


def test_clean_lines_is_its_sql(spark, tmp_path):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    rows.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    db = duckdb.connect()
    db.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    expected = db.sql(catalogue.oracle_sql()["B10_clean_lines"]).fetchall()
    got = catalogue.queries()["B10_clean_lines"](spark, str(tmp_path)).collect()
    assert sorted((r["id"], r["text"]) for r in got) == sorted(expected)


def test_lists_keep_their_digits(spark):
    row = spark.createDataFrame([("0 a, 1b1 ,2",)], "c string").select(S.split_list(F.col("c")).alias("x"), S.clean_lines(F.lit("a\r\n1b")).alias("y")).first()
    assert row["x"] == ["0 a", "1b1", "2"] and row["y"] == "a 1b"
