"""The corpus pipeline: language, near-duplicates, repeated passages, mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs; all but the last return the columns
of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.llm import _common as common
from lodestrata.llm.langid import identify
from lodestrata.llm.mixing import mixed_documents
from lodestrata.llm.near_texts import near_groups, text_key
from lodestrata.llm.packing import pack_documents
from lodestrata.llm.queries import tokenizer_path
from lodestrata.llm.suffix_dedup import remove_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document stays if one language accounts for at least this share of it.
LEAST_SHARE = 0.5
#: Texts without an id are numbered by their hash from here on.
UNNAMED = 1 << 62


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is told apart and prevails; ``lang`` becomes the predicted one."""
    found = identify(docs, keep=tuple(COLUMNS)).filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE))
    return found.withColumn("kept_lang", F.col("lang_pred")).select(*[F.col(f"kept_{c}").alias(c) for c in COLUMNS])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of texts whose 5-word shingles have a Jaccard similarity of 0.8 or more.

    First is the smallest id, null last, then the text's hash; of rows equal in id and text one stays.
    """
    first = near_groups(docs).groupBy("group").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("one"))
    keys = {"_hash": F.col("one.key"), "_none": F.col("one.none"), "_id": F.coalesce("one.id", F.lit(0).cast("long"))}
    own = {"_hash": text_key(), "_none": F.col("doc_id").isNull(), "_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long"))}
    stay = docs.withColumns(own).join(first.select(*[c.alias(k) for k, c in keys.items()]), list(keys), "left_semi")
    rest = [c for c in COLUMNS if c != "text"]
    one = stay.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"), F.min("text").alias("text"))
    return one.select("_row.*", "text").select(*COLUMNS)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 bytes or more that an earlier document holds; emptied documents go.

    Texts without an id come after all others, each text a document of its own and kept once.  A cut inside a
    character drops that character's remains with the passage.
    """
    named = docs.filter("doc_id is not null").withColumn("_own", F.col("doc_id").cast("long"))
    unnamed = docs.filter("doc_id is null").groupBy(text_key().alias("_hash")).agg(F.min(F.struct(*COLUMNS)).alias("_row"))
    unnamed = unnamed.select("_row.*", (F.lit(UNNAMED) + F.pmod("_hash", F.lit(UNNAMED - 2))).alias("_own"))
    rest = ("doc_id", "lang", "source")
    found = remove_repeats(named.unionByName(unnamed), id_col="_own", keep=rest, as_text=True).filter(F.length(F.trim("kept")) > 0)
    return found.select(
        F.col("kept_doc_id").alias("doc_id"), F.col("kept").alias("text"), F.col("kept_lang").alias("lang"), F.col("kept_source").alias("source"),
        F.length("kept").cast("long").alias("n_chars"),
    )


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's share asks for."""
    return mixed_documents(docs).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return pack_documents(docs, tokenizer_path()).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("passage_dedup", passage_dedup),
    ("mixing", mixing),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select(*COLUMNS)
    for _, stage in STAGES[:-1]:
        docs = common.cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: No SQL tells languages or packs harmonically; the tests hold the stages against brute force.
ORACLE_SQL = None
