"""The registered queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import mixing, phrases
from ._common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    packed = pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op2_lattice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lattice import score_texts

    return score_texts(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mixing_report

    return mixing_report(table(spark, sf_dir, "documents"))


def op4_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .imatch import fingerprints

    return fingerprints(table(spark, sf_dir, "documents"))


def op5_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import identify

    return identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .style_tree import extract

    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op8_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ann import nearest

    return nearest(table(spark, sf_dir, "embeddings"))


def op9_url_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .urls import judge

    return judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import digest, remove_repeats

    return digest(remove_repeats(table(spark, sf_dir, "documents")))


def byte_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import digests, round_trip

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(round_trip(docs, byte_tokenizer_path()))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repair import damaged, digests, repair

    return digests(repair(damaged(table(spark, sf_dir, "conversations"))))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_harmonic_packing,
        op2_lattice_scores,
        op3_mixing,
        op4_imatch,
        op5_language_mixture,
        op6_simhash_near_dedup,
        op7_site_style_tree,
        op8_cross_polytope,
        op9_url_models,
        op10_suffix_array_dedup,
        op11_bpe,
        op12_repair,
        op13_collocations,
    )
}
ORACLES: dict[str, str] = {"op3_mixing": mixing.ORACLE, "op13_collocations": phrases.ORACLE}
