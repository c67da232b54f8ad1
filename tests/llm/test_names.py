"""Input columns that bear the operators' internal names, and long texts."""

import pathlib
import re

import numpy as np
import pytest
from lodestrata.llm import ann, imatch, langid, lattice, mixing, packing, simhash, style_tree, suffix_dedup, urls
from lodestrata.llm.near_texts import near_groups
from lodestrata.llm.queries import tokenizer_path
from pyspark.sql import functions as F

SOURCE = "\n".join(p.read_text() for p in pathlib.Path(langid.__file__).parent.glob("*.py"))
INTERNAL = sorted(set(re.findall(r"\b(?:alias|withColumn|withColumnRenamed)\(f?\"(\w+)\"", SOURCE)) | {"_size", "_source", "_target", "_copies", "row", "copy", "value", "key"})
RUNS = {
    "packing": lambda d: packing.pack_documents(d, tokenizer_path()).groupBy("doc_id").agg(F.sum("length")),
    "lattice": lambda d: lattice.score_texts(d, tokenizer_path()),
    "mix": mixing.mixing_report,
    "mixed": mixing.mixed_documents,
    "imatch": imatch.fingerprints,
    "language": lambda d: langid.identify(d, keep=("source",)),
    "simhash": simhash.near_duplicates,
    "near": near_groups,
    "repeats": lambda d: suffix_dedup.remove_repeats(d, keep=("source",)),
    "pages": style_tree.extract,
    "urls": urls.judge,
    "ann": lambda d: ann.nearest(d, every=5),
}


@pytest.mark.parametrize("name", RUNS)
def test_internal_names(spark, name):
    rng = np.random.default_rng(1)
    own = "doc_id long, text string, lang string, source string, page_id long, url string, html string, vec_id long, embedding array<double>"
    rows = [(i, f"the {i % 7} word of {'en' * i} text and more of it", "en", f"s{i % 2}", i, f"http://a{i}.org/en/{i}", f"<p>page {i}</p>", i, rng.normal(size=4).tolist()) for i in range(20)]
    docs = spark.createDataFrame(rows, own)
    others = [c for c in INTERNAL if c not in docs.columns]
    assert len(others) > 60
    full = docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(others)])
    got = [tuple(r) for r in RUNS[name](full).select(*RUNS[name](docs).columns).collect()]
    assert sorted(got, key=str) == sorted((tuple(r) for r in RUNS[name](docs).collect()), key=str)


def test_mixed_rows_keep_their_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "x", 5, 6, 7)], "doc_id long, text string, source string, _size int, copies int, `a.b` int")
    assert {tuple(r) for r in mixing.mixed_documents(docs).collect()} == {(1, "a b", "x", 5, 6, 7)}


def test_segments_of_long_texts(monkeypatch):
    table = np.random.default_rng(2).normal(size=(langid.BUCKETS, 3))
    texts = ["", "a", "word " * 900, "x" * 5000, "é b" * 700, " " * 300]
    whole = [langid.segment_scores(t, table) for t in texts]
    monkeypatch.setattr(langid, "PIECE", 100)
    for t, want in zip(texts, whole, strict=True):
        assert np.allclose(langid.segment_scores(t, table), want)


def test_groups_of_null_ids(spark):
    rows = [(None, "one two three four"), (None, "one two three four"), (None, "five six seven"), (3, "eight nine"), (None, "eight nine")]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in got) == [("3", "3"), ("None", "3"), ("None", "None"), ("None", "None"), ("None", "None")]
