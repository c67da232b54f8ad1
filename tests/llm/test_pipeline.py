"""The pipeline's stages, each against brute force on what the stage before kept."""

import hashlib
import zlib

import corpus_pipeline
from lodestrata.llm.queries import tokenizer_path

from test_corpus import brute_repeats, corpus  # noqa: F401
from test_near_texts import brute

KINDS = "doc_id long, text string, lang string, source string, n_chars long, body string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_stages(spark, corpus, tmp_path):  # noqa: F811
    from tokenizers import Tokenizer

    copies = [(300 + i, corpus[20][1], "en", "s1") for i in range(5)]
    rows = [(i, t, lang, s, len(t or ""), "x") for i, t, lang, s in [*corpus, *copies]]
    spark.createDataFrame(rows, KINDS).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet")).select(*corpus_pipeline.COLUMNS)
    kept = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert name == "packing" or docs.columns == corpus_pipeline.COLUMNS
        docs.write.parquet(str(tmp_path / name))
        docs = kept[name] = spark.read.parquet(str(tmp_path / name))
    kept = {k: v.collect() for k, v in kept.items()}

    told = {(r["doc_id"], r["text"]) for r in kept["language"]}
    assert told <= {(r["doc_id"], r["text"]) for r in kept["documents"]} and not {202, 203, 204} & {i for i, _ in told}
    assert {i for i in range(60) if len(corpus[i][1]) > 100} <= {i for i, _ in told}

    before = kept["language"]
    least = {}
    # within a group the smallest id stays, null last; of rows equal in id and text one
    for r, g in zip(before, brute([r["text"] for r in before]), strict=True):
        key = (r["doc_id"] is None, r["doc_id"] or 0, r["text"])
        least[g] = min(least.get(g, key), key)
    stay = {i for _, i, _ in least.values()}
    assert sorted(str((r["doc_id"], r["text"])) for r in kept["near_dedup"]) == sorted(str((None if none else i, t)) for none, i, t in least.values())
    assert not {200, 201, 300, 301, 302, 303, 304} & stay

    texts = [(r["doc_id"], r["text"]) for r in kept["near_dedup"]]
    blank = {sha(" " * n) for n in range(200)}
    want = sorted((r[0], r[4]) for r in brute_repeats(texts, 50) if r[4] not in blank)
    assert sorted((r["doc_id"], sha(r["text"])) for r in kept["passage_dedup"]) == want
    assert all(r["n_chars"] == len(r["text"]) for r in kept["passage_dedup"])

    clean = {(r["doc_id"], r["text"]) for r in kept["passage_dedup"]}
    mixed = [(r["doc_id"], r["text"]) for r in kept["mixing"]]
    rows_of = [r["doc_id"] for r in kept["passage_dedup"]]
    assert mixed and set(mixed) <= clean and all(mixed.count(d) <= 3 * rows_of.count(d[0]) for d in set(mixed))

    tok = Tokenizer.from_file(tokenizer_path())
    ids = sum(len(tok.encode(t, add_special_tokens=False).ids) + 1 for _, t in mixed)
    assert sum(r["length"] for r in kept["packing"]) == ids
    once = [d for d in set(mixed) if mixed.count(d) == 1 and rows_of.count(d[0]) == 1]
    for i, t in once:
        whole = [*tok.encode(t, add_special_tokens=False).ids, 1]
        for p in (p for p in kept["packing"] if p["doc_id"] == i):
            piece = b"".join(x.to_bytes(4, "little") for x in whole[p["start"] : p["start"] + p["length"]])
            assert zlib.crc32(piece) == p["ids_crc32"]
    ends = {}
    for p in kept["packing"]:
        ends.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for parts in ends.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:], strict=False)) and sum(parts[-1]) <= 2048

    again = [tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    assert sorted(again) == sorted(tuple(r) for r in kept["packing"])
