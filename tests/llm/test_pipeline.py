"""The pipeline: each stage on all that the one before kept, against brute force."""

import hashlib
import re
from collections import Counter

import public_tokenizers as P
import pytest
import tiktoken

import __spark_entry__ as driver
import corpus_pipeline
from test_decontaminate import brute as leaks_of
from test_minhash_dedup import brute as components_of
from vaultwatch.llm import bpe, decontaminate

SF = "/root/testdata/sf0.001"


def without_passages(raw, length=400, n_words=51):
    """The texts without strings of 400 bytes, and of 51 words, that stand elsewhere too, and the bytes gone by words alone."""
    spans = {i: [m.span() for m in re.finditer(rb"[^ \t-\r]+", r)] for i, r in raw.items()}
    words = {i: [raw[i][a:b] for a, b in s] for i, s in spans.items()}
    grams = Counter(tuple(w[j : j + n_words]) for w in words.values() for j in range(len(w) - n_words + 1))
    strings = Counter(hashlib.md5(r[j : j + length]).digest() for r in raw.values() for j in range(len(r) - length + 1))
    want, short = {}, 0
    for i, r in raw.items():
        gone = bytearray(len(r))
        for j in range(len(r) - length + 1):
            if strings[hashlib.md5(r[j : j + length]).digest()] > 1:
                gone[j : j + length] = b"\1" * length
        before = sum(gone)
        told = {k for j in range(len(words[i]) - n_words + 1) if grams[tuple(words[i][j : j + n_words])] > 1 for k in range(j, j + n_words)}
        for k in told:  # with the space to the next word, if that goes too
            a, b = spans[i][k][0], spans[i][k + 1][0] if k + 1 in told else spans[i][k][1]
            gone[a:b] = b"\1" * (b - a)
        short += sum(gone) - before
        want[i] = bytes(b for b, g in zip(r, gone) if not g).decode("utf-8", "ignore")
    return want, short


@pytest.fixture(scope="module")
def stages(spark):
    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), []
    found.append(docs.collect())
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), stage(spark, docs, SF).schema)
        found.append(docs.collect())
    return found


def test_columns_and_rows(stages):
    for before, after in zip(stages, stages[1:-1]):
        assert after[0].asDict().keys() == before[0].asDict().keys()
        assert {r.doc_id for r in after} <= {r.doc_id for r in before}
        assert 0.5 * len(before) < len(after) <= len(before)


def test_near_duplicates(stages):
    kept = {i for i, _, _, k in components_of([(r.doc_id, r.text) for r in stages[1]], 5) if k}
    assert {r.doc_id for r in stages[2]} == kept


def test_repeated_passages(stages):
    want, _ = without_passages({r.doc_id: (r.text or "").encode() for r in stages[2]})
    assert {r.doc_id: r.text or "" for r in stages[3]} == want
    assert all(r.n_chars == len(r.text) for r in stages[3] if r.text is not None)


def test_repeated_passages_of_51_words(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want, short = without_passages({r.doc_id: (r.text or "").encode() for r in docs.collect()})
    assert short > 1000
    assert {r.doc_id: r.text or "" for r in corpus_pipeline.substring_stage(spark, docs, SF).collect()} == want


def test_decontamination(spark, stages):
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = leaks_of(bench, [(r.doc_id, r.text) for r in stages[3]], (decontaminate.SCORE, decontaminate.QUESTION, decontaminate.ANSWER))
    assert {r.doc_id for r in stages[4]} == {r.doc_id for r in stages[3]} - {doc for doc, _ in found}


def test_encoding(stages):
    ranks = bpe.encoder(P.path(corpus_pipeline.RANKS), P.PATTERN).vocabulary.ranks
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = {r.doc_id: r.text or "" for r in stages[4]}
    assert {r.doc_id: list(r.ids) for r in stages[5]} == {i: library.encode_ordinary(t) for i, t in text.items()}
    assert all(r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest() and r.n_tokens == len(r.ids) for r in stages[5])


def test_odd_tables(spark, tmp_path):
    rows = [(1, None, None, None, None, "x"), (2, "", "en", "s", 0, "x"), (None, "a text without an id " * 30, "en", "s", None, "x"), (3, "the same " * 100, "en", "s", 900, "x"), (3, "the same " * 100, "en", "s", 900, "x"), (4, "the same " * 100, "en", "s", 900, "x")]
    rows += [(100 + i, f"words of a plain kind {i} " * 9, "de", "s", 1, "x") for i in range(10)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for size in (len(rows), 0):
        docs = spark.createDataFrame(rows[:size], schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
            docs = spark.createDataFrame(docs.collect(), docs.schema)
            if name != "encoding":
                assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "score"]
        ids = [r.doc_id for r in docs.collect()]
        assert sorted(map(str, ids)) == sorted(map(str, [1, 2, None, 3, 3, *range(100, 110)] if size else []))


def test_registered():
    assert "pipeline" in driver.queries() and [n for n, _ in corpus_pipeline.STAGES] and len(corpus_pipeline.STAGES) == 5
    numbers = {name.split("_")[0] for name in driver.queries() if name.startswith("op")}
    assert numbers == {f"op{i}" for i in range(1, 14)}
