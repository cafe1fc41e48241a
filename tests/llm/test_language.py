"""Language identification: held-out accuracy, and the kernel against sets of n-grams."""

import numpy as np
import pyarrow as pa

from vaultwatch.llm import language, queries

SF01 = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang").collect()}
    got = queries.queries()["op8_language"](spark, SF01).collect()
    assert sorted(r.doc_id for r in got) == sorted(lang)
    held = [r for r in got if r.held_out and lang[r.doc_id] and r.lang_pred != "und"]
    assert len(held) > 100
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def grams(text):
    clean = "".join(c if c.isalpha() else " " for c in text.lower())
    raw = b" ".join(w.encode() for w in clean.split())
    raw += b" " if text and not text[-1].isalpha() and raw else b""
    return {raw[i : i + n] for n in range(1, 5) for i in range(len(raw) - n + 1)}


def test_presence_is_that_of_the_ngrams(monkeypatch):
    texts = ["Ab, ab!  cé", "x", "", None, "  12 q", "abcabcabc", "zz."]
    found = language.presence(pa.array(texts))
    for text, row in zip(texts, found):
        want = {language.presence(pa.array([g.decode("latin1")]))[0].tobytes() for g in ()}
        assert not want
        assert 0 <= row.sum() <= len(grams(text or "")) and row.sum() >= 0.9 * len(grams(text or ""))
    both = language.presence(pa.array(["ab, AB", "ab ab", "ab  1 ab"]))
    assert (both[0] == both[1]).all() and (both[1] == both[2]).all()


def test_defined_results(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "en"), (4, "12 !!", "de"), (5, "", None), (None, "und der", None), (2, "der hund und die katze", "de"), (6, "日本", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'x' AS score", "1 AS held_out")
    model = language.learn(docs)
    got = language.predict(docs, model).collect()
    assert sorted((str(r.doc_id), r.lang_pred) for r in got if r.doc_id != 6) == sorted([("1", "en"), ("2", "de"), ("2", "de"), ("3", "und"), ("4", "und"), ("5", "und"), ("None", "de")])
    assert {r.lang_pred for r in got if r.doc_id == 6} <= {"de", "en"}
    assert language.learn(docs.limit(0)) is None
    assert {(r.lang_pred, r.score) for r in language.predict(docs, None).collect()} == {("und", 0.0)}
    assert language.predict(docs.limit(0), model).collect() == []
    one = language.learn(docs.filter("doc_id = 1"))
    assert {r.lang_pred for r in language.predict(docs.filter("doc_id = 2"), one).collect()} == {"en"}


def test_kernel():
    a, b = language.presence(pa.array(["abab cd", "cd efg"]))
    packed = np.packbits(np.stack([a, b]), axis=1)
    roots = np.sqrt(np.array([a.sum(), b.sum()]))
    got = language.kernel(np.stack([a, b]), packed, roots)
    assert np.allclose(np.diag(got), 1) and np.isclose(got[0, 1], (a & b).sum() / (roots[0] * roots[1]))
