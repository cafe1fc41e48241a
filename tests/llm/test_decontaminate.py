"""Decontamination against scoring every passage with every item."""

import math
import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from vaultwatch.llm import decontaminate as dec


def words(text):
    return re.findall(r"\w+", (text or "").lower())


def made(seed, items=40):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(250)] + ["the", "of", "and"] * 20 + ["größe", "Ünder"]

    def sentence(n):
        return " ".join(rnd.choice(vocabulary) for _ in range(n)).capitalize() + "."

    bench = [(i, f"{sentence(rnd.randrange(6, 25))} {sentence(rnd.randrange(3, 9))}") for i in range(items)]
    bench += [(900, None), (901, ""), (902, "One"), (903, "w1 w2 w3.")]
    docs = []
    for i in range(120):
        body = [sentence(rnd.randrange(5, 20)) for _ in range(rnd.choice([0, 1, 5, 40]))]
        if i % 3 == 0:
            leak = rnd.choice(bench[:items])[1].split()
            for _ in range(i % 4):
                leak[rnd.randrange(len(leak))] = "changed"
            body.insert(rnd.randrange(len(body) + 1), " ".join(leak).upper() if i % 2 else " ".join(leak))
        docs.append((i, "\n".join(body)))
    return bench, docs + [(500, None), (501, ""), (502, "one"), (503, "w1, w2, w3")]


def brute(bench, docs, limits):
    kept = [(i, t) for i, t in bench if t is not None]
    tf = [Counter(words(t)) for _, t in kept]
    length = [len(words(t)) for _, t in kept]
    mean, df = sum(length) / len(kept), Counter(w for c in tf for w in c)
    window = max(length)

    def weights(k):
        found = {
            w: math.log1p((len(kept) - df[w] + 0.5) / (df[w] + 0.5)) * n * (dec.K1 + 1) / (n + dec.K1 * (1 - dec.B + dec.B * length[k] / mean))
            for w, n in tf[k].items()
        }
        total = sum(found.values())
        return {w: v / total for w, v in found.items()}

    def runs(w, n):
        n = min(n, len(w))
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()

    found = {}
    for doc, text in docs:
        w = words(text)
        for start in range(0, max(1, len(w) - window), window):
            piece = w[start : start + 2 * window]
            for k, (item, t) in enumerate(kept):
                if not tf[k]:
                    continue
                score = sum(v for word, v in weights(k).items() if word in set(piece))
                asked, answer = (words(p) for p in dec.parts(t))
                n = min(5, len(asked))
                share = len(runs(asked, n) & runs(piece, n)) / len(runs(asked, n)) if len(piece) >= n else 0
                heard = len(set(answer) & set(piece)) / len(set(answer))
                if score >= limits[0] - 1e-9 and share >= limits[1] and heard >= limits[2]:
                    best = found.get((doc, item))
                    found[doc, item] = max(best, (score, share, heard)) if best else (score, share, heard)
    return found


@pytest.mark.parametrize("seed,limits", [(1, (0.6, 0.5, 0.5)), (2, (0.3, 0.1, 0.1)), (3, (0.3, 0.0, 0.0))])
def test_same_leaks_as_scoring_everything(spark, seed, limits):
    bench, docs = made(seed)
    items = spark.createDataFrame(bench, "item_id long, text string")
    table = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id long, text string, item_id string").repartition(3)
    got = {(r.doc_id, r.item_id): (r.score, r.question_overlap, r.answer_overlap) for r in dec.find(table, items, limits=limits).collect()}
    want = brute(bench, docs, limits)
    assert got.keys() == want.keys() and len(want) > 20
    assert all(abs(a - b) < 1e-6 for k in got for a, b in zip(got[k], want[k]))


def test_several_indexes_find_the_same(spark, monkeypatch):
    bench, docs = made(4)
    items = spark.createDataFrame(bench, "item_id long, text string")
    table = spark.createDataFrame(docs, "doc_id long, text string")
    one = {(r.doc_id, r.item_id) for r in dec.find(table, items).collect()}
    monkeypatch.setattr(dec, "INDEX_BYTES", 1500)
    several = {(r.doc_id, r.item_id) for r in dec.find(table, items).collect()}
    assert one <= several and len(one) > 20  # shorter passages can only miss less


def test_bounds_are_never_below_scores():
    bench, docs = made(5)
    kept = [b for b in bench if b[1]]
    h, _ = dec.terms(pa.array([t for _, t in kept]))
    index = dec.Index.build(kept, None, len(kept), len(h) / len(kept))
    assert index.window == 2 * max(len(words(t)) for _, t in kept)
    for t in range(len(index.terms)):
        own = slice(index.heads[t], index.heads[t + 1])
        assert index.top[t] == index.weight[own].max()


ENDINGS = ['w%d red."', "w%d red...", "w%d red?!", "w%d (red.)", "w%d red.”", "w%d red. …", "w%d red!\n]"]


def test_items_that_end_in_marks(spark):
    bench = [(i, f"... Which q{i} a{i} of b{i} is c{i} here? " + end % i) for i, end in enumerate(ENDINGS)] + [(90, "w90 red..."), (91, "..."), (92, '"?!"')]
    docs = [(i, f"Words before it. {t} And words after it.") for i, t in bench]
    got = dec.find(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} >= {(i, i) for i in (*range(len(ENDINGS)), 90)}
    assert all(set(words(dec.parts(bench[i][1])[1])) == {f"w{i}", "red"} and words(dec.parts(bench[i][1])[0])[0] == "which" for i in range(len(ENDINGS)))
    assert not any(r.item_id in (91, 92) for r in got)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert dec.find(docs.limit(0), items).collect() == []
    assert dec.find(docs, items.limit(0)).collect() == []
    assert [(r.doc_id, r.item_id) for r in dec.find(docs.union(docs), items).collect()] == [(1, 1), (1, 1)]
