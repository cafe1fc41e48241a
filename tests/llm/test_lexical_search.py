"""The search against scoring every document for every item in Python."""

import math
import random
import re
from collections import Counter

import pytest

from vaultwatch.llm import lexical_search as lexical

DOCS = "doc_id long, text string, score string, item_id long, terms string"
ITEMS = "item_id long, text string, rank string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def frames(spark, docs, items):
    return spark.createDataFrame([(i, t, "clash", 1, None) for i, t in docs], DOCS), spark.createDataFrame([(i, t, "clash") for i, t in items], ITEMS)


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, places=50):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    total_docs, total = len(counted), sum(n for _, _, n in counted)
    held = Counter(t for _, c, _ in counted for t in c)
    weight = {t: math.floor(1000 * math.log((2 * total_docs + 2) / (2 * df + 1))) for t, df in held.items()}
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, words in asked.items():
        scored = []
        for i, c, n in counted:
            m = 100 - 50 + 50 * n * total_docs // total
            score = sum(weight[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in words if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        for place, (score, _, _, i) in enumerate(sorted(scored)[:places]):
            out.append((item, place + 1, i, -score))
    return sorted(out, key=str)


def corpus(seed, size):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["Ünï", "THE", "ß9", "42"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, rnd.choice([" ", ", ", "\n", "\x7f"]).join(rnd.choices(words, weights, k=rnd.choice([1, 5, 30, 200])))) for i in rnd.sample(range(10_000), size)]
    items = [(i, " ".join(rnd.choices(words, k=rnd.choice([1, 3, 20, 60])))) for i in range(15)]
    docs += [(20_000 + i, items[i][1] + " " + docs[i][1]) for i in range(10)]
    docs += [(30_000 + i, "w1 w2 w3") for i in range(120)]  # ties beyond the last place
    docs += [(None, "w1 w2 w3"), (None, None), (1, None), (2, ""), (3, " .,;\x00"), (30_000, "w1 w2 w3"), (4, "W5-w5_w5")]
    items += [(100, None), (101, ""), (102, "..."), (103, "nowhere"), (3, "w1 w2"), (None, "w7 w8"), (104, "w1 w1 w1 w2 w3"), (104, "w1 w1 w1 w2 w3")]
    return docs, items


def found(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed,size,places", [(1, 400, 50), (2, 1500, 50), (3, 300, 3)])
def test_same_as_scoring_everything(spark, monkeypatch, seed, size, places):
    monkeypatch.setattr(lexical, "BUCKET_DOCS", 64)
    docs, items = corpus(seed, size)
    d, i = frames(spark, docs, items)
    assert found(lexical.rank(d.repartition(5), i, places)) == brute(docs, items, places)


def test_items_in_several_blocks(spark):
    docs, items = corpus(4, 200)
    d, i = frames(spark, docs, items)
    assert found(lexical.rank(d, i, block_bytes=600)) == brute(docs, items)


@pytest.mark.parametrize("docs,items", [([], [(1, "a")]), ([(1, "a")], []), ([], []), ([(1, "b")], [(1, "a")]), ([(1, None)], [(1, "a")]), ([(1, "a")], [(1, None)]), ([(7, "a b")], [(1, "a")])])
def test_few_rows(spark, docs, items):
    assert found(lexical.rank(*frames(spark, docs, items))) == brute(docs, items)


def test_very_long_texts(spark):
    long = "alpha beta-gamma " * 200_000 + "x" * 3_000_000 + " delta"
    docs = [(1, long), (2, "alpha delta"), (3, long + " delta"), (4, "x" * 3_000_000)]
    items = [(1, "delta alpha"), (2, "x" * 3_000_000), (3, "alpha " * 500_000)]
    assert found(lexical.rank(*frames(spark, docs, items))) == brute(docs, items)


def test_bounds_leave_every_row_that_reaches_the_threshold():
    np = lexical.np
    rnd = np.random.default_rng(5)
    for _ in range(30):
        counts = rnd.integers(1, 30, 200)
        terms = np.concatenate([np.sort(rnd.choice(80, c, replace=False)) for c in counts])
        impacts = rnd.integers(1, 900_000, len(terms))
        length = np.sqrt(np.bincount(np.repeat(np.arange(200), counts), weights=impacts.astype(float) ** 2))
        bucket = lexical._Bucket(np.arange(200), np.zeros(200, bool), terms, impacts, counts, length)
        weight = rnd.integers(1, 9000, 80)
        asked = rnd.choice(80, 40, replace=False)
        items = lexical.Items([0], [np.sort(asked)], weight)
        dense = np.zeros(80, np.int64)
        dense[asked] = weight[asked]
        scores = bucket.scores(np.arange(200), dense)
        for least in np.sort(scores)[[0, 100, 190, 199]]:
            rows = bucket.candidates(items.terms[0], items.weights[0], items.rest[0], int(least))
            assert set(np.flatnonzero(scores >= least)) <= set(rows.tolist())
        assert len(bucket.candidates(items.terms[0], items.weights[0], items.rest[0], int(scores.max()))) < 100
