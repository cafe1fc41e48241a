"""The co-trained classifier: held-out accuracy, and defined results at the edges."""

import bisect
import math
import random
import tracemalloc

import numpy as np
import pytest

from vaultwatch.llm import quality

SF1 = "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string"


def made(n, seed=1):
    """Bad documents have signs for a layout, or rude words; only one view can tell each kind."""
    rnd = random.Random(seed)
    plain = [f"word{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(n):
        kind = rnd.choice(["good", "good", "good", "layout", "rude"])
        body = [rnd.choice(plain) for _ in range(rnd.randrange(20, 80))]
        if kind == "layout":
            body = [f"{w} |" for w in body]
        if kind == "rude":
            for _ in range(4):
                body[rnd.randrange(len(body))] = rnd.choice(["awful,", "vile", "NASTY"])
        text = " ".join(body)
        docs.append((i, text, "en", f"src{i % 7}", len(text), "clash"))
        labels.append((i, 0 if kind == "layout" else 1, 1 if kind == "rude" else 0))
    return docs, labels


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = made(900)
    table = spark.createDataFrame(docs, SCHEMA)
    return quality.learn(table, spark.createDataFrame(labels[:700], "doc_id long, quality int, toxic int"))


def test_unseen_documents(spark, model):
    docs, labels = made(400, seed=2)
    truth = {i: bool(q and not t) for i, q, t in labels}
    got = quality.score(spark.createDataFrame(docs, SCHEMA), model).collect()
    assert sum(r.kept == truth[r.doc_id] for r in got) / len(got) > 0.97
    assert all(0 <= x <= 1 for r in got for x in (r.content, r.metadata, r.score))


def test_edges(spark, model):
    rows = [(1, None, None, None, None, None), (2, "", "en", "src1", 0, None), (None, "word1 word2", "en", None, None, None), (4, "vile " * 50_000, "xx", "y", 1, None)]
    docs = spark.createDataFrame(rows + rows[3:], SCHEMA)
    got = quality.score(docs, model).collect()
    assert len(got) == 5 and {r.kept for r in got} <= {True, False}
    assert got[3].score == got[4].score and not got[3].kept
    assert quality.score(docs.limit(0), model).collect() == []


def test_without_labels(spark):
    docs = spark.createDataFrame(made(20)[0], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 0), (2, 1, None), (3, None, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, one):
        assert quality.learn(docs, labels) is None
    assert {(r.score, r.kept) for r in quality.score(docs, None).collect()} == {(1.0, True)}
    assert quality.learn(docs.limit(0), one) is None


def plain_surest(rows, model, given, share, count):
    """Every document scored by itself, and a sorted list for each view and label."""
    bound, out = math.log(quality.CERTAIN / (1 - quality.CERTAIN)), []
    for view in range(2):
        sure = {}
        for r in rows:
            if view == 0:
                raw = sum(model.content[c] for c in r.cells) + model.content[-1]
            else:
                bins = [i * (quality.BINS + 1) + bisect.bisect_right(e.tolist(), x) for i, (e, x) in enumerate(zip(model.edges, r.statistics))]
                raw = sum(model.metadata[c] for c in bins) + model.metadata[-1]
                raw += sum(model.metadata[len(model.edges) * (quality.BINS + 1) + c] for c in r.names)
            sure[r.key] = raw * model.scales[view][0] + model.scales[view][1]
        sides = []
        for sign, n in ((1, round(count * share)), (-1, count - round(count * share))):
            told = sorted((-min(30, sign * x), k) for k, x in sure.items() if sign * x >= bound and k not in given[view])
            sides.append([k for _, k in told[:n]])
        out.append(sides)
    return out


@pytest.mark.parametrize("count", [7, 60, 5000])
def test_exchange_covers_all_documents(spark, model, count):
    docs = made(300, seed=4)[0]
    table = spark.createDataFrame(docs + [(1000 + i, *d[1:]) for i, d in enumerate(docs[:40] * 5)], SCHEMA).repartition(5)
    features = quality._features(table)
    rows = features.collect()
    given = [set(), {r.key for r in rows[:50]}]
    want = plain_surest(rows, model, given, 0.6, count)
    for (keys, label, told), (good, bad) in zip(quality.surest(features, model, given, 0.6, count), want):
        assert len(told) == len(keys) == len(label) and label.tolist() == [1.0] * len(good) + [0.0] * len(bad)
        assert set(keys[: len(good)]) == set(good) and set(keys[len(good) :]) == set(bad)
        cells = {r.key: sorted(r.cells) for r in rows}
        assert all(sorted(told.cell[told.owner == i].tolist()) == cells[k] for i, k in enumerate(keys))
    assert sum(len(side) for sides in want for side in sides) >= 10


def test_labels_beyond_the_sample_are_unlabelled_documents(spark, monkeypatch):
    monkeypatch.setattr(quality, "LABELLED", 150)
    told = []
    monkeypatch.setattr(quality, "surest", lambda *a, find=quality.surest: told.append(find(*a)) or told[-1])
    docs, labels = made(1200, seed=5)
    model = quality.learn(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert len(told) == quality.ROUNDS and sum(len(keys) for turn in told for keys, _, _ in turn) > 300
    unseen, truth = made(400, seed=6)
    got = quality.score(spark.createDataFrame(unseen, SCHEMA), model).collect()
    assert sum(r.kept == bool(truth[r.doc_id][1] and not truth[r.doc_id][2]) for r in got) / len(got) > 0.9


def test_repeated_ids_and_other_dealing_change_nothing(spark):
    docs, labels = made(400, seed=7)
    docs += [(i, f"another text {i} of the same id | " * 9, "en", "src0", None, None) for i in range(0, 400, 3)]
    docs += [(None, "no id " * 20, None, None, None, None), (5, "long " * 600_000, "en", "src1", 3_000_000, None)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = []
    for parts in (1, 7):
        model = quality.learn(spark.createDataFrame(docs, SCHEMA).repartition(parts), table.repartition(parts))
        found.append(sorted((str(r.doc_id), r.text, r.score) for r in quality.score(spark.createDataFrame(docs, SCHEMA), model).collect()))
    assert found[0] == found[1]


def drawn(n, width, seed=3):
    """Rows of random word cells, those of even rows with a cell more often than others, and no exchange."""
    rnd = np.random.default_rng(seed)
    cells = rnd.integers(0, 1 << quality.WORD_BITS, (n, width), dtype=np.int32)
    cells[::2, :8] = np.arange(8)
    rows = quality.Rows(np.repeat(np.arange(n, dtype=np.int32), width), np.sort(cells, axis=1).ravel(), rnd.random((n, len(quality.STATISTICS))), rnd.integers(0, 9, (n, 2)))
    none = quality.Rows(np.zeros(0, np.int32), np.zeros(0, np.int32), np.zeros((0, len(quality.STATISTICS))), np.zeros((0, 2), np.int64))
    return rows, (np.arange(n) % 2 == 0).astype(float), lambda *_: [([], np.zeros(0), none)] * 2


def test_fit_needs_little_memory_besides_its_rows():
    rows, good, exchange = drawn(600, 4000)
    tracemalloc.start()
    try:
        assert quality.fit(rows, good, exchange) is not None
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 20 * len(rows.cell)


def test_stretches_change_nothing(monkeypatch):
    rows, good, exchange = drawn(90, 200)
    found = [quality.fit(rows, good, exchange)]
    for stretch in (1, 450, 1 << 30):
        monkeypatch.setattr(quality, "STRETCH", stretch)
        assert sum(map(len, rows.stretches())) == 90
        found.append(quality.fit(rows, good, exchange))
    assert all(np.array_equal(getattr(m, k), getattr(found[0], k)) for m in found for k in ("content", "metadata", "scales", "blend"))


def test_held_out_labels_of_the_tables(spark):
    docs, labels = (spark.read.parquet(f"{SF1}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.learn(docs, labels.filter("doc_id % 4 <> 0"))
    found = quality.score(docs, model).join(labels.filter("doc_id % 4 = 0"), "doc_id").collect()
    right = sum(r.kept == bool(r.quality == 1 and r.toxic == 0) for r in found) / len(found)
    assert len(found) > 500 and right > 0.93
