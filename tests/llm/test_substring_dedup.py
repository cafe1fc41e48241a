"""Repeated strings against a table of all strings of the length."""

import hashlib
import random
import sys
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vaultwatch.llm import substring_dedup as sub


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    count = Counter(r[i : i + length] for r in raw for i in range(len(r) - length + 1))
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - length + 1):
            if count[r[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(r, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, size=60):
    rnd = random.Random(seed)

    def prose(n):
        return "".join(rnd.choice("abcdefgh é\n") for _ in range(n))

    passages = [prose(n) for n in (39, 40, 41, 70, 200)]
    texts = []
    for _ in range(size):
        parts = [prose(rnd.randrange(0, 120))]
        for _ in range(rnd.randrange(3)):
            parts += [rnd.choice(passages), prose(rnd.randrange(0, 60))]
        texts.append("".join(parts))
    texts += [texts[3]] * 4 + [texts[5] + "x", "y" + texts[5], None, "", "z" * 39, "z" * 300, "ab" * 130, "q" * 40, "q" * 40, "p" * 40, "p" * 41]
    texts += [prose(30) + "shared by all, this passage has a length of well over forty bytes" + prose(30) for _ in range(50)]
    return texts


@pytest.mark.parametrize("seed,gram,shard", [(1, 16, 2048), (2, 13, 8), (3, 31, 8), (4, 16, 2)])
def test_same_bytes_as_all_strings(spark, monkeypatch, seed, gram, shard):
    monkeypatch.setattr(sub, "SHARD", shard)
    texts = corpus(seed)
    rows = [(i, t, "clash", "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string, sha string").repartition(4)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sub.removed(docs, 40, gram).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, 40)


def test_cleaned_texts(spark):
    texts = corpus(9)
    rows = [(i, t, "keep") for i, t in enumerate(texts)] + [(None, texts[0], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest string")
    out = sub.clean(docs, 40, 16)
    assert out.columns == docs.columns
    got = {r.doc_id: r.text for r in out.collect() if r.doc_id is not None}
    want = brute([t for _, t, _ in rows], 40)
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        if t is None:
            assert got[i] is None
        elif "é" not in t:
            assert hashlib.sha256(got[i].encode()).hexdigest() == want[i][3]


def test_passages_by_words(spark):
    rnd = random.Random(4)

    def prose(n):
        return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(3, 7))) for _ in range(n))

    short, passage, long = (prose(n) for n in (50, 51, 63))
    assert len(long) < sub.LENGTH
    texts = []
    for told in (short, passage, long, passage.replace(" ", "\n ")):
        texts += [f"{prose(80)} {told} {prose(20)}", f"{told} {prose(90)}"]
    texts += [prose(51)] * 2 + [prose(30)] * 2 + [None, "", "é" * 250 + " x", "é" * 250 + " y"]
    split = [(t or "").split() for t in texts]
    count = Counter(tuple(w[i : i + 51]) for w in split for i in range(len(w) - 50))
    want = []
    for w in split:
        gone = {j for i in range(len(w) - 50) if count[tuple(w[i : i + 51])] > 1 for j in range(i, i + 51)}
        want.append([t for j, t in enumerate(w) if j not in gone])
    want[-2:] = [["x"], ["y"]]  # as 400 bytes
    assert len(want[0]) == 150 and [len(w) for w in want[2:8]] == [100, 90] * 3 and want[8] == [] and len(want[10]) == 30
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.text for r in sub.clean(docs, n_words=51).collect()}
    assert [(got[i] or "").split() for i in range(len(texts))] == want and got[12] is None


def test_repeated_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "r" * 50), (1, "r" * 50), (None, "short")], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_removed, r.n_spans) for r in sub.removed(docs, 40, 16).collect())
    assert got == [("1", 50, 1), ("1", 50, 1), ("None", 0, 0)]
    assert sub.removed(docs.limit(0), 40, 16).collect() == []
    assert sub.clean(docs.limit(0), 40, 16).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_suffix_array_and_prefixes(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(30, 90, 12)
    ends = np.repeat(np.cumsum(sizes), sizes)
    raw = rng.integers(97, 99 + seed % 2, int(sizes.sum())).astype(np.uint8)
    raw[: sizes[0]] = 97
    whole, length = raw.tobytes(), 24
    gram = [4, 7, 12, 24, 9, 5][seed]
    order, group, depths = sub.suffix_array(raw, ends, length, gram)
    starts = [i for i in range(len(raw)) if i + length <= ends[i]]
    assert sorted(order.tolist()) == starts and depths[-1] == length
    texts = [whole[i : i + length] for i in order]
    runs = [t for i, t in enumerate(texts) if not i or t != texts[i - 1]]
    assert len(runs) == len(set(runs))  # equal strings stand together
    for depth in depths:
        heads = [t[:depth] for t in texts]
        assert len({h for i, h in enumerate(heads) if not i or h != heads[i - 1]}) == sum(1 for i, h in enumerate(heads) if not i or h != heads[i - 1])
    prefixes = sub.common_prefixes(raw, order, length, depths)
    for k in range(1, len(order)):
        common = next((j for j in range(length) if texts[k][j] != texts[k - 1][j]), length)
        assert prefixes[k] == common
        assert (group[order[k]] == group[order[k - 1]]) == (common == length)


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 1 << 62, 500).astype(np.uint64)
    keys[100:180] = keys[300:380]
    keys[400:440] = keys[400]
    found = sub.anchors(keys, 40, 11)
    for start in range(100, 150):
        mine = [a - start for a in found if start <= a < start + 30]
        assert mine and mine[-1:] and {a + 200 for a in found if start <= a < start + 30} <= set(found.tolist()) | {a for a in found if a > 380}


def test_a_segment_of_many_places_in_a_text_is_one_row(spark, monkeypatch):
    """The places of a repeated line are joined once a text, not once a place."""
    lines = [f"{i} begins here " + "is on he. " * 200 + f"and ends {i}" for i in range(6)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(3)
    scanned = sub._scan(docs.select(F.col("doc_id").alias("key"), "text"), 40, 16)
    for r in scanned.collect():
        assert len(set(zip(r.mark, r.segment))) == len(r.mark) < 40
        assert sum(map(len, r.begins)) >= 190 and all(b == sorted(set(b)) for b in r.begins)
    spots = []
    cuts = sub.cuts
    monkeypatch.setattr(sub, "cuts", lambda *a: spots.append(cuts(*a)) or spots[-1])
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sub.removed(docs, 40, 16).collect()}
    assert [got[i] for i in range(len(lines))] == brute(lines, 40)
    assert all(len(r.spans) < 40 for r in spots[0].collect())


def test_a_shard_of_many_anchors_is_sorted_in_bounded_memory():
    rng = np.random.default_rng(3)
    length, gram, side = 400, 128, 272
    rows = []
    for mark in range(300):
        whole = rng.integers(97, 123, 2 * side + gram).astype(np.uint8).tobytes()
        for i in range(16):  # copies of the middle with own heads
            head = rng.integers(65, 91, 60 + i).astype(np.uint8).tobytes()
            rows.append((mark, 1000 * mark + i, rng.bytes(16), 0, len(whole), side, False, False, head + whole[len(head) :]))
    names = ["mark", "segment", "digest", "begin", "stop", "spot", "several", "split", "bytes"]
    table = pa.table({n: pa.array(c, pa.binary()) if n in ("digest", "bytes") else pa.array(c) for n, c in zip(names, zip(*rows))})
    sub._shard(table.slice(0, 64), length, gram, 1)
    tracemalloc.start()
    out = sub._shard(table, length, gram, 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Each repeats from the end of its own head on, that of the shortest head from the end of the next one.
    want = {1000 * mark + i: ([60 + max(i, 1)], [2 * side + gram]) for mark in range(300) for i in range(16)}
    assert {s: (a, b) for s, a, b in zip(*(out.column(c).to_pylist() for c in ("segment", "starts", "stops")))} == want
    assert peak < 60 * table.nbytes


def test_prefixes_are_compared_by_runs_not_place_by_place():
    """The steps do not grow with the places of a segment: two copies with a byte changed here and there."""
    rng = np.random.default_rng(8)
    length, gram, steps = 40, 16, []
    for size in (300, 3000):
        one = rng.integers(97, 101, size).astype(np.uint8)
        two = one.copy()
        two[size // 3 :: 90] = 65
        raw, ends = np.concatenate([one, two]), np.repeat([size, 2 * size], size)
        order, group, depths = sub.suffix_array(raw, ends, length, gram)
        calls = []
        sys.setprofile(lambda frame, event, arg: calls.append(event) if event == "c_call" else None)
        prefixes = sub.common_prefixes(raw, order, length, depths)
        sys.setprofile(None)
        steps.append(len(calls))
        whole = raw.tobytes()
        texts = [whole[i : i + length] for i in order]
        want = [next((j for j in range(length) if a[j] != b[j]), length) for a, b in zip(texts, texts[1:])]
        assert prefixes.tolist() == [0, *want] and length in want and length - 1 in want
        assert ((prefixes[1:] < length) == (np.diff(group[order]) != 0)).all()
    assert max(steps) < 500 and steps[1] < 2 * steps[0]


def test_prefixes_where_a_run_comes_to_no_common_byte():
    """Any order is taken: each place before the one 50 further on, so that one run goes through bytes that differ."""
    length = 24
    raw = np.random.default_rng(2).integers(97, 99, 150).astype(np.uint8)
    order = np.concatenate([np.arange(r, 150 - length + 1, 50) for r in range(50)]).astype(np.int32)
    whole = raw.tobytes()
    texts = [whole[i : i + length] for i in order]
    want = [next((j for j in range(length) if a[j] != b[j]), length) for a, b in zip(texts, texts[1:])]
    assert sub.common_prefixes(raw, order, length, [8]).tolist() == [0, *want] and want.count(0) > 20


class _Rows:
    """As much of a table as a scan asks for: its function for batches."""

    dtypes = [("key", "bigint")]

    def mapInArrow(self, run, schema):
        return run


def test_a_scan_hashes_the_texts_of_a_piece_at_once(monkeypatch):
    texts = ["", *(t or "" for t in corpus(5, 200)), "", "ends with a short one"]
    scan, mix, calls = sub._scan(_Rows(), 40, 16), sub.mix, []
    monkeypatch.setattr(sub, "mix", lambda h: calls.append(len(h)) or mix(h))

    def rows(part, key):
        return [r for b in scan(iter([pa.record_batch({"key": range(key, key + len(part)), "text": part})])) for r in b.to_pylist()]

    found = rows(texts, 0)
    assert len(calls) < 10 < len(texts)
    assert found == [r for i, t in enumerate(texts) for r in rows([t], i)] and sum(len(r["mark"]) for r in found) > len(texts)
    assert rows(["", "short"], 0) == [r for i, t in enumerate(["", "short"]) for r in rows([t], i)]
    assert scan(iter([])) is not None and rows([""], 3)[0]["n_bytes"] == 0


@pytest.mark.parametrize("bits", [10, 62, 64])
def test_places_in_the_order_of_their_keys(bits):
    rng = np.random.default_rng(bits)
    keys = rng.integers(0, 1 << min(bits, 62), 700).astype(np.uint64)
    keys[::7] = (keys[0] >> np.uint64(4) << np.uint64(4)) | rng.integers(0, 16, 100).astype(np.uint64)  # alike but for the last bits
    place, found = sub._sorted_places(keys, bits)
    assert sorted(place.tolist()) == list(range(700)) and (found == np.sort(keys)).all() and (keys[place] == found).all()
    assert len(sub._sorted_places(keys[:0], bits)[0]) == 0
