"""The digest index against counting in Python, over one and several batches."""

import hashlib
import random
from collections import defaultdict

import pytest
from helpers import plan_of

from vaultwatch.llm import exact_dedup as exact

SCHEMA = "doc_id long, text string, digest string, batch string, key string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", None, "k") for i, t in rows], SCHEMA)


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for t, ids in groups.items():
        ids.sort(key=lambda i: (i is not None, i or 0), reverse=True)
        for place, i in enumerate(ids):
            out.append((i, ids[0], len(ids), place == 0, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_same_as_counting(spark):
    rnd = random.Random(1)
    texts = [f"text {i} Ünï" * rnd.randrange(1, 4) for i in range(80)] + ["", None, " ", "a", "A", "a ", "é", "é"]
    rows = [(i, rnd.choice(texts)) for i in rnd.sample(range(-300, 3000), 500)]
    rows += [(5000 + i, "hot") for i in range(300)] + [(None, "only without a key"), (None, "hot"), (None, None)]
    rows += [(9000, "twice"), (9000, "twice"), (9000, "else"), (None, "nulls"), (None, "nulls")]
    df = exact.duplicates(frame(spark, rows).repartition(7))
    assert df.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert found(df) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, "x")], [(None, None)], [(3, "x"), (3, "x"), (3, "x")]])
def test_few_rows(spark, rows):
    assert found(exact.duplicates(frame(spark, rows))) == brute(rows)


def test_very_long_texts(spark):
    long = "word " * 1_200_000
    rows = [(1, long), (2, long + "x"), (3, long), (4, long[:-1])]
    assert found(exact.duplicates(frame(spark, rows))) == brute(rows)


def test_earlier_batches_win_and_counts_go_on(spark, tmp_path):
    home = str(tmp_path / "it's an index")
    index = exact.DigestIndex.open(spark, home, buckets=3)
    days = [[(1, "a"), (2, "b"), (3, "a")], [(4, "a"), (5, "c"), (6, "c")], [(7, "b"), (8, "d")]]
    news = []
    for rows in days:
        batch = exact.DigestIndex.open(spark, home).add(exact.digest_rows(frame(spark, rows)))
        index = exact.DigestIndex.open(spark, home)
        news.append(sorted(r.keep_id for r in index.entries().filter(f"batch = {batch}").collect()))
    assert news == [[2, 3], [6], [8]]
    sizes = {r.digest: r.group_size for r in index.copies().collect()}
    want = {"a": 3, "b": 2, "c": 2, "d": 1}
    sizes = {bytes(k): n for k, n in sizes.items()}
    assert sizes == {hashlib.sha256(t.encode()).digest(): n for t, n in want.items()}
    index.compact()
    again = exact.DigestIndex.open(spark, home)
    assert {bytes(r.digest): r.group_size for r in again.copies().collect()} == sizes
    batch = again.add(exact.digest_rows(frame(spark, [(9, "a"), (10, "e")])))
    assert [r.keep_id for r in again.entries().filter(f"batch = {batch}").collect()] == [10]


def test_a_batch_without_its_state_does_not_count(spark, tmp_path):
    home = str(tmp_path / "index")
    index = exact.DigestIndex.open(spark, home)
    index._save = lambda: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        index.add(exact.digest_rows(frame(spark, [(1, "a"), (2, "b")])))
    again = exact.DigestIndex.open(spark, home)
    assert again.entries().count() == 0
    again.add(exact.digest_rows(frame(spark, [(1, "a"), (2, "b")])))
    assert sorted(r.keep_id for r in again.entries().collect()) == [1, 2]
    assert [r.group_size for r in again.copies().collect()] == [1, 1]


def test_two_writers_do_not_both_win(spark, tmp_path):
    home = str(tmp_path / "index")
    one, two = exact.DigestIndex.open(spark, home, 2), exact.DigestIndex.open(spark, home)
    one.add(exact.digest_rows(frame(spark, [(1, "a")])))
    with pytest.raises(RuntimeError, match="another writer"):
        two.add(exact.digest_rows(frame(spark, [(2, "a")])))


def test_anti_join_is_sort_merge_without_a_shuffle(spark, tmp_path):
    index = exact.DigestIndex.open(spark, str(tmp_path / "index"), 4)
    batch = index.add(exact.digest_rows(frame(spark, [(i, f"t{i}") for i in range(50)])))
    written = spark.table(index._table("sightings")).filter(f"batch = {batch}")
    plan = plan_of(index.fresh(written))
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and "Exchange" not in plan
    assert "Exchange" not in plan_of(index.copies())
