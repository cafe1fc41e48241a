"""Sharding against placing the groups one by one."""

import heapq
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import types as T

from vaultwatch.llm import sharding

SCHEMA = "doc_id long, text string, digest string"


def one_by_one(sizes, shards):
    heap = [(0, s) for s in range(shards)]
    for size in sizes:
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + size, shard))
    return sorted(load for load, _ in heap)


@pytest.mark.parametrize("seed", range(20))
def test_runs_are_dealt_as_one_by_one(seed):
    rnd = random.Random(seed)
    shards = rnd.choice([1, 2, 5, 16])
    runs = [(size, rnd.choice([1, 2, 7, 40, 500])) for size in sorted(rnd.sample(range(1, 3000), 25), reverse=True)]
    loads = [0] * shards
    for (size, count), got in zip(runs, sharding.deal(runs, shards)):
        assert sum(got) == count
        loads = [load + n * size for load, n in zip(loads, got)]
    assert sorted(loads) == one_by_one([size for size, count in runs for _ in range(count)], shards)


def test_groups_sizes_and_slots(spark):
    rnd = random.Random(3)
    texts = ["x" * rnd.randrange(40) + "é" * rnd.randrange(3) for _ in range(150)] + ["hot"] * 60 + [None, None, "", "", "y" * 5000]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, "n", None), (7, "again", None)]
    got = sharding.assign(spark.createDataFrame(rows, SCHEMA), 4).collect()
    assert len(got) == len(rows)
    by_shard, homes, loads = defaultdict(list), defaultdict(set), defaultdict(int)
    sizes = defaultdict(int)
    text_of = {(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())): t for i, t, _ in rows}
    for r in got:
        text = text_of[r.doc_id, r.size, r.text_crc32]
        by_shard[r.shard].append(r.slot)
        homes[text].add(r.shard)
        loads[r.shard] += r.size
        sizes[text] += r.size
        assert (r.law, r.grown_shard) == ("bytes", None)
    assert all(len(h) == 1 for h in homes.values())
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert sorted(loads.values()) == one_by_one(sorted(sizes.values(), reverse=True), 4)


def test_empty_table(spark):
    assert sharding.assign(spark.createDataFrame([], T._parse_datatype_string(SCHEMA)), 4).collect() == []
