"""Paged lists against the lists in one cell."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import event, events, plan_of
from vaultwatch.operators import pages, ranking
from vaultwatch.plans.batch import first_part
from vaultwatch.sources.shared import settle


def lists(paged, size):
    """Each list put together from its pages, which must be whole and without gaps."""
    found = defaultdict(dict)
    for r in paged.collect():
        assert r.page not in found[r.ts, r.rk, r.vault_id, r.failures]
        found[r.ts, r.rk, r.vault_id, r.failures][r.page] = r.disks
    out = {}
    for head, parts in found.items():
        assert sorted(parts) == list(range(len(parts)))
        assert all(len(parts[i]) == size for i in range(len(parts) - 1)) and 0 < len(parts[len(parts) - 1]) <= size
        out[head] = [d for i in sorted(parts) for d in parts[i]]
        assert len(out[head]) == head[3]
    return out


def whole(df):
    return {(r.ts, r.rk, r.vault_id, r.failures): r.disks for r in df.collect()}


def reports(spark, n=600):
    """A third of all reports are of vault 1 on one day; some are repeated."""
    rng = random.Random(5)
    rows = []
    for _ in range(n):
        day, vault = ("04-02", 1) if rng.random() < 0.34 else (f"04-{rng.randint(1, 9):02}", rng.randint(1, 15))
        rows.append(event(day, f"s{rng.randint(0, 99)}", rng.random() < 0.8, vault))
    return events(spark, rows)


@pytest.mark.parametrize("days,size,chunk", [(1, 7, 10), (3, 1, 3), (23, 50, 1), (3, 10_000, 10_000)])
def test_pages_are_the_lists_cut_up(spark, days, size, chunk):
    df = reports(spark)
    winners = settle(ranking.ranked(df, days), "ranking")
    paged = pages.paged_disks(df, winners, rows_per_page=size, rows_per_chunk=chunk)
    assert lists(paged, size) == whole(ranking.with_disks(df, winners))


def test_a_list_beyond_the_limit_of_a_cell_is_whole(spark):
    """With a limit of 100 disks to a cell, a list of 1,000 is ten rows, none of them beyond it."""
    df = events(spark, [event("04-02", f"s{i}", True, 1) for i in range(1000)])
    rows = pages.ranked_with_pages(df, 1, rows_per_page=100).collect()
    assert sorted((r.page, len(r.disks)) for r in rows) == [(i, 100) for i in range(10)]
    assert [d for r in sorted(rows, key=lambda r: r.page) for d in r.disks] == [f"M,s{i}" for i in range(1000)]


def test_merged_pages(spark):
    df = reports(spark)
    parts = [pages.ranked_with_pages(part, 23, rows_per_page=6) for part in first_part(df, 23, 5)]
    merged = pages.merge_paged(*parts)
    assert lists(merged, 6) == whole(ranking.ranked_with_disks(df, 23))
    assert merged.columns == parts[0].columns


def test_equal_places_go_by_label_and_nulls_stay(spark):
    df = events(spark, [event("04-02", s, True, 1) for s in ("b", "a", "c")]).withColumn("seq", F.lit(4).cast("long"))
    null = df.withColumn("disk", F.when(F.col("disk") != "M,c", F.col("disk")))
    assert [r.disks for r in pages.ranked_with_pages(df, 1).collect()] == [["M,a", "M,b", "M,c"]]
    assert [r.disks for r in pages.ranked_with_pages(null, 1).collect()] == [[None, "M,a", "M,b"]]


def test_without_failures_there_are_no_pages(spark):
    assert pages.ranked_with_pages(events(spark, [event("04-02")]), 1).collect() == []
    with pytest.raises(ValueError):
        pages.ranked_with_pages(events(spark, [event("04-02")]), 1, rows_per_page=0)


def test_no_task_gathers_a_list(spark):
    df = reports(spark)
    plan = plan_of(pages.ranked_with_pages(df, 3, rows_per_page=5))
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("chunk" in line for line in windows)
