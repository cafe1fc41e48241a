"""One vault holds a third of all rows, and a third of these share one instant."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import plan_of
from vaultwatch.operators import moments, ranking
from vaultwatch.plans.batch import query2

ROWS = 60_000


@pytest.fixture(scope="module")
def hot(spark):
    share = lambda salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(1000)) / 1000
    start = 1_680_307_200_000_000
    us = F.when((share(1) < 0.33) & (share(2) < 0.33), start).otherwise(start + (share(3) * 9 * 86_400_000_000).cast("long"))
    df = spark.range(0, ROWS, 1, 12).select(
        F.timestamp_micros(us).alias("ts"),
        F.when(share(1) < 0.33, 1000).otherwise(1001 + F.pmod(F.xxhash64("id", F.lit(4)), F.lit(500))).cast("int").alias("vault_id"),
        (share(5) < 0.3).alias("failure"),
        (share(6) * 40).cast("float").alias("s194_temperature_celsius"),
        F.col("id").alias("seq"),
        F.col("id").cast("string").alias("disk"),
    )
    return df.cache()


def test_ranking_and_lists(hot):
    reports = defaultdict(list)
    for r in hot.filter("failure").select("vault_id", F.unix_micros("ts").alias("us"), "seq", "disk").collect():
        reports[r.us // 86_400_000_000, r.vault_id].append((r.us, r.seq, r.disk))
    best = {}
    for (day, vault), rows in sorted(reports.items()):
        window = day // 3
        if len(rows) > len(best.get((window, vault), (None, []))[1]):
            best[window, vault] = (day, rows)
    got = query2(hot, "3d").collect()
    hottest = max(Counter({r: len(v) for r, v in reports.items()}).values())
    assert hottest > 2000
    for window in {w for w, _ in best}:
        ranked = sorted(((-len(rows), day, vault) for (w, vault), (day, rows) in best.items() if w == window))[:10]
        rows = sorted((r for r in got if r.ts == window * 3 * 86_400_000), key=lambda r: r.rk)
        assert [(r.vault_id, r.failures) for r in rows] == [(v, -n) for n, _, v in ranked]
        for r in rows:
            assert r.disks == [d for _, _, d in sorted(best[window, r.vault_id][1], key=lambda x: x[1])]


def test_hot_list_is_collected_in_pieces(hot):
    daily = ranking.daily_failures(hot)
    plan = plan_of(daily)
    assert plan.count("REPARTITION_BY_COL") == 1 and plan.count("partial_collect_list") == 2
    row = daily.orderBy(F.desc("failures")).select("vault_id", "failures", F.size("disks").alias("n")).first()
    assert row.vault_id == 1000 and row.failures == row.n > 2000


def test_statistics_shuffle_one_row_per_task_and_group(spark, hot):
    rows = moments.windowed_stats(hot, 3)
    plan = plan_of(rows)
    assert plan.index("partial_avg") > plan.index("Exchange")
    totals = rows.filter("vault_id = 1000").agg(F.sum("count")).first()[0]
    assert totals == hot.filter("vault_id = 1000").count() > ROWS / 4
