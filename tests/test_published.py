"""Roll-ups against published results: wide windows must follow from the published days.

A few published rows are written out here. With ``VAULTWATCH_PUBLISHED`` set to a folder with the
six result files, all of them are checked.
"""

import os

import pytest
from pyspark.sql import functions as F

from vaultwatch.operators import moments, ranking
from vaultwatch.schemas import RESULT_TOPICS, WINDOW_DAYS

FOLDER = os.environ.get("VAULTWATCH_PUBLISHED")
whole = pytest.mark.skipif(not FOLDER, reason="VAULTWATCH_PUBLISHED is not set")

# Vault 1005 on 2023-04-02, 04-03 and 04-04, and the three days together.
DAYS = [
    (1680393600000, 1005, 564, 22.156029, 2.62431),
    (1680480000000, 1005, 564, 22.39539, 2.490702),
    (1680566400000, 1005, 528, 21.535984, 2.7788827),
]
THREE_DAYS = (1680393600000, 1005, 1656, 22.039856, 2.655021)


def as_moments(daily):
    return daily.select(
        F.timestamp_millis("ts").alias("day"),
        "vault_id",
        F.col("count").cast("long").alias("count"),
        F.col("mean_s194").cast("double").alias("mean"),
        (F.pow(F.col("stddev_s194").cast("double"), 2) * F.col("count")).alias("m2"),
    )


def long_ranking(wide):
    slots = F.array(
        *[
            F.struct(
                F.lit(i).alias("rk"),
                F.col(f"vault_id{i}").alias("vault_id"),
                F.col(f"failures{i}").alias("failures"),
                F.col(f"failed_disks{i}").alias("disks"),
            )
            for i in range(1, 11)
        ]
    )
    return wide.select("ts", F.inline(slots)).filter("vault_id IS NOT NULL")


def published(spark, query, window):
    topic = f"{query}_{window}_results"
    return spark.read.schema(RESULT_TOPICS[topic]).option("header", True).csv(f"{FOLDER}/{topic}.csv")


def close(row, want):
    assert row["count"] == want[2]
    assert row.mean_s194 == pytest.approx(want[3], abs=1e-5)
    assert row.stddev_s194 == pytest.approx(want[4], abs=1e-5)


def test_three_days_of_a_vault(spark):
    daily = spark.createDataFrame(DAYS, "ts long, vault_id int, count int, mean_s194 double, stddev_s194 double")
    (row,) = moments.rollup_stats(as_moments(daily), 3).collect()
    assert (row.ts, row.vault_id) == THREE_DAYS[:2]
    close(row, THREE_DAYS)


@whole
@pytest.mark.parametrize("window,rows", [("3d", 168), ("all", 21)])
def test_all_published_statistics(spark, window, rows):
    rolled = moments.rollup_stats(as_moments(published(spark, "query1", "1d")), WINDOW_DAYS[window])
    got = {(r.ts, r.vault_id): r for r in rolled.collect()}
    want = published(spark, "query1", window).collect()
    assert len(want) == rows
    for r in want:
        close(got[r.ts, r.vault_id], r)


@whole
@pytest.mark.parametrize("window,rows", [("3d", 8), ("all", 1)])
def test_all_published_rankings(spark, window, rows):
    """Within a day the published order of equals is arbitrary; the daily rank stands in for the vault id."""
    daily = long_ranking(published(spark, "query2", "1d")).select(
        F.timestamp_millis("ts").alias("day"), F.struct("rk", "vault_id").alias("vault_id"), "failures", "disks", F.col("vault_id").alias("vault")
    )
    placed = daily.withColumn("ts", F.unix_millis(F.window("day", f"{WINDOW_DAYS[window]} days")["start"]))
    best = (
        placed.groupBy("ts", "vault")
        .agg(F.max_by(F.struct("vault_id", "day", "failures", "disks"), F.struct("failures", -F.unix_millis("day"))).alias("b"))
        .select("ts", "vault", "b.*")
    )
    got = {}
    for r in ranking.top_vaults(best).collect():
        got[r.ts, r.rk] = (r.vault, r.failures, r.disks)
    wide = published(spark, "query2", window)
    assert wide.count() == rows
    want = {(r.ts, r.rk): (r.vault_id, r.failures, r.disks) for r in long_ranking(wide).collect()}
    assert {k: v for k, v in got.items() if k in want} == want
    assert max(rk for ts, rk in got if ts in {t for t, _ in want}) <= 10
