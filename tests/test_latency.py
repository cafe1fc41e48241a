"""Sketches of waits against sorted lists, and the waits of a stream."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import event, events, frame, ms, plan_of
from vaultwatch.functions.eventtime import in_windows, monotonous, with_event_time
from vaultwatch.operators import quantiles
from vaultwatch.sources import topics
from vaultwatch.streaming import jobs, latency


def values(spark, rows):
    return spark.createDataFrame(rows, "g string, v long")


def leading(v, bits=quantiles.BITS):
    shift = max(0, v.bit_length() - bits)
    return v >> shift << shift


def test_quantiles_are_those_of_the_sorted_values_to_the_leading_bits(spark):
    rng = random.Random(3)
    rows = [(g, int(rng.lognormvariate(m, 3))) for g, m, n in (("a", 8, 700), ("b", 2, 301), ("c", 20, 1)) for _ in range(n)]
    rows += [("a", 5)] * 400 + [("d", 2**62)] * 3
    got = quantiles.quantiles(quantiles.sketch(values(spark, rows), ["g"], "v"), ["g"], {"low": 0, "p50": 500, "p99": 990, "top": 1000})
    for r in got.collect():
        mine = sorted(v for g, v in rows if g == r.g)
        exact = {name: mine[max(1, -(-p * len(mine) // 1000)) - 1] for name, p in {"low": 0, "p50": 500, "p99": 990, "top": 1000}.items()}
        assert r.n == len(mine)
        for name, v in exact.items():
            assert r[name] == leading(v) and v / (1 + 1 / 64) <= r[name] <= v


def test_sketches_add_up(spark):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), rng.randint(0, 10**9)) for _ in range(900)]
    whole = quantiles.sketch(values(spark, rows), ["g"], "v")
    for cuts in ((0, 900), (0, 1, 450, 450, 900)):
        parts = [quantiles.sketch(values(spark, rows[a:b]), ["g"], "v") for a, b in zip(cuts, cuts[1:])]
        random.shuffle(parts)
        assert sorted(quantiles.merge(parts, ["g"]).collect()) == sorted(whole.collect())


def test_nulls_negatives_weights_and_empty_tables(spark):
    rows = values(spark, [("a", None), ("a", -5), ("a", 0), (None, 127), (None, 128), (None, 129)])
    assert set(quantiles.sketch(rows, ["g"], "v").collect()) == {(None, 127, 1), (None, 128, 2), ("a", 0, 2)}
    weighted = spark.createDataFrame([("a", 3, 9), ("a", 4, 1)], "g string, v long, n long")
    assert quantiles.quantiles(quantiles.sketch(weighted, ["g"], "v", "n"), ["g"], {"p": 900, "q": 901}).collect() == [("a", 10, 3, 4)]
    assert quantiles.quantiles(quantiles.sketch(values(spark, []), ["g"], "v"), ["g"], {"p": 500}).collect() == []
    with pytest.raises(ValueError):
        quantiles.quantiles(weighted, ["g"], {"p": 1001})
    assert "Python" not in plan_of(quantiles.sketch(rows, ["g"], "v"))


WINDOWS = {"1d": 1, "3d": 3}


def run(spark, home, rows, batches=3, **options):
    """The rows in order of time through a stream of several batches; its log's folder."""
    df = with_event_time(frame(spark, rows))
    files = topics.publish_in_order(df, f"{home}/topic", batches)
    session = jobs.streaming_session(spark)
    stream = topics.parquet_events(session, f"{home}/topic", spark.read.parquet(f"{home}/topic").schema, files)
    counted = latency.arrivals(monotonous(stream), WINDOWS, **options.pop("arrived", {}))
    latency.start_latency(counted, f"{home}/log", f"{home}/checkpoint", once=True, **options).awaitTermination()
    return f"{home}/log"


DAY = 86_400_000


def test_waits_on_fixed_times(spark, tmp_path):
    """Events that arrive at their own time wait until their window ends."""
    rows = [event(f"04-{d:02}", f"s{i}", vault=i, time=f"{i:02}:00:00.000000") for d in (2, 3, 4, 5, 6) for i in range(20)]
    rows.append(event("04-20"))
    log = run(spark, str(tmp_path), rows, arrived={"arrived": F.col("ts")}, emitted=F.col("closed_ms"))
    got = {(r.window_name, r.ts): (r.n, r.p50_ms, r.p99_ms) for r in latency.latency(spark, log).collect()}
    waits = sorted(DAY - i * 3_600_000 for i in range(20))
    assert got["1d", ms("04-03")] == (20, leading(waits[9]), leading(waits[19]))
    placed = in_windows(events(spark, rows), "ts", WINDOWS).groupBy("window_name", F.unix_millis("w.start").alias("ts")).count().collect()
    assert {k: v[0] for k, v in got.items()} == {(r.window_name, r.ts): r["count"] for r in placed if r.ts < ms("04-19")}
    by_length = latency.latency(spark, log, by=("window_name",)).collect()
    assert sorted((r.window_name, r.n) for r in by_length) == [("1d", 100), ("3d", 100)]


def test_waits_by_the_clock(spark, tmp_path):
    rows = [event(f"04-{d:02}", f"s{i}") for d in (2, 3, 20) for i in range(3)]
    log = run(spark, str(tmp_path), rows)
    got = latency.latency(spark, log).filter("window_name = '1d'").collect()
    assert sorted((r.ts, r.n) for r in got) == [(ms("04-02"), 3), (ms("04-03"), 3)]
    assert all(0 < r.p50_ms <= r.p99_ms < 600_000 for r in got)


def test_before_the_first_window_there_are_no_waits(spark, tmp_path):
    assert latency.latency(spark, f"{tmp_path}/none").collect() == []
